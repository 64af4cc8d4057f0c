"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source gets a number of words to give.  A document's place in its source is a hash, so the
first words of the permuted source are those below a threshold, and the documents of a *block* are
those of one hash class: neither needs the documents to be sorted.  The exact numbers of blocks per
source are split among the output shards from the root of a tree down: a node hands each child the
blocks it has room for, drawn without replacement, which is a multivariate hypergeometric draw.
The leaves are the shards' quotas.  The shards then take disjoint runs of the permuted blocks and
shuffle them locally.

Large documents are decided first, so that small ones can fill up what these leave: a source then is
within a small document of its target wherever its documents allow that.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastre.llm.common import fresh, maybe_broadcast, numbered, ship, word_count
from cadastre.sources.scratch import cut

SHARE, CAP, WEIGHTS = 1.5, 2.0, (5, 2, 1)
BLOCK_WORDS, SHARD_WORDS = 1 << 16, 1 << 22
SEED = 7
# A prime above any number of blocks: slot -> slot * STEP mod blocks is a permutation.
STEP = 998_244_353
BITS = 10  # of the hash, per round of the search for a threshold
GRAIN = 256  # a document above this part of what is wanted of its source is large
SUMS = 1 << 16  # steps in which the sums of the documents of the last class are told apart
FAN = 64  # children a task splits a node into, by halves


def _place(id: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), id, text)


def targets(sizes: DataFrame, share: float = SHARE, cap: float = CAP, weights=WEIGHTS) -> DataFrame:
    """(source, source_size, number, target) from ``sizes(source, size)``.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` times all
    words.  A target stops at ``cap`` times the source's size; what is over is shared by weight
    among the others until none is above.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    totals = numbered(totals, [F.col("source").asc_nulls_last()], "number")
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    rows = cut(totals.withColumn("weight", turn.cast("double")).withColumn("cap", cap * F.col("source_size")))
    words = rows.agg(F.sum("source_size")).first()[0] or 0
    level = None  # words per unit of weight; rises as sources stop
    while True:
        stopped = F.lit(False) if level is None else F.col("cap") <= level * F.col("weight")
        left = rows.agg(
            F.sum(F.when(stopped, F.col("cap")).otherwise(0.0)).alias("given"),
            F.sum(F.when(stopped, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        now = (share * words - left["given"]) / left["weight"] if left["weight"] else level
        if now is None or now == level:
            break
        level = now
    level = level or 0.0
    target = F.least("cap", level * F.col("weight"))
    return rows.select("source", "source_size", "number", target.cast("double").alias("target"))


def _ahead(place: Column, shift: Column) -> Column:
    return F.when(shift == 64, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftright", place, shift)
    )


def _fit(words: np.ndarray, part: float, low: float, high: float) -> np.ndarray:
    """Which of these documents to take, so that their sum is in ``low`` to ``high`` if it can be, and near ``part``.

    Sums are reached document by document; of each step the first sum and the document that reached it
    are kept, which is enough to find the documents again.
    """
    most = min(words.sum(), max(high, 0) + words.max())
    unit = max(1.0, most / SUMS)
    step = np.rint(words / unit).astype("i8")
    size = int(most / unit) + 2
    by, sums = np.full(size, -1), np.full(size, np.nan)
    sums[0] = 0
    for i in np.flatnonzero((step > 0) & (step < size)):
        to = np.flatnonzero(~np.isnan(sums[: size - step[i]])) + step[i]
        to = to[np.isnan(sums[to])]
        # From the highest down nothing reached with this document is built on; it all comes from sums before.
        sums[to], by[to] = sums[to - step[i]] + words[i], i
    off = np.maximum(np.maximum(low - sums, sums - high), 0)
    at = int(np.nanargmin(off * 2.0**20 + np.abs(sums - part)))
    chosen = np.zeros(len(words), bool)
    while at:
        chosen[by[at]] = True
        at -= step[by[at]]
    return chosen


def _stops(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Which documents make up the last round: (number, shift, prefix, chosen).

    ``rows(number, place, size)``, ``wanted(number, part, low, high)``.  A document is taken if its place
    begins with less than ``prefix``, or if it begins with ``prefix`` and is in ``chosen``.  Each
    round sums words by the next bits of the place within one class per source, until a class has
    1,024 places at most; of that class ``_fit`` chooses.
    """
    ship(rows.sparkSession)
    zero = F.lit(0).cast("long")
    limits = ["part", "low", "high"]
    state = wanted.select("number", *limits, zero.alias("prefix"), zero.alias("below"))
    rows = cut(rows.groupBy("number", "place").agg(F.sum("size").alias("size")))
    size = rows.join(maybe_broadcast(wanted), "number").groupBy("number").count().agg(F.max("count")).first()[0]
    bits = 0
    while (size or 0) > 1 << BITS and bits + BITS <= 64:
        inside = rows.join(maybe_broadcast(state), "number")
        inside = inside.filter(_ahead(F.col("place"), F.lit(64 - bits)) == F.col("prefix"))
        bits += BITS
        prefix = F.shiftright("place", 64 - bits).alias("prefix")
        sums = inside.groupBy("number", *limits, "below", prefix).agg(
            F.sum("size").alias("words"), F.count("*").alias("docs")
        )
        order = Window.partitionBy("number").orderBy("prefix")
        sums = sums.withColumn("end", F.col("below") + F.sum("words").over(order))
        at = F.struct("prefix", (F.col("end") - F.col("words")).alias("below"), "docs")
        # What is wanted may be a little above all there is: then the last class decides.
        last = F.lead("prefix").over(order).isNull()
        first = sums.withColumn("last", last).filter("end >= part OR last").groupBy("number", *limits)
        state = cut(first.agg(F.min_by(at, "prefix").alias("at")).select("number", *limits, "at.prefix", "at.below", "at.docs"))
        size = state.agg(F.max("docs")).first()[0]
        state = state.drop("docs")

    def fit(key, pdf):
        pdf = pdf.sort_values("place")
        left = [float(pdf[c].iloc[0] - pdf["below"].iloc[0]) for c in limits]
        chosen = _fit(pdf["size"].to_numpy("f8"), *left)
        return pd.DataFrame({"number": [key[0]], "prefix": [key[1]], "chosen": [pdf["place"].to_numpy()[chosen]]})

    inside = rows.join(maybe_broadcast(state), "number")
    inside = inside.filter(_ahead(F.col("place"), F.lit(64 - bits)) == F.col("prefix"))
    found = inside.groupBy("number", "prefix").applyInPandas(fit, "number long, prefix long, chosen array<long>")
    return found.withColumn("shift", F.lit(64 - bits))


def _inside(place: Column, stop: Column) -> Column:
    """Whether a document with this place is taken by ``stop(shift, prefix, chosen)``; not if there is none."""
    ahead = _ahead(place, stop["shift"])
    chosen = (ahead == stop["prefix"]) & F.array_contains(stop["chosen"], place)
    return F.coalesce((ahead < stop["prefix"]) | chosen, F.lit(False))


def _large(size: Column) -> Column:
    return size * GRAIN > F.col("part")


def _last_round(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(number, large, small): the stops of the large and of the small documents, of ``wanted(number, part)``.

    Large ones take their share of the part, but leave no more than the small ones have, nor take more than
    the part if that can be.  The small ones make up the rest.
    """
    stop = F.struct("shift", "prefix", "chosen")
    rows = cut(rows.join(maybe_broadcast(wanted), "number"))
    large, small = rows.filter(_large(F.col("size"))), rows.filter(~_large(F.col("size")))
    sums = rows.groupBy("number", "part").agg(
        F.sum("size").alias("all"), F.sum(F.when(_large(F.col("size")), F.col("size")).otherwise(0)).alias("large")
    )
    low = F.greatest(F.col("part") - F.col("all") + F.col("large"), F.lit(0.0))
    share = F.least(F.greatest(F.col("part") * F.col("large") / F.col("all"), low), F.col("part"))
    first = sums.filter("`all` > 0").select("number", share.alias("share"), low.alias("low"), F.col("part").alias("high"))
    columns = ["number", "place", "size"]
    stops = cut(_stops(large.select(*columns), first.withColumnRenamed("share", "part")).select("number", stop.alias("large")))
    side = maybe_broadcast(stops)
    taken = large.join(side, "number").filter(_inside(F.col("place"), F.col("large")))
    taken = maybe_broadcast(cut(taken.groupBy("number").agg(F.sum("size").alias("taken"))))
    rest = wanted.join(taken, "number", "left")
    rest = rest.select("number", (F.col("part") - F.coalesce("taken", F.lit(0))).alias("part")).filter("part > 0")
    rest = rest.withColumns({"low": F.col("part"), "high": F.col("part")})
    fill = cut(_stops(small.select(*columns), rest).select("number", stop.alias("small")))
    return wanted.select("number").join(stops, "number", "left").join(fill, "number", "left")


def _placed(docs: DataFrame, id: str, source: str, text: str, seed: int, name: str) -> DataFrame:
    """The rows with their place.  Rows equal in id, source and text get places of their own, by their number.

    They are numbered within each partition first, and these numbers made one by one count per partition.
    """
    rows = docs.withColumn(name, _place(F.col(id), F.col(text), seed))
    of, spot, part, row, before, had = (fresh(rows, f"copies_{x}") for x in ("of", "place", "part", "row", "in", "had"))
    where = [F.col(source).alias(of), F.col(name).alias(spot)]
    again = cut(rows.select(*where).groupBy(of, spot).count().filter("count > 1").drop("count"))
    if again.isEmpty():
        return rows
    side = maybe_broadcast(again)
    same = rows[source].eqNullSafe(side[of]) & (rows[name] == side[spot])
    once = rows.join(side, same, "left_anti")
    copies = cut(rows.join(side, same, "left_semi").withColumns({part: F.spark_partition_id(), row: F.monotonically_increasing_id()}))
    earlier = Window.partitionBy(of, spot).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = copies.groupBy(*where, part).agg(F.count("*").alias(row))
    counts = counts.select(of, spot, F.col(part).alias(before), F.coalesce(F.sum(row).over(earlier), F.lit(0)).alias(had))
    counts = maybe_broadcast(cut(counts))
    own = copies.withColumn(row, F.row_number().over(Window.partitionBy(source, name, part).orderBy(row)))
    on = own[source].eqNullSafe(counts[of]) & (own[name] == counts[spot]) & (own[part] == counts[before])
    number = F.col(row) + F.col(had)
    moved = F.when(number == 1, F.col(name)).otherwise(F.xxhash64(F.col(name), number))
    return once.unionByName(own.join(counts, on).withColumn(name, moved).select(*rows.columns))


def split_tree(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """(shard, number, blocks) from ``quotas(number, blocks)``: exact, random, without replacement.

    A task holds one row per source of one node.
    """
    ship(quotas.sparkSession)
    schema = "low long, high long, number long, blocks long"

    def halves(low, high, have, depth, rng):
        if high - low == 1 or depth == 0:
            yield low, high, have
            return
        middle = (low + high) // 2
        room = int(have.sum()) * (middle - low) // (high - low)
        left = rng.multivariate_hypergeometric(have, room, method="marginals")
        yield from halves(low, middle, left, depth - 1, rng)
        yield from halves(middle, high, have - left, depth - 1, rng)

    def split(key, pdf):
        low, high = map(int, key)
        pdf = pdf.sort_values("number")
        rng = np.random.default_rng([seed, low, high])
        depth = FAN.bit_length() - 1
        parts = [
            pd.DataFrame({"low": a, "high": b, "number": pdf["number"].to_numpy(), "blocks": n})
            for a, b, n in halves(low, high, pdf["blocks"].to_numpy(), depth, rng)
        ]
        out = pd.concat(parts)
        return out[out["blocks"] > 0]

    now = quotas.select(F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("high"), "number", "blocks")
    wide = shards
    while wide > 1:
        now = now.groupBy("low", "high").applyInPandas(split, schema)
        wide = -(-wide // FAN)
    return now.select(F.col("low").alias("shard"), "number", "blocks")


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    share: float = SHARE,
    cap: float = CAP,
    weights=WEIGHTS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs`` with one column ``mix`` more (with underscores before it if taken).

    ``mix`` holds size (words), place, source_size, target, copies and shards: the shard of each
    copy.  A document is taken 0 to ``ceil(cap)`` times.  The words taken of a source are within
    one small document of its target (1/256 of the words of its last round) wherever choosing among its
    large ones allows that.  Equal rows are decided one by one, and rows that are equal in id, source and
    text are interchangeable.  Null texts have size 0 and a null source is a source.  The result depends on
    rows and seed only.
    """
    column, at = fresh(docs, "mix"), fresh(docs, "place")
    d = _placed(docs, id, source, text, seed, at)
    size, place = word_count(F.col(text)), F.col(at)
    sizes = cut(d.select(F.col(source).alias("source"), size.alias("size"), place.alias("place")))
    goal = cut(targets(sizes.select("source", "size"), share, cap, weights))

    epochs = int(np.ceil(cap))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.withColumn("whole", F.least(whole, F.lit(epochs)).cast("int"))
    goal = goal.withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
    key = maybe_broadcast(goal.select("source", "number"))
    rows = sizes.join(key, sizes["source"].eqNullSafe(key["source"])).select("number", "place", "size")
    stops = _last_round(rows, goal.filter("part > 0").select("number", "part"))

    # Blocks per round over the source; the last round covers a part of it.
    words = [
        F.when(F.col("whole") > e, F.col("source_size")).when(F.col("whole") == e, F.col("part")).otherwise(0)
        for e in range(epochs)
    ]
    counts = F.array(*[F.ceil(w / block_words).cast("long") for w in words])
    goal = goal.join(stops, "number", "left").withColumn("rounds", counts)
    goal = cut(goal.withColumn("blocks", F.aggregate("rounds", F.lit(0).cast("long"), lambda a, x: a + x)))
    total = goal.agg(F.sum("target")).first()[0] or 0
    shards = max(1, int(np.ceil(total / shard_words)))
    quotas = split_tree(goal.filter("blocks > 0").select("number", "blocks"), shards, seed)
    before = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    runs = quotas.withColumn("from", F.coalesce(F.sum("blocks").over(before), F.lit(0)))
    slots = cut(
        runs.select(
            "number", "shard", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("blocks") - 1)).alias("slot")
        )
    )

    inner = ("source_size", "target", "whole", "number", "rounds", "blocks", "part", "large", "small")
    kept, goal_of, aim = [F.col(f"`{c}`") for c in docs.columns], fresh(docs, "goal_of"), fresh(docs, "goal")
    side = maybe_broadcast(goal.select(F.col("source").alias(goal_of), F.struct(*inner).alias(aim)))
    m, g = F.col(column), F.col(aim)
    info = F.struct(size.alias("size"), place.alias("place"))
    out = d.withColumn(column, info).drop(*([at] if at != column else []))
    out = out.join(side, out[source].eqNullSafe(side[goal_of])).drop(goal_of)
    stop = F.when(m["size"] * GRAIN > g["part"], g["large"]).otherwise(g["small"])
    extra = _inside(m["place"], stop)
    copies = (g["whole"] + extra.cast("int")).alias("copies")
    carried = [g[c].alias(c) for c in ("source_size", "target", "number", "rounds", "blocks")]
    out = out.select(*kept, F.struct(m["size"], m["place"], *carried, copies).alias(column))
    drawn = maybe_broadcast(slots)
    got = []
    for e in range(epochs):
        first = sum((m["rounds"][k] for k in range(e)), F.lit(0).cast("long"))
        block = F.pmod(F.xxhash64(m["place"], F.lit(e)), m["rounds"][e])
        slot = (first + block) * STEP % m["blocks"]
        names = {c: fresh(docs, f"drawn_{c}_{e}") for c in drawn.columns}
        each = drawn.select(*[F.col(c).alias(n) for c, n in names.items()])
        each = F.broadcast(each) if drawn is not slots else each
        slot = F.when(m["copies"] > e, slot)
        out = out.join(each, (m["number"] == F.col(names["number"])) & (slot == F.col(names["slot"])), "left")
        got.append(F.col(names["shard"]))
    shards_of = F.filter(F.array(*got), lambda x: x.isNotNull()).alias("shards")
    return out.select(
        *kept,
        F.struct(*[m[c] for c in ("size", "place", "source_size", "target", "copies")], shards_of).alias(column),
    )


def mixed(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The mix itself: a row per copy, shard by shard, shuffled within the shard."""
    rows = mix(docs, seed=seed, **options)
    m, shard, key = rows.columns[-1], fresh(rows, "shard"), fresh(rows, "key")
    each = rows.select(*docs.columns, F.posexplode(f"`{m}`.shards").alias(key, shard), F.col(f"`{m}`.place").alias(m))
    order = F.xxhash64(F.lit(seed), F.col(m), F.col(key))
    each = each.withColumn(key, order).repartition(F.col(shard)).sortWithinPartitions(shard, key)
    return each.select(*docs.columns)
