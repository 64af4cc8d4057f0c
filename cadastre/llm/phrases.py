"""Collocations: suffix pointers sorted by multikey three-way quicksort, counts from equal partitions.

1. Words are counted per language.  Words seen less than ``least`` times are in no candidate.
2. A suffix pointer is a place in a text; its key is the words from there on, up to the longest phrase,
   the end of the piece or an infrequent word.  Pointers with equal keys in a block of text become one
   with a weight.  Pointers are routed by their leading words: by the first word; if that is one of very
   many places, by the first two; if the second is such a word too, by all.  So no route grows with one
   key, and its pointers see all places of the phrases they may count.
3. A route is sorted by multikey three-way quicksort to the maximum depth.  The weight of an equal
   partition is the count of its phrase; partitions below ``least`` are abandoned, except where a phrase is
   dealt over several routes, whose counts are added up.

Which words are infrequent or very common is told to the tasks by bitmaps over hashes, of at most
``MAX_BITS`` bits at any size of the vocabulary.  A hash shared with a frequent word keeps a word in and one
shared with a common word routes a word deeper, which changes no result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastre.llm.common import maybe_broadcast, ship
from cadastre.llm.words import byte_table, split
from cadastre.sources.scratch import settle

BREAKS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes.maketrans(bytes(range(0x41, 0x5B)) + BREAKS + b"\t", bytes(range(0x61, 0x7B)) + b"\n" * len(BREAKS) + b" ")
OF_WORD = byte_table(b" \n")
UNKNOWN = "und"
MAX_WORDS, LEAST, TOP, COVER = 3, 10, 2000, 50
BLOCK = 4 << 20  # bytes; its different words number less than 2^21, so that three fit one 64-bit key
ROUTE = 1 << 20  # suffix pointers of a task
HELD = 500_000  # different words a task counts before it hands them on
MAX_BITS = 1 << 27
END = -1


def blocks(batches, keep: int, size: int = BLOCK) -> Iterator[tuple[str, bytes, int]]:
    """(language, text, tail): texts of one language, pieces apart by line ends; ``tail`` words at the end
    only follow the others, and begin the next block."""
    waiting: dict[str, list[bytes]] = {}
    held: Counter = Counter()
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            if not text:
                continue
            data = text.translate(TABLE)
            while len(data) > size:
                part, tail, data = _front(data, keep, size)
                yield lang, part, tail
            waiting.setdefault(lang, []).append(data)
            held[lang] += len(data)
            full = [lang] if held[lang] > size else list(held) if held.total() > 4 * size else []
            for k in full:
                yield k, b"\n".join(waiting.pop(k)), 0
                del held[k]
    for lang, texts in waiting.items():
        yield lang, b"\n".join(texts), 0


def _front(data: bytes, keep: int, size: int) -> tuple[bytes, int, bytes]:
    """(the first ``size`` bytes or so, words of it that the rest needs, the rest with these words)."""
    high = data.rfind(b"\n", 0, size)
    if high > 0:
        return data[:high], 0, data[high + 1 :]
    ends = [x for x in (data.find(b" ", size), data.find(b"\n", size)) if x >= 0]
    if not ends:
        return data, 0, b""
    high = min(ends)
    if data[high : high + 1] == b"\n":
        return data[:high], 0, data[high + 1 :]
    last = data[data.rfind(b"\n", 0, high) + 1 : high].rsplit(None, keep)
    carried = last[-keep:] if keep else []
    return data[:high], len(carried), b" ".join(carried) + data[high:]


def _block_words(data: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(different words, which of them each word is, piece of each word)."""
    raw = np.frombuffer(data, "u1")
    words, low = split(raw, OF_WORD, np.zeros(0, "i8"))
    coded = words.dictionary_encode()
    piece = np.cumsum(raw == 10, dtype="i4")[low]
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype("i8"), piece


def word_counts(texts: DataFrame, max_words: int, least: int) -> DataFrame:
    """(lang, phrase, f) for the words of ``texts(lang, text)`` seen ``least`` times; phrase null: all words."""

    def run(batches):
        counts: dict[str, Counter] = {}
        entries = 0

        def out():
            for lang, mine in counts.items():
                words = pa.array([*mine.keys(), None], pa.binary()).cast(pa.string())
                n = pa.array([*mine.values(), mine.total()], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n), pa.string()), words, n], names=["lang", "phrase", "n"]
                )

        for lang, data, tail in blocks(batches, max_words - 1):
            words, ids, _ = _block_words(data)
            found = np.bincount(ids[: len(ids) - tail], minlength=len(words)).tolist()
            mine = counts.setdefault(lang, Counter())
            entries -= len(mine)
            for w, n in zip(words, found, strict=True):
                mine[w] += n
            entries += len(mine)
            if entries > HELD:
                yield from out()
                counts, entries = {}, 0
        yield from out()

    rows = texts.mapInArrow(run, "lang string, phrase string, n long")
    return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).filter(F.col("phrase").isNull() | (F.col("f") >= least))


def _hash(lang: str, words: list[bytes]) -> np.ndarray:
    """As ``_hash_column``; hashes of the words of a language."""
    head, digest = lang.encode() + b" ", xxhash.xxh64_intdigest
    return np.fromiter((digest(head + w, 42) for w in words), "u8", len(words))


def _hash_column() -> Column:
    return F.xxhash64(F.concat("lang", F.lit(" "), "phrase"))


def bitmap(words: DataFrame, bits: int) -> np.ndarray:
    """Bytes of a bitmap with the hashes of ``words(lang, phrase)`` set; ``bits`` / 8 of them reach the driver."""
    bit = F.pmod(_hash_column(), F.lit(bits)) + 1
    parts = words.groupBy(F.bitmap_bucket_number(bit).alias("part"))
    parts = parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = np.zeros(max(bits // 8, 4096), "u1")
    for r in parts.collect():
        low = (r["part"] - 1) * 4096
        out[low : low + 4096] = np.frombuffer(r["bits"], "u1")
    return out


def _marked(bitmap: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    bit = (hashes % np.uint64(bits)).astype("i8")
    return (bitmap[bit >> 3] >> (bit & 7).astype("u1") & 1).astype(bool)


def suffixes(lang: str, data: bytes, tail: int, depth: int, frequent, common, bits: int, routes: int):
    """((level, route), words, keys, weights) of the suffix pointers of a block, one per route.

    ``keys`` has a row per pointer and names places in ``words``; END follows the last word of a phrase.
    Pointers without two frequent words are left out.
    """
    words, ids, piece = _block_words(data)
    if len(ids) < 2:
        return
    hashes = _hash(lang, words)
    good, hot = _marked(frequent, bits, hashes), _marked(common, bits, hashes)
    n = len(ids) - tail
    keys = np.full((n, depth), END, "i8")
    going = np.ones(n, bool)
    for d in range(depth):
        m = max(0, min(n, len(ids) - d))
        going[m:] = False
        going[:m] &= (piece[d : d + m] == piece[:m]) & good[ids[d : d + m]]
        keys[:m, d] = np.where(going[:m], ids[d : d + m], END)
    keys = keys[keys[:, 1] != END]
    if not len(keys):
        return
    if depth == 3 and len(words) < 1 << 20:
        wide = np.int64(len(words) + 1)
        one, weights = np.unique((keys[:, 0] * wide + keys[:, 1]) * wide + keys[:, 2] + 1, return_counts=True)
        keys = np.stack([one // (wide * wide), one // wide % wide, one % wide - 1], axis=1)
    else:
        keys, weights = np.unique(keys, axis=0, return_counts=True)
    level = np.where(hot[keys[:, 0]], np.where(hot[keys[:, 1]], depth, 2), 1)
    mixed = hashes[keys[:, 0]]
    for d in range(1, depth):
        here = (level > d) & (keys[:, d] != END)
        mixed = np.where(here, (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[keys[:, d]], mixed)
    route = ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(routes)).astype("i8")
    where = level * routes + route
    order = np.argsort(where, kind="stable")
    edges = np.flatnonzero(np.diff(where[order], prepend=-1, append=-1))
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        mine = order[low:high]
        own = keys[mine]
        used, named = np.unique(own, return_inverse=True)
        skip = int(used[0] == END)
        own = named.reshape(own.shape) - skip
        to = int(where[mine[0]])
        yield divmod(to, routes), [words[i] for i in used[skip:]], own, weights[mine]


def count_phrases(keys: np.ndarray, weights: np.ndarray, least: int, added_up: bool) -> Iterator[tuple[int, int, int]]:
    """(pointer, words, count) per phrase of two words or more, by multikey three-way quicksort.

    ``keys[d]`` holds the words of all pointers at depth d.  Partitions lighter than ``least`` are abandoned;
    with ``added_up`` only the whole keys' are, since shorter phrases have other pointers elsewhere.
    """
    depth = len(keys)
    work = [(np.arange(keys.shape[1]), 0)]
    while work:
        pointers, d = work.pop()
        bound = 1 if added_up and d < depth - 1 else least
        while len(pointers):
            k = keys[d][pointers]
            pivot = k[len(k) >> 1]
            w = weights[pointers]
            same, below = k == pivot, k < pivot
            count = int(w[same].sum())
            if pivot != END and count >= bound:
                equal = pointers[same]
                if d:
                    yield int(equal[0]), d + 1, count
                if d + 1 < depth:
                    work.append((equal, d + 1))
            lower = int(w[below].sum())
            if lower >= bound:
                work.append((pointers[below], d))
            if int(w.sum()) - count - lower < bound:
                break
            pointers = pointers[~(same | below)]


def phrase_counts(texts: DataFrame, vocabulary: DataFrame, max_words: int, least: int, route: int = ROUTE) -> DataFrame:
    """(lang, phrase, size, f) for all phrases of 2 to ``max_words`` words seen ``least`` times."""
    known = vocabulary.filter("phrase is not null")
    sizes = known.agg(F.count("*").alias("words"), F.coalesce(F.sum("f"), F.lit(0)).alias("places")).first()
    bits = 1 << 15
    while bits < min(16 * sizes["words"], MAX_BITS):
        bits *= 2
    frequent = bitmap(known, bits)
    common = bitmap(known.filter(F.col("f") > route), bits)
    routes = max(1, -(-sizes["places"] // route))

    def deal(batches):
        for lang, data, tail in blocks(batches, max_words - 1):
            found = list(suffixes(lang, data, tail, max_words, frequent, common, bits, routes))
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(found), pa.string()),
                    "level": pa.array([at[0] for at, *_ in found], pa.int32()),
                    "route": pa.array([at[1] for at, *_ in found], pa.int64()),
                    "words": pa.array([b"\n".join(x[1]) for x in found], pa.binary()),
                    "keys": pa.array([_narrow(x[2] - END) for x in found], pa.binary()),
                    "weights": pa.array([_narrow(x[3]) for x in found], pa.binary()),
                }
            )

    def sort(key, pdf):
        held = [x.split(b"\n") for x in pdf["words"]]
        base = np.cumsum([0, *map(len, held[:-1])])
        coded = pa.array([w for x in held for w in x], pa.binary()).dictionary_encode()
        name = np.append(coded.indices.to_numpy().astype("i8"), END)  # the last place is END's
        words = coded.dictionary.to_pylist()
        keys = []
        for low, x in zip(base, pdf["keys"], strict=True):
            own = _wide(x).reshape(-1, max_words) + END
            keys.append(name[np.where(own == END, len(name) - 1, own + low)])
        keys = np.ascontiguousarray(np.concatenate(keys).T)
        weights = np.concatenate([_wide(x) for x in pdf["weights"]])
        added_up = bool(pdf["level"].iloc[0] > 2)
        found = list(count_phrases(keys, weights, least, added_up))
        phrases = [b" ".join(words[i] for i in keys[:size, p]).decode() for p, size, _ in found]
        lang = [pdf["lang"].iloc[0]] * len(found)
        out = {"phrase": phrases, "size": [x[1] for x in found], "f": [x[2] for x in found], "lang": lang}
        return pd.DataFrame(out, dtype=object)

    dealt = texts.mapInArrow(deal, "lang string, level int, route long, words binary, keys binary, weights binary")
    found = dealt.groupBy("lang", "level", "route").applyInPandas(sort, "phrase string, size int, f long, lang string")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)


def _narrow(x: np.ndarray) -> bytes:
    """Whole numbers from 0 on as bytes, after the width of one."""
    width = 1 if x.max(initial=0) < 1 << 8 else 2 if x.max() < 1 << 16 else 4
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def _wide(x: bytes) -> np.ndarray:
    return np.frombuffer(x, f"<u{x[0]}", offset=1).astype("i8")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    max_words: int = MAX_WORDS,
    least: int = LEAST,
    top: int = TOP,
    cover: int = COVER,
    route: int = ROUTE,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``top`` phrases of each language.

    a, l and r are the counts of a phrase and of its parts at the lowest-scoring cut, n that of all words,
    score floor(10^6 a a / (l r)) in decimal arithmetic, exact to 10^15 occurrences.  A phrase goes if one
    that holds it occurs at least ``cover`` percent as often.  A null language is ``und``; null, empty and
    blank texts have no phrases; equal rows count as often as they occur; an empty table gives no rows.
    Other columns are not looked at.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    words = settle(word_counts(texts, max_words, least))
    known = words.filter("phrase is not null")
    found = settle(phrase_counts(texts, words, max_words, least, route))
    units = settle(known.unionByName(found.select("lang", "phrase", "f")))
    side = maybe_broadcast(units)

    parts = F.split("phrase", " ")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang",
        "phrase",
        F.col("f").alias("a"),
        "k",
        F.array_join(F.slice(parts, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(parts, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(side.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)), ["lang", part])
    long = lambda c: F.col(c).cast("decimal(15,0)")
    score = F.expr("(cast(1000000 as decimal(7,0)) * cast(a * a as decimal(31,0))) div (l * r)")
    exact = cuts.withColumns({c: long(c) for c in ("a", "l", "r")}).withColumn("score", score)
    scored = exact.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("best"))

    inside = F.expr(
        "flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1),"
        " i -> array_join(slice(split(phrase, ' '), i, m), ' '))))"
    )
    longer = found.filter("size > 2").select("lang", F.explode(F.array_distinct(inside)).alias("phrase"), F.col("f").alias("over"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("over").alias("over"))
    left = scored.join(longer, ["lang", "phrase"], "left")
    left = left.filter(F.coalesce(100 * F.col("over") < F.lit(cover) * F.col("best.a"), F.lit(True)))

    totals = words.filter("phrase is null").select("lang", F.col("f").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.col("best.score").desc(), F.col("best.a").desc(), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    number = [F.col(f"best.{c}").cast("long").alias(c) for c in ("a", "l", "r")]
    return ranked.join(maybe_broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", *number, "n", F.col("best.score").cast("long").alias("score")
    )
