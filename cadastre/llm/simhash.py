"""Near duplicates by SimHash, linked through a Gray-order hierarchical index.

Distinct fingerprints are dealt to buckets by the bits they share; inside a bucket they are sorted
by Gray rank, pages of neighbours become nodes that hold the bits all members share, and upper
nodes take over what their children have in common.  A search adds up differences on the way down
and drops a whole node as soon as they exceed the limit.

Buckets: if two fingerprints differ in at most ``limit`` bits, then of ``limit + 1`` runs of bits
one at least is equal.  So every fingerprint goes to one bucket per run.  A bucket with more than
``max_bucket`` members is split in the same way by its remaining bits; a bucket with r bits left
has 2^r fingerprints at most, so the splitting ends and nothing is dropped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastre.llm.common import fits_broadcast, fresh, in_parts, maybe_broadcast, ship
from cadastre.sources.scratch import cut

SEED = 42
LIMIT = 2
MAX_BUCKET = 4096
LEAF, FAN = 16, 16
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included; 0 without words.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` splits at space and \\x09-\\x0D only.
    """
    return _fingerprint(_words(text), shingle)


def _words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def _shingles(words: list[bytes], shingle: int):
    if len(words) < shingle:
        return [b" ".join(words)]
    return map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))


def _fingerprint(words: list[bytes], shingle: int) -> int:
    if not words:
        return 0
    parts = _shingles(words, shingle)
    n, ones, hashes = 0, np.zeros(64, np.int64), []
    digest = xxhash.xxh64_intdigest
    for part in parts:
        hashes.append(digest(part, SEED))
        if len(hashes) == BLOCK:
            n, hashes = n + BLOCK, _count(hashes, ones)
    n += len(hashes)
    _count(hashes, ones)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _count(hashes: list[int], ones: np.ndarray) -> list[int]:
    if hashes:
        bits = np.unpackbits(
            np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        ones += bits.sum(axis=0, dtype=np.int64)
    return []


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3):
    """(id, fp) per row; fp is the fingerprint as a signed 64-bit number."""
    ship(docs.sparkSession)

    def run(batches):
        for pdf in in_parts(batches):
            fps = np.array([fingerprint(t, shingle) for t in pdf["text"]], "u8").view("i8")
            yield pd.DataFrame({"id": pdf["id"], "fp": fps})

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, f"id {kind}, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of a code word in the reflected Gray sequence; neighbours there differ in one bit."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


class GrayIndex:
    """Hierarchical index over distinct fingerprints in Gray order."""

    def __init__(self, fps: np.ndarray):
        self.order = np.argsort(gray_rank(fps), kind="stable")
        self.fps = fps[self.order]
        low = np.arange(0, len(fps), LEAF)
        same = ~(np.bitwise_and.reduceat(self.fps, low) ^ np.bitwise_or.reduceat(self.fps, low))
        self.mask, self.pattern = [same], [self.fps[low] & same]
        while len(self.mask[-1]) > FAN:
            mask, pattern = self.mask[-1], self.pattern[-1]
            low = np.arange(0, len(mask), FAN)
            both = np.bitwise_and.reduceat(mask, low)
            equal = ~(np.bitwise_and.reduceat(pattern, low) ^ np.bitwise_or.reduceat(pattern, low))
            self.mask.append(both & equal)
            self.pattern.append(pattern[low] & both & equal)
        # What a node shares with its parent is compared there only.
        self.own = [m & ~np.repeat(up, FAN)[: len(m)] for m, up in zip(self.mask, self.mask[1:])]
        self.own.append(self.mask[-1])

    def near(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of (query, member) pairs that differ in at most ``limit`` bits."""
        top = len(self.mask[-1])
        q = np.repeat(np.arange(len(queries)), top)
        node = np.tile(np.arange(top), len(queries))
        so_far = np.zeros(len(q), np.uint8)
        for level in range(len(self.mask) - 1, -1, -1):
            differ = (queries[q] ^ self.pattern[level][node]) & self.own[level][node]
            so_far = so_far + np.bitwise_count(differ)
            keep = so_far <= limit
            q, node, so_far = q[keep], node[keep], so_far[keep]
            fan, size = (FAN, len(self.mask[level - 1])) if level else (LEAF, len(self.fps))
            parent = node
            node = (node[:, None] * fan + np.arange(fan)).ravel()
            q, so_far, parent = np.repeat(q, fan), np.repeat(so_far, fan), np.repeat(parent, fan)
            inside = node < size
            q, node, so_far, parent = q[inside], node[inside], so_far[inside], parent[inside]
        differ = (queries[q] ^ self.fps[node]) & ~self.mask[0][parent]
        keep = so_far + np.bitwise_count(differ) <= limit
        return q[keep], node[keep]


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of a[i] and b[i] for all i; ``parent`` holds the smallest place of each class."""
    while True:
        a, b = parent[a], parent[b]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]


def bucket_links(fps: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the members of a bucket as the pairs within ``limit`` bits do.

    At most one link per member: a member and the first of its class in Gray order.
    """
    fps = np.unique(fps)
    if len(fps) < 2:
        return fps[:0], fps[:0]
    index = GrayIndex(fps)
    fps = index.fps
    parent = np.arange(len(fps))
    for low in range(0, len(fps), 256):
        q, member = index.near(fps[low : low + 256], limit)
        _unite(parent, q + low, member)
    linked = parent != np.arange(len(fps))
    return fps[linked], fps[parent[linked]]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _split(used: int, limit: int) -> list[int]:
    """The bits not in ``used``, in ``limit + 1`` runs of nearly equal length."""
    free = [i for i in range(64) if not used >> i & 1]
    runs = [free[len(free) * k // (limit + 1) : len(free) * (k + 1) // (limit + 1)] for k in range(limit + 1)]
    return [sum(1 << i for i in run) for run in runs]


def links(nodes: DataFrame, limit: int = LIMIT, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links (a, b) between the fingerprints of ``nodes(fp)``: as many as connect each class.

    No pair within ``limit`` bits is lost: it meets in a bucket, and a bucket's links keep what its pairs
    connect.  A bucket with no more than ``limit`` bits left is not split further.
    """
    ship(nodes.sparkSession)
    nodes = nodes.select("fp")

    def search(batches):
        for pdf in batches:
            found = [bucket_links(np.asarray(x, "i8").view("u8"), limit) for x in pdf["members"]]
            a, b = zip(*found, strict=True) if found else ([], [])
            whole = lambda x: np.concatenate([*x, np.zeros(0, "u8")]).view("i8")
            yield pd.DataFrame({"a": whole(a), "b": whole(b)})

    def buckets(rows: DataFrame, paths: dict[int, int]) -> DataFrame:
        """``paths``: number of a bucket family -> bits its members share."""
        each = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(_signed(m)).alias("mask")) for p, m in paths.items()])
        if "path" in rows.columns:
            each = F.filter(each, lambda x: F.floor(x["path"] / (limit + 1)) == F.col("path") + 1)
        return rows.select("fp", F.explode(each).alias("to")).select(
            F.col("to.path").alias("path"), F.col("fp").bitwiseAND(F.col("to.mask")).alias("key"), "fp"
        )

    # Children of path p are numbered (p + 1) * (limit + 1) and up, so that no number recurs.
    paths = {k: run for k, run in enumerate(_split(0, limit))}
    rows, out = buckets(nodes, paths), None
    while True:
        whole = [p for p, used in paths.items() if 64 - used.bit_count() <= limit]
        big = rows.filter(~F.col("path").isin(whole)) if whole else rows
        big = cut(big.groupBy("path", "key").count().filter(F.col("count") > max_bucket).drop("count"))
        hot = [r["path"] for r in big.select("path").distinct().collect()]  # one per family
        rest = rows
        if hot:
            small = fits_broadcast(big)
            rest = rows.join(F.broadcast(big) if small else big, ["path", "key"], "left_anti")
            if not small:  # so that the join may split a hot key before rows are grouped
                rest = rest.repartition("path", "key")
        grouped = rest.groupBy("path", "key").agg(F.collect_list("fp").alias("members"))
        grouped = grouped.filter(F.size("members") > 1).select("members")
        found = grouped.mapInPandas(search, "a long, b long")
        out = found if out is None else out.unionByName(found)
        if not hot:
            return out
        deeper = {
            (p + 1) * (limit + 1) + k: paths[p] | run
            for p in hot
            for k, run in enumerate(_split(paths[p], limit))
        }
        rows = buckets(rows.join(F.broadcast(big) if small else big, ["path", "key"]), deeper)
        paths = deeper


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges(a, b)``; root is the smallest node of the class.

    Alternates large-star and small-star steps until nothing changes; a step joins the links with
    one row per node, so a node with very many links is split like any skewed join.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now, seen = cut(pairs.distinct()), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(small.unionByName(low.withColumnRenamed("m", "v")).distinct())
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state


def classes(fps: DataFrame, limit: int = LIMIT, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(fp, root, component_id) per distinct fingerprint of ``fps(id, fp)``.

    root names the class; component_id is the smallest id reachable over links; null only if all ids of a class are null.
    """
    nodes = cut(fps.groupBy("fp").agg(F.min("id").alias("first")))
    roots = components(links(nodes, limit, max_bucket))
    linked = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    lowest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    return linked.join(lowest, "root").select("fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    limit: int = LIMIT,
    max_bucket: int = MAX_BUCKET,
) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits) and component_id.

    Null and empty texts have fingerprint zero and are linked like any other; repeated rows are
    returned as often as they occur; an empty table gives an empty result.
    """
    fps = cut(fingerprints(docs, id, text, shingle))
    found = classes(fps, limit, max_bucket)
    return fps.join(found, "fp").select(
        F.col("id").alias(id),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_per_class(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    limit: int = LIMIT,
    max_bucket: int = MAX_BUCKET,
) -> DataFrame:
    """The documents with one of each class of ``near_duplicates`` left: that with the smallest id.

    All columns are kept.  Rows are told apart by id and text.  Null ids come last; of equal rows one
    stays.  Texts without words are a class; an empty table stays empty.
    """
    key = fresh(docs, "_text_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col(text)))
    rows = keyed.select(F.struct(F.col(id).alias("doc"), F.col(key).alias("hash")).alias("id"), F.col(text).alias("text"))
    order = F.struct(F.col("id.doc").isNull(), "id.doc", "id.hash")  # min alone would put nulls first
    fps = cut(fingerprints(rows, "id", "text", shingle).select("id.doc", "id.hash", "fp", order.alias("order")))
    nodes = cut(fps.groupBy("fp").agg(F.min("order").alias("first"), F.count("*").alias("n")))
    roots = maybe_broadcast(components(links(nodes, limit, max_bucket)))
    found = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    kept = found.groupBy("root").agg(F.min("first").alias("kept"))
    found = cut(found.join(kept, "root").select("fp", "kept"))
    gone = cut(fps.join(maybe_broadcast(found), "fp").filter("order <> kept").select("doc", "hash").distinct())
    same_row = lambda a, b: a[id].eqNullSafe(b["doc"]) & (a[key] == b["hash"])
    side = maybe_broadcast(gone)
    left = keyed.join(side, same_row(keyed, side), "left_anti")
    again = cut(fps.groupBy("doc", "hash").count().filter("count > 1").select("doc", "hash"))
    if again.isEmpty():
        return left.drop(key)
    side = maybe_broadcast(again)
    rest = left.join(side, same_row(left, side), "left_anti")
    side = maybe_broadcast(again)
    repeated = left.join(side, same_row(left, side), "left_semi").dropDuplicates([id, key])
    return rest.unionByName(repeated).drop(key)
