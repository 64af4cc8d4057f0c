"""Exact top-k by inner product: best-first search of one stored M-tree.

The tree is two tables.  ``leaves`` has a row per vector: its leaf page and its distance to the
page's routing object.  ``pages`` has a row per inner page: for each child its routing object, its
covering radius and its distance to the routing object of the page.  A name is the path from the root.

For a query q and a node with routing object c and radius r, no member scores more than q.c + |q| r.
By the triangle inequality q.c itself is at most q.parent + |q| d(c, parent), so many children and
vectors are left out without their product being computed.

All queries search together, in rounds.  A query keeps a frontier of nodes with their bounds; in a
round it opens the best of them, then drops all that cannot hold a better result, or an equal one,
than its k-th.  Rounds open ``WIDEN`` times as many nodes as the one before, so their number grows
with the logarithm of what has to be read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadastre.llm.common import maybe_broadcast, ship
from cadastre.sources.scratch import cut, settle

SCALE = 1024
FANOUT = 64
BLOCK = 1024  # vectors of a leaf page
TASK = 1 << 16  # vectors dealt to their nearest pivot at once
ASKED = 4096  # queries that meet a page at once
WIDEN = 4
SLACK = 1e-6  # relative, for the rounding of bounds

FRONTIER = "query_id long, node string, leaf boolean, bound double, product double"
RESULT = "query_id long, id long, score long"


def quantised(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, v): floor(scale * x) of each component as double.

    Vectors that are null or have a null or non-finite component are left out, and so are rows
    with a null id, which could not be named.  Equal rows stay.
    """
    x = F.col(vector).cast("array<double>")
    wrong = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(F.col(id).cast("long").alias("id"), x.alias("x"), wrong.alias("wrong"))
    rows = rows.filter("id is not null and x is not null and not wrong")
    return rows.select("id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v"))


def _far(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.linalg.norm(points - centre, axis=1)


@dataclass
class Tree:
    """leaves (node, id, v, gap) and pages (node, child, leaf, centre, radius, gap: arrays)."""

    leaves: DataFrame
    pages: DataFrame

    def write(self, folder: str) -> None:
        self.leaves.write.parquet(f"{folder}/leaves")
        self.pages.write.parquet(f"{folder}/pages")

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> Tree:
        return cls(spark.read.parquet(f"{folder}/leaves"), spark.read.parquet(f"{folder}/pages"))


def _dealt(vectors: DataFrame, block: int, fanout: int) -> DataFrame:
    """(node, id, v): vectors dealt to pivots of their node again and again, until all nodes are leaves.

    Pivots are some of the node's different vectors, the same on every run.  A node that they do not
    divide, as one of equal vectors, is divided by chance; any dealing is right, as radii are taken
    from the members.
    """
    salt = F.xxhash64(F.monotonically_increasing_id()).alias("salt")
    todo = cut(vectors.select("id", "v", salt, F.lit("r").alias("node"), F.lit(0).cast("long").alias("of")))
    done = []
    n = F.count("*").alias("n")
    different = F.approx_count_distinct(F.xxhash64("v")).alias("different")
    while True:
        large = todo.groupBy("node").agg(n, different, F.max("of").alias("of_parent")).filter(F.col("n") > block)
        parts = F.least(F.lit(fanout), F.ceil(2 * F.col("n") / block)).cast("int").alias("parts")
        whole = (F.col("n") == F.col("of_parent")).alias("whole")
        large = cut(large.select("node", "n", "different", parts, whole))
        if large.isEmpty():
            break
        rows = todo.join(maybe_broadcast(large), "node", "left")
        done.append(rows.filter("n is null").select("node", "id", "v"))
        rows = rows.filter("n is not null")
        chosen = F.pmod(F.xxhash64("v"), F.lit(1 << 40)) < F.lit(float(1 << 42)) * F.col("parts") / F.col("different")
        seen = rows.filter(~F.col("whole") & chosen).select("node", "n", "parts", F.xxhash64("v").alias("h"), "v").distinct()
        seen = seen.groupBy("node", "n", "parts").agg(F.array_sort(F.collect_list(F.struct("h", "v"))).alias("seen"))
        slices = F.ceil(F.col("n") / TASK)
        pivots = seen.select(
            F.col("node").alias("node"),  # a name of its own in the cogroup below
            F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)).alias("slice"),
            F.slice("seen", 1, F.col("parts")).getField("v").alias("pivots"),
        )
        chance = F.pmod(F.xxhash64("salt", "node"), F.col("parts")).alias("chance")
        rows = rows.select("node", F.pmod("salt", slices).alias("slice"), "id", "v", "salt", "n", chance)

        def deal(members, pivot):
            to = members["chance"].to_numpy()
            if len(members) and len(pivot):
                x = np.stack(members["v"]).astype("f8")
                p = np.stack(pivot["pivots"].iloc[0]).astype("f8")
                to = ((p**2).sum(axis=1) - 2 * x @ p.T).argmin(axis=1)
            node = [f"{name}.{i}" for name, i in zip(members["node"], to, strict=True)]
            return members[["id", "v", "salt"]].assign(node=node, of=members["n"])

        both = rows.groupBy("node", "slice").cogroup(pivots.groupBy("node", "slice"))
        todo = cut(both.applyInPandas(deal, "id long, v array<long>, salt long, node string, of long"))
    for part in done:
        todo = todo.select("node", "id", "v").unionByName(part)
    return todo.select("node", "id", "v")


def build(vectors: DataFrame, block: int = BLOCK, fanout: int = FANOUT) -> Tree:
    """The M-tree of (id, v); components missing at the end of a vector count as zero."""
    spark = vectors.sparkSession
    ship(spark)
    vectors = cut(vectors.select("id", "v"))
    dims = vectors.agg(F.max(F.size("v"))).first()[0] or 1
    vectors = vectors.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("v"))))

    def leaf(pdf):
        x = np.stack(pdf["v"]).astype("f8")
        centre = x.mean(axis=0)
        gap = _far(x, centre)
        head = [centre.tolist()] + [None] * (len(pdf) - 1)
        return pdf.assign(gap=gap, centre=head, radius=gap.max())

    schema = "node string, id long, v array<long>, gap double, centre array<double>, radius double"
    leaves = settle(_dealt(vectors, block, fanout).groupBy("node").applyInPandas(leaf, schema))

    def page(pdf):
        pdf = pdf.sort_values("node")
        x = np.stack(pdf["centre"])
        centre = x.mean(axis=0)
        gap = _far(x, centre)
        radius = pdf["radius"].to_numpy()
        return pd.DataFrame({
            "node": [pdf["parent"].iloc[0]], "child": [pdf["node"].tolist()], "leaf": [pdf["leaf"].tolist()],
            "centres": [x.tolist()], "radii": [radius.tolist()], "gaps": [gap.tolist()],
            "centre": [centre.tolist()], "radius": [float((gap + radius).max())],
        })

    inner = (
        "node string, child array<string>, leaf array<boolean>, centres array<array<double>>, "
        "radii array<double>, gaps array<double>, centre array<double>, radius double"
    )
    depth = F.regexp_count("node", F.lit(r"\."))
    balls = leaves.filter("centre is not null").select("node", "centre", "radius", F.lit(True).alias("leaf"))
    above = spark.createDataFrame([], inner)
    pages = [above]
    deepest = balls.agg(F.max(depth)).first()[0] or 0
    for level in range(deepest, 0, -1):
        nodes = above.select("node", "centre", "radius", F.lit(False).alias("leaf"))
        nodes = nodes.unionByName(balls.filter(depth == level))
        parent = F.regexp_replace("node", r"\.[0-9]+$", "").alias("parent")
        above = cut(nodes.select("*", parent).groupBy("parent").applyInPandas(page, inner))
        pages.append(above)
    table = pages[0]
    for more in pages[1:]:
        table = table.unionByName(more)
    return Tree(leaves.select("node", "id", "v", "gap"), settle(table.drop("centre", "radius")))


def _slack(bound: np.ndarray | float, size: float) -> np.ndarray | float:
    return bound + SLACK * (1 + size) * (1 + np.abs(bound))


def _opened(page: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """The children of an inner page that may hold results of the queries that ask it."""
    out = []
    if len(page) and len(asked):
        p = page.iloc[0]
        centres, radii, gaps = np.stack(p["centres"]), np.asarray(p["radii"]), np.asarray(p["gaps"])
        child, leaf = np.asarray(p["child"], object), np.asarray(p["leaf"])
        for i, v, product, bar in zip(asked["query_id"], asked["v"], asked["product"], asked["bar"], strict=True):
            q = v.astype("f8")
            size = float(np.linalg.norm(q))
            # The product with the page's own routing object bounds those with the children's.
            maybe = np.flatnonzero(_slack(product + size * (gaps + radii), size) >= bar) if np.isfinite(product) else np.arange(len(gaps))
            products = centres[maybe] @ q
            bound = _slack(products + size * radii[maybe], size)
            near = bound >= bar
            out.append(pd.DataFrame({
                "query_id": i, "node": child[maybe][near], "leaf": leaf[maybe][near], "bound": bound[near], "product": products[near],
            }))
    columns = ["query_id", "node", "leaf", "bound", "product"]
    return pd.concat(out) if out else pd.DataFrame(columns=columns)


def _searched(k: int) -> Callable:
    def search(members: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        """Of a leaf page, the k best vectors of each query that asks it, no score below its bar."""
        out = []
        if len(members) and len(asked):
            ids, vectors = members["id"].to_numpy("i8"), np.stack(members["v"]).astype("i8")
            gaps = members["gap"].to_numpy()
            for i, v, product, bar in zip(asked["query_id"], asked["v"], asked["product"], asked["bar"], strict=True):
                size = float(np.linalg.norm(v.astype("f8")))
                maybe = (_slack(product + size * gaps, size) >= bar) if np.isfinite(product) else np.ones(len(ids), bool)
                maybe &= ids != i
                names, scores = ids[maybe], vectors[maybe] @ v.astype("i8")
                best = np.lexsort((names, -scores))[:k]
                best = best[scores[best] >= bar]
                out.append(pd.DataFrame({"query_id": i, "id": names[best], "score": scores[best]}))
        return pd.concat(out) if out else pd.DataFrame(columns=["query_id", "id", "score"])

    return search


def _meet(nodes: DataFrame, asked: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Each page with the queries that ask it; a page that very many ask is copied."""
    parts = asked.groupBy("node").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("parts"))
    parts = maybe_broadcast(cut(parts))
    copies = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    nodes = nodes.join(parts, "node").select("*", copies)
    asked = asked.join(parts, "node").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int"))
    return nodes.groupBy("node", "part").cogroup(asked.groupBy("node", "part")).applyInPandas(fn, schema)


def search(tree: Tree, queries: DataFrame, k: int = 10, trace: list | None = None) -> DataFrame:
    """(query_id, rank, id, score) of the k best vectors of each query (id, v), its own id left out.

    With fewer than k candidates all are returned.  Of rows with equal ids each is a candidate, and
    a query that occurs twice is answered once.  ``trace`` gets the inner and leaf pages asked per round.
    """
    spark = queries.sparkSession
    ship(spark)
    # The product of a longer query with what the tree's vectors lack is zero.
    dims = tree.leaves.agg(F.max(F.size("v"))).first()[0] or 0
    v = F.slice(F.concat("v", F.array_repeat(F.lit(0).cast("long"), dims)), 1, dims)
    queries = cut(queries.dropDuplicates(["id"]).select(F.col("id").alias("query_id"), v.alias("v")))
    no_bar, best = float("-inf"), spark.createDataFrame([], RESULT)
    root = tree.pages.isEmpty()
    frontier = queries.select(
        "query_id", F.lit("r").alias("node"), F.lit(root).alias("leaf"), F.lit(float("inf")).alias("bound"), F.lit(float("inf")).alias("product")
    )
    by_bound = Window.partitionBy("query_id").orderBy(F.desc("bound"), "node")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    width = 1
    while True:
        full = best.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("bar"))
        full = full.filter(F.col("n") >= k).select("query_id", "bar")
        live = frontier.join(full, "query_id", "left").withColumn("bar", F.coalesce("bar", F.lit(no_bar)))
        live = live.filter("bound >= bar").withColumn("nth", F.row_number().over(by_bound))
        live = cut(live)
        if live.isEmpty():
            break
        asked = live.filter(F.col("nth") <= width).join(queries, "query_id")
        pages, leaves = asked.filter("not leaf"), asked.filter("leaf")
        if trace is not None:
            trace.append((pages.count(), leaves.count()))
        opened = _meet(tree.pages, pages.select("node", "query_id", "v", "product", "bar"), _opened, FRONTIER)
        found = _meet(tree.leaves, leaves.select("node", "query_id", "v", "product", "bar"), _searched(k), RESULT)
        ranked = best.unionByName(found).withColumn("rank", F.row_number().over(by_score))
        best = cut(ranked.filter(F.col("rank") <= k).select("query_id", "id", "score"))
        rest = live.filter(F.col("nth") > width).select("query_id", "node", "leaf", "bound", "product")
        frontier = rest.unionByName(opened)
        width *= WIDEN
    return best.select("query_id", F.row_number().over(by_score).alias("rank"), "id", "score")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, block: int = BLOCK, fanout: int = FANOUT) -> DataFrame:
    """``search`` of a tree built for the occasion; both inputs are (id, v) as ``quantised`` gives them."""
    return search(build(vectors, block, fanout), queries, k)
