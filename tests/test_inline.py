"""Lookups inside a row, the route trie, salted joins and chunked texts against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from cadastre.operators import lookup, routes, skew
from cadastre.operators.inline import entry, hash_table
from cadastre.streaming import jobs


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hash_table_finds_every_entry(spark):
    rows = [(g, k, f"{g}{k}") for g in "ab" for k in range(50 if g == "a" else 1)] + [("a", None, "null")]
    side = spark.createDataFrame(rows, "g string, k long, v string")
    tables = hash_table(side, ["k"], "table", "g")
    asked = spark.createDataFrame([("a", k) for k in (*range(-1, 51), None)] + [("b", 0), ("c", 0)], "g string, k long")
    got = {(r["g"], r["k"]): r["v"] for r in asked.join(tables, "g", "left").select("g", "k", entry(F.col("table"), k=F.col("k"))["v"].alias("v")).collect()}
    want = {(g, k): f"{g}{k}" for g, k, _ in rows if k is not None}
    assert got == {(r["g"], r["k"]): want.get((r["g"], r["k"])) for r in asked.collect()}
    assert hash_table(side.limit(0), ["k"], "table").count() == 0


def plain_route(path, table):
    """The first registered route that matches; a table of (mount_at, reg_key, exact)."""
    found = []
    for mount, key, exact in table:
        if exact:
            hit = path == mount
        elif mount == "/":
            hit = True
        else:
            hit = path is not None and mount.startswith("/") and (path == mount or path.startswith(f"{mount}/"))
        if hit:
            found.append((key, mount))
    return min(found)[1] if found else None


@pytest.mark.parametrize("everywhere", [True, False])
def test_trie_against_every_route(spark, everywhere):
    rng = random.Random(4)
    path = lambda deep: "".join(f"/{rng.choice(['a', 'b', 'ab', '', 'é', 'x.y'])}" for _ in range(rng.randint(1, deep)))
    table = list({(path(10), i, rng.random() < 0.2) for i in range(400)})
    table += [("/", 9000, True), ("x", 1, True), ("y", 2, False), ("/a", 500, False), ("/a", 100, False)]
    table += [("/", 50, False)] if everywhere else []
    asked = [path(12) for _ in range(600)] + [m for m, *_ in table] + ["/", "", "x", "x/y", "y", "y/z", None, "//", "/a/"]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(asked)], "i int, path string")
    known = spark.createDataFrame(table, "mount_at string, reg_key int, exact boolean").withColumn("endpoint", F.lit("e"))
    got = {r["i"]: r["route"]["mount_at"] if r["route"] else None for r in routes.resolve_routes(frame, known, "path").collect()}
    assert got == {i: plain_route(p, table) for i, p in enumerate(asked)}


@pytest.mark.parametrize("depth", [1, 10])
def test_one_join_whatever_the_depth(spark, tmp_path, depth):
    known = [("/a" * d, d, "e") for d in range(1, depth + 1)]
    known = spark.createDataFrame(known, "mount_at string, reg_key int, endpoint string")
    frame = spark.createDataFrame([("/a/a/b",), ("/b",)], "path string")
    assert plan_of(routes.resolve_routes(frame, known, "path")).count("BroadcastHashJoin") == 1
    frame.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    routed = routes.resolve_routes(stream, known, "path")
    assert routed._jdf.queryExecution().analyzed().toString().count("Join") == 1
    got = jobs.run_available(routed.select("path", "route.mount_at"), str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect()), key=str) == [("/a/a/b", "/a"), ("/b", None)]


def test_routes_too_many_to_broadcast(spark, monkeypatch):
    rng = random.Random(5)
    path = lambda: "".join(f"/{rng.choice('abc')}" for _ in range(rng.randint(1, 5)))
    table = list({(path(), i, False) for i in range(40)}) + [("/", 90, True)]
    asked = [path() for _ in range(200)] + ["/"]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(asked)], "i int, path string")
    known = spark.createDataFrame(table, "mount_at string, reg_key int, exact boolean").withColumn("endpoint", F.lit("e"))
    monkeypatch.setattr(routes, "fits_broadcast", lambda df: False)
    got = {r["i"]: r["route"]["mount_at"] if r["route"] else None for r in routes.resolve_routes(frame, known, "path").collect()}
    assert got == {i: plain_route(p, table) for i, p in enumerate(asked)}


ARRAYS = [(1, ["a", "b", "a", None, "zz"]), (2, []), (3, None), (4, ["é"])]


@pytest.mark.parametrize("small", [True, False])
def test_array_lookup_on_a_stream(spark, tmp_path, monkeypatch, small):
    frame = spark.createDataFrame(ARRAYS, "i int, ids array<string>")
    dim = spark.createDataFrame([("a", 1, "x"), ("b", None, "y"), ("é", 3, None)], "k string, n int, t string")
    frame.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    want = lookup.array_lookup(frame, "ids", dim, "k", ["i"])
    if small:
        plan = plan_of(lookup.array_lookup_inside(frame, "ids", dim, "k", "found"))
        assert "Generate" not in plan and "Exchange hashpartitioning" not in plan
    monkeypatch.setattr(jobs, "fits_broadcast", lambda df: small)
    got = jobs.array_lookup_stream(stream, "ids", dim, "k", ["i"], str(tmp_path / "out"))
    rows = lambda df: sorted(map(repr, df.select("i", "position", "k", "n", "t", "is_missing").collect()))
    assert rows(got) == rows(want) and len(rows(got)) == 6
    empty = lookup.array_lookup_inside(frame, "ids", dim.limit(0), "k", "found").collect()
    assert {r["i"]: r["found"] and [x["is_missing"] for x in r["found"]] for r in empty} == {1: [True] * 5, 2: [], 3: None, 4: [True]}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_returns_what_a_join_does(spark, how):
    rows = [(i, "hot" if i % 10 else f"k{i % 70}") for i in range(3000)] + [(-1, None)] * 900 + [(-2, "none")]
    df = spark.createDataFrame(rows, "i int, k string")
    dim = spark.createDataFrame([("hot", 1)] + [(f"k{j}", j) for j in range(0, 70, 20)], "k string, v int")
    got = skew.salted_join(df, dim, ["k"], how).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, df.join(dim, "k", how).collect()))


def test_no_task_of_a_hot_batch_has_twice_the_mean(spark, tmp_path):
    rows = spark.range(40000).select(F.when(F.col("id") % 10 > 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    rows.write.parquet(str(tmp_path / "in"))
    dim = spark.range(40000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    stream = spark.readStream.schema("k long, id long").parquet(str(tmp_path / "in"))
    counts = []

    def work(batch):
        joined = skew.salted_join(batch, dim.hint("merge"), ["k"], "inner")
        if batch.count():
            counts.extend(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        return joined

    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = jobs.run_batches(stream, str(tmp_path / "out"), work)
    finally:
        for k, x in old.items():
            spark.conf.set(k, x)
    assert got.count() == 40000 and got.filter("v <> 2 * k").count() == 0
    assert len(counts) == 32 and max(counts) <= 2 * sum(counts) / len(counts)


def test_batches_go_on_where_they_stopped(spark, tmp_path):
    place, state = str(tmp_path / "in"), str(tmp_path / "state")
    stream = lambda: spark.readStream.schema("id long").parquet(place)
    double = lambda batch: batch.select((F.col("id") * 2).alias("x"))
    spark.range(0).write.parquet(place)
    assert jobs.run_batches(stream(), state, double).count() == 0
    spark.range(3).write.mode("append").parquet(place)
    assert sorted(r["x"] for r in jobs.run_batches(stream(), state, double).collect()) == [0, 2, 4]
    spark.range(3, 5).write.mode("append").parquet(place)
    got = jobs.run_batches(stream(), state, double)
    assert got.columns == ["x"] and sorted(r["x"] for r in got.collect()) == [0, 2, 4, 6, 8]


@pytest.mark.parametrize("chunk", [1, 7, 1000, 10**6])
def test_text_is_the_same_in_any_number_of_chunks(spark, chunk):
    rows = [("p", i, None if i % 5 == 0 else f"t{i}") for i in range(-20, 1500)] + [("q", 10**9, "far"), ("q", 2, "near"), ("r", 1, None)]
    frame = spark.createDataFrame(rows, "parent string, position long, text string").repartition(5)
    got = lookup.ordered_concat(frame, ["parent"], "position", F.col("text"), "whole", "|", chunk).collect()
    want = {"p": "|".join(f"t{i}" for i in range(-20, 1500) if i % 5), "q": "near|far", "r": ""}
    assert {r["parent"]: r["whole"] for r in got} == want
