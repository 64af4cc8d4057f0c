"""Lookup joins, routes, targets, registration and layers against plain Python."""

import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cadastre.operators import catalogue as cat
from cadastre.operators import changes, lookup, overlay
from cadastre.operators.routes import catalogue_routes, resolve_routes
from cadastre.operators.skew import fits_broadcast, lookup_join
from cadastre.plans.catalogue import build_catalogue, catalogue_index, routes_of
from cadastre.sources.register import (
    RegistrationError,
    accepted,
    append_accepted,
    new_records,
    refusal_by_rule,
    register_records,
    rejected,
)
from cadastre.sources.scratch import scratch_folder


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows have key 1, a sixth have no key."""
    rng = random.Random(3)
    data = [
        (i, 1 if i % 3 == 0 else None if i % 6 == 1 else rng.randrange(2, 50)) for i in range(600)
    ]
    return spark.createDataFrame(data, "i int, k int").repartition(8).cache()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("small", [True, False, None])
def test_lookup_join_ways_agree(spark, skewed, how, small):
    dim = spark.createDataFrame([(k, k * 10) for k in range(1, 40)], "k int, d int")
    got = lookup_join(skewed, dim, ["k"], how, small)
    want = skewed.join(dim, ["k"], how)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


@pytest.mark.parametrize("how", ["right", "full", "cross"])
def test_lookup_join_refuses_kinds_that_cannot_be_split(spark, skewed, how):
    with pytest.raises(ValueError):
        lookup_join(skewed, skewed.select("k").distinct(), ["k"], how)


def test_hot_key_of_equal_rows_with_a_map_is_split(spark):
    """What the docstring says of adaptive execution, with its limits lowered."""
    limits = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k, x in limits.items():
            spark.conf.set(k, x)
        hot = spark.range(0, 20000, 1, 8).selectExpr("if(id % 2 = 0, 1, id) AS k", "map('a', 1) AS m")
        dim = spark.range(0, 3000, 1, 4).selectExpr("id AS k", "id AS d")
        joined = lookup_join(hot, dim, ["k"], "left", small=False)
        assert len(joined.collect()) == 20000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)


def test_broadcast_is_bounded_by_rows_and_bytes(spark):
    frame = spark.createDataFrame([("x" * 100,)] * 10, "s string")
    assert fits_broadcast(frame)
    assert not fits_broadcast(frame, max_rows=9)
    assert not fits_broadcast(frame, max_bytes=1000)


# --- routes ------------------------------------------------------------------------------------


def first_match(routes, path):
    hits = [
        (key, endpoint)
        for mount, endpoint, key, exact in routes
        if path == mount or (not exact and (mount == "/" or path.startswith(mount + "/")))
    ]
    return min(hits)[1] if hits else None


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("root", [True, False])
def test_first_registered_route_wins(spark, small, root, monkeypatch):
    if not small:
        monkeypatch.setattr("cadastre.operators.routes.fits_broadcast", lambda d: False)
    routes = [
        ("/en/25", "early", 0, False), ("/en", "en", 1, False), ("/en/25", "late", 2, False),
        ("/en/30", "shadowed", 3, False), ("/e", "segment", 4, False), ("/a/b/c", "deep", 5, False),
        ("/a", "a", 6, False), ("/health", "health", 7, True), ("/", "index", 8, root),
    ]
    paths = ["/en/25", "/en/25/x", "/en/30", "/en/250", "/en", "/enx", "/e/1", "/a/b/c/d", "/a/b",
             "/health", "/health/x", "/", "", "/zz/1/2/3/4", "/en//x", "/en/"] + ["/en/7"] * 20
    requests = spark.createDataFrame(list(enumerate(paths)), "i int, path string")
    table = spark.createDataFrame(
        routes, "mount_at string, endpoint string, reg_key int, exact boolean"
    )
    got = resolve_routes(requests, table, "path").select("i", "route.endpoint")
    assert {r["i"]: r["endpoint"] for r in got.collect()} == {
        i: first_match(routes, p) for i, p in enumerate(paths)
    }


@pytest.mark.parametrize("small", [True, False])
def test_routes_need_one_join(spark, small, monkeypatch):
    if not small:
        monkeypatch.setattr("cadastre.operators.routes.fits_broadcast", lambda d: False)
    mounts = [("/a", "x", 0), ("/" + "/".join("abcdefghij"), "y", 1)]
    table = spark.createDataFrame(mounts, "mount_at string, endpoint string, reg_key int")
    found = resolve_routes(spark.createDataFrame([("/a/b",)], "path string"), table, "path")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == (2 if small else 1)  # the other one is settled
    assert found.first()["route"]["endpoint"] == "x"


def test_no_routes(spark):
    requests = spark.createDataFrame([("/a",)], "path string")
    table = spark.createDataFrame([], "mount_at string, endpoint string, reg_key int")
    assert resolve_routes(requests, table, "path").select("route.endpoint").first()[0] is None


RECORD = (
    "path_parts array<string>, name string, slug string, description string, group string, "
    "members array<string>, kind string, mount_path string, entry string, static_dir string, "
    "enabled boolean, violations array<struct<stage:int,field:string,code:string>>"
)


def record(group, slug, kind="backend", enabled=True, place=None, violations=(), **other):
    values = {
        "entry": f"apps.{group}.{slug}.main:app".replace("-", "_") if kind != "frontend" else None,
        "static_dir": "dist" if kind != "backend" else None,
    } | other
    return (
        [place or group, slug], slug, slug, "", group, ["a", "b"], kind, f"/{group}/{slug}",
        values["entry"], values["static_dir"], enabled, list(violations),
    )


@pytest.fixture(scope="module")
def built(spark):
    records = [
        record("zeta", "back"),
        record("zeta", "gone", entry="no.such:app"),
        record("zeta", "two-colons", entry="a:b:c"),
        record("zeta", "no-colon", entry="ab"),
        record("zeta", "off", enabled=False, entry="no.such:app"),
        record("a-b", "front", "frontend", place="0"),
        record("a-b", "full", "fullstack"),
        record("a-b", "half", "fullstack"),
        record("static", "x"),
        record("zeta", "back", place="zz", entry="other:app"),
        record("zeta", "bad", violations=[(1, "slug", "x")]),
    ]
    modules = [
        (m, "app")
        for m in ("apps.zeta.back.main", "apps.a_b.full.main", "apps.a_b.half.main", "apps.static.x.main")
    ]
    dirs = [("a_b/front/dist",), ("a_b/full/dist",)]
    return build_catalogue(
        spark.createDataFrame(records, RECORD),
        spark.createDataFrame(modules, "module string, attr string"),
        spark.createDataFrame(dirs, "static_path string"),
    ).cache()


def test_status(built):
    assert {(r["group"], r["slug"]): r["status"] for r in built.collect()} == {
        ("zeta", "back"): "online",
        ("zeta", "gone"): "broken",
        ("zeta", "two-colons"): "broken",
        ("zeta", "no-colon"): "broken",
        ("zeta", "off"): "offline",
        ("a-b", "front"): "online",
        ("a-b", "full"): "online",
        ("a-b", "half"): "broken",
        ("static", "x"): "online",
    }


def test_index_order(built):
    cards = cat.index_order(catalogue_index(built), "path_parts").collect()
    assert [(r["group"], r["slug"] if "slug" in r else r["name"]) for r in cards] == [
        ("a-b", "front"), ("a-b", "full"), ("a-b", "half"), ("static", "x"), ("zeta", "back"),
        ("zeta", "gone"), ("zeta", "no-colon"), ("zeta", "off"), ("zeta", "two-colons"),
    ]


def test_mounted_endpoints_and_shadowing(spark, built):
    paths = {
        "/a-b/full/api/x": "apps.a_b.full.main:app",
        "/a-b/full/x": "a_b/full/dist",
        "/a-b/half/api": "apps.a_b.half.main:app",
        "/a-b/half/x": None,
        "/static/x": "static",
        "/zeta/off": None,
        "/zeta/back/ping": "apps.zeta.back.main:app",
        "/zeta": None,
        "/health": "health",
        "/": "index",
    }
    requests = spark.createDataFrame([(p,) for p in paths], "path string")
    got = resolve_routes(requests, routes_of(built), "path").select("path", "route.endpoint")
    assert {r["path"]: r["endpoint"] for r in got.collect()} == paths


def test_disabled_outranks_broken_and_key_is_shared(spark):
    frame = spark.createDataFrame(
        [(0, "/a", True), (1, "/a", False), (2, "/b", True), (3, None, True)],
        "i int, mount_path string, enabled boolean",
    )
    broken = spark.createDataFrame([("/a",), ("/a",)], "mount_path string")
    got = cat.with_status(frame, broken).select("i", "status").collect()
    assert [r["status"] for r in sorted(got)] == ["broken", "offline", "online", "online"]


@pytest.mark.parametrize("small", [True, False])
def test_duplicates_and_owners(spark, skewed, small, monkeypatch):
    monkeypatch.setattr("cadastre.operators.skew.fits_broadcast", lambda *a, **k: small)
    frame = skewed.dropna()
    data = sorted((r["i"], r["k"]) for r in frame.collect())
    first = {}
    for i, k in data:
        first.setdefault(k, i)
    got = cat.duplicate_keys(frame, "k", "i", []).select("i", "k", "owner.i")
    assert rows(got) == sorted(((i, k, first[k]) for i, k in data if first[k] != i), key=repr)
    owners = cat.owners_only(frame, "k", "i")
    assert {r["k"]: r["i"] for r in owners.collect()} == first
    assert owners.columns == frame.columns


# --- lookups -----------------------------------------------------------------------------------


def test_array_lookup_keeps_order_and_marks_missing(spark):
    parents = spark.createDataFrame([("p", [6, 1, 99, 1]), ("q", [])], "parent string, ids array<int>")
    dim = spark.createDataFrame([(1, "one"), (6, "six")], "id int, title string")
    items = lookup.array_lookup(parents, "ids", dim, "id", ["parent"])
    got = [(r["position"], r["id"], r["title"], r["is_missing"]) for r in items.orderBy("position").collect()]
    assert got == [(0, 6, "six", False), (1, 1, "one", False), (2, 99, None, True), (3, 1, "one", False)]
    text = lookup.ordered_concat(items, ["parent"], "position", F.coalesce("title", F.lit("?")), "t", "-")
    assert rows(text) == [("p", "six-one-?-one")]


def test_positional_join(spark):
    items = spark.createDataFrame([("a", 0), ("a", 1), ("a", 2), ("b", 0)], "deck string, pos bigint")
    notes = spark.createDataFrame([("a", json.dumps(["x", None])), ("b", "broken")], "deck string, n string")
    got = lookup.positional_join(items, notes, "deck", "pos", "n")
    assert rows(got) == [("a", 0, "x"), ("a", 1, None), ("a", 2, None), ("b", 0, None)]


def test_static_directories(spark):
    """A null is no directory; ways to write the same directory are one."""
    data = [(0, None), (1, "dist"), (2, "dist/"), (3, "./dist"), (4, "d//x/."), (5, "."), (6, "/abs/"), (7, "gone")]
    frame = spark.createDataFrame(data, "i int, static_dir string").selectExpr(
        "*", "'frontend' AS kind", "'my-group' AS `group`", "'s-1' AS slug", "string(null) AS entry"
    )
    paths = [("my_group/s_1",), ("./my_group/s_1/dist/",), ("my_group/s_1/d/x",), ("/abs",)]
    listing = spark.createDataFrame(paths, "static_path string")
    modules = spark.createDataFrame([], "module string, attr string")
    got = cat.missing_targets(frame, modules, listing)
    assert {r["i"]: r["static_ok"] for r in got.collect()} == {i: 0 < i < 7 for i in range(8)}


# --- registration ------------------------------------------------------------------------------

REQUEST = "n int, group string, slug string, kind string, description string, members array<string>"


def requests(spark, *items):
    data = [(n, g, s, k, "counts the boats", ["Noor"]) for n, (g, s, k) in enumerate(items)]
    return new_records(spark.createDataFrame(data, REQUEST))


def decide(spark, new, existing=()):
    table = spark.createDataFrame([(d,) for d in existing], "directory string")
    return register_records(new, table, ["directory"], ["n"], refusal_by_rule())


def test_register(spark):
    new = requests(
        spark, ("north-2", "sea-chart", "backend"), ("docks", "panel", "frontend"), ("docks", "ledger", "fullstack"),
        ("docks", "ledger", "backend"), ("docks", "Two_words x", "backend"), ("Docks", "ledger", "backend"), ("docks", "timer", "cli"),
        ("docks", "timer", "backend"), ("docks", "former", "backend"), ("docks", "planner\n", "backend"), (None, "ledger", "backend"),
    )
    decided = decide(spark, new, ["docks/former", "docks/former"])
    assert {r["n"]: r["refusal"] for r in decided.collect()} == {
        0: None, 1: None, 2: None, 3: "exists", 4: "invalid slug", 5: "invalid group",
        6: "invalid kind", 7: None, 8: "exists", 9: "invalid slug", 10: "invalid group",
    }
    assert decided.columns == [*new.columns, "refusal"]
    first = {r["n"]: r for r in accepted(decided).collect()}
    assert first[0]["mount_path"] == "/north-2/sea-chart"
    assert first[0]["entry"] == "apps.north_2.sea_chart.main:app" and first[0]["static_dir"] is None
    assert first[1]["entry"] is None and first[1]["static_dir"] == "dist"
    assert first[2]["entry"] and first[2]["static_dir"] and first[2]["name"] == "ledger"
    assert rejected(decided).count() == 7


def test_append_and_register_again(spark):
    folder = scratch_folder(spark)
    append_accepted(decide(spark, requests(spark, ("docks", "ledger", "backend"))), folder, strict=True)
    stored = spark.read.parquet(folder)
    again = register_records(
        requests(spark, ("docks", "ledger", "backend"), ("docks", "timer", "backend")),
        stored, ["directory"], ["n"], refusal_by_rule(),
    )
    with pytest.raises(RegistrationError, match="exists"):
        append_accepted(again, folder, strict=True)
    assert spark.read.parquet(folder).count() == 1
    append_accepted(again, folder)
    assert sorted(r["slug"] for r in spark.read.parquet(folder).collect()) == ["ledger", "timer"]


# --- layers and changes ------------------------------------------------------------------------


def test_layered_overlay(spark):
    layer = lambda *items: spark.createDataFrame(items, "path string, text string")
    got = overlay.layered_overlay(
        [
            (layer(("index.html", "site"), ("brand/a.css", "site"), ("b", "site")), None, False),
            (layer(("a.css", "brand"), ("b.css", None)), "brand", False),
            (None, "deck", True),
            (layer(("b", "last")), None, True),
        ],
        "path",
    )
    assert rows(got.select("path", "layer", "text")) == [
        ("b", 3, "last"), ("brand/a.css", 1, "brand"), ("brand/b.css", 1, None), ("index.html", 0, "site"),
    ]
    with pytest.raises(ValueError, match="layer 0"):
        overlay.layered_overlay([(None, None, False)], "path")


def test_changed_units(spark):
    paths = ["apps/g/p/main.py", "apps/g/p/x/y", "apps/g/q/a", "docs/apps/z", "apps/README.md", "apps/"]
    frame = spark.createDataFrame([(p,) for p in paths], "path string")
    manifests = spark.createDataFrame([("g/p", True), ("z/z", False)], "unit string, pytest boolean")
    assert rows(changes.changed_units(frame)) == [("/",), ("README.md/",), ("g/p",), ("g/q",)]
    assert rows(changes.affected_units(frame, manifests)) == [("g/p", True)]
    report = {r["unit"]: r["presence"] for r in changes.presence_report(frame, manifests).collect()}
    assert report == {"/": "missing", "README.md/": "missing", "g/p": "present", "g/q": "missing"}
    none = changes.presence_report(frame.filter("path = 'docs/apps/z'"), manifests)
    assert [r["presence"] for r in none.collect()] == ["none"]


def test_status_matrix(spark):
    frame = spark.createDataFrame(
        [("a", "Lint", "ok"), ("a", "Tests", "failed"), ("b", "Lint", "failed"), ("b", "Lint", "ok"), ("b", "Other", "ok"),
         ("b", None, "ok"), ("c", "Tests", "lost"), ("c", "Tests", "failed"), ("c", "Types", None), ("c", "Types", "ok")],
        "app string, chk string, s string",
    )
    got = changes.status_matrix(frame, "app", "chk", ["Lint", "Tests", "Types"], F.col("s"), ["failed", "ok"])
    assert got.columns == ["app", "Lint", "Tests", "Types", "unlisted"]
    assert rows(got) == [
        ("a", "ok", "failed", "skipped", 0), ("b", "failed", "skipped", "skipped", 2), ("c", "skipped", "lost", "ok", 0)]
