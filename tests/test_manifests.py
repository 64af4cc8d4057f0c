import json

import pytest

from cadastre.functions.rules import check_records, dim_unless, is_slug
from cadastre.plans.catalogue import (
    CatalogueError,
    load_records,
    problems,
    require_clean,
    typed_records,
)
from cadastre.sources.manifests import decode_records, manifest_scan
from pyspark.sql import functions as F

BASE = {
    "name": "Tide table",
    "slug": "tide-table",
    "description": "when the water rises",
    "group": "harbour",
    "members": ["Ines"],
    "kind": "backend",
    "mount_path": "/harbour/tide-table",
    "entry": "apps.harbour.tide_table.main:app",
}
GONE = object()


def record(**changes):
    return {k: x for k, x in (BASE | changes).items() if x is not GONE}


def found(spark, docs, fmt="json"):
    texts = [d if isinstance(d, str) else json.dumps(d) for d in docs]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, content string")
    rows = sorted(typed_records(decode_records(frame, fmt)).collect(), key=lambda r: r["i"])
    return [[tuple(x) for x in r["violations"]] for r in rows], rows


CASES = [
    (record(), []),
    (record(entry=None), [(2, "entry", "required")]),
    (record(entry=""), [(2, "entry", "required")]),
    (record(entry=GONE), [(2, "entry", "required")]),
    (record(kind="frontend", entry=None, static_dir=None), [(2, "static_dir", "required")]),
    (record(kind="fullstack", static_dir="dist"), []),
    (record(kind="fullstack", entry=None), [(2, "entry", "required")]),
    (record(kind="fullstack"), [(2, "static_dir", "required")]),
    (record(mount_path="/pier/4"), [(3, "mount_path", "not_canonical")]),
    (record(mount_path="/pier/4", entry=None), [(2, "entry", "required")]),
    (record(kind="daemon"), [(1, "kind", "enum")]),
    (record(kind=3), [(1, "kind", "enum")]),
    (record(kind=None), [(1, "kind", "enum")]),
    (record(slug=["no"]), [(1, "slug", "string_type")]),
    (record(slug=1), [(1, "slug", "string_type")]),
    (record(slug="tide-table\n"), [(1, "slug", "string_pattern_mismatch")]),
    (record(slug="Tide & table"), [(1, "slug", "string_pattern_mismatch")]),
    (record(description=""), []),
    (record(description=None), [(1, "description", "string_type")]),
    (record(members=[]), [(1, "members", "too_short")]),
    (record(members="Ines"), [(1, "members", "list_type")]),
    (record(members={"a": 1}), [(1, "members", "list_type")]),
    (
        record(members=["Ines", 1, None]),
        [(1, "members.1", "string_type"), (1, "members.2", "string_type")],
    ),
    (record(enabled=None), [(1, "enabled", "bool_type")]),
    (record(enabled="yes"), []),
    (record(enabled="OFF"), []),
    (record(enabled=" yes"), [(1, "enabled", "bool_parsing")]),
    (record(enabled=2), [(1, "enabled", "bool_parsing")]),
    (record(enabled=1.0), []),
    (record(enabled=1.5), [(1, "enabled", "bool_type")]),
    (record(enabled=[]), [(1, "enabled", "bool_type")]),
    (record(checks=None), [(1, "checks", "model_type")]),
    (record(checks={}), []),
    (record(checks={"pytest": "maybe"}), [(1, "checks.pytest", "bool_parsing")]),
    (record(unknown=[1, {"a": None}]), []),
    ({}, [(1, f, "missing") for f in BASE if f != "entry"]),
    (
        record(checks=[], slug=1, group="X", name=GONE, kind="no", entry=5),
        [
            (1, "name", "missing"),
            (1, "slug", "string_type"),
            (1, "group", "string_pattern_mismatch"),
            (1, "kind", "enum"),
            (1, "entry", "string_type"),
            (1, "checks", "model_type"),
        ],
    ),
    ("", [(0, "", "decode")]),
    ("[1]", [(0, "", "decode")]),
    ("null", [(0, "", "decode")]),
]


@pytest.mark.parametrize("fmt", ["json", "yaml"])
def test_rules(spark, fmt):
    got, _ = found(spark, [c[0] for c in CASES], fmt)
    assert got == [c[1] for c in CASES]


def test_json_with_text_after_it_is_malformed(spark):
    got, _ = found(spark, [json.dumps(record()) + " x", json.dumps(record()) + "]", "{"])
    assert got == [[(0, "", "decode")]] * 3


def test_defaults_and_absent_fields(spark):
    _, rows = found(
        spark,
        [record(), record(enabled="no", checks={"mypy": 1}), record(enabled=None, entry=None)],
    )
    assert [r["enabled"] for r in rows] == [True, False, None]
    assert [tuple(r["checks"]) for r in rows] == [(False, False), (False, True), (False, False)]
    assert "enabled" not in rows[0]["present_fields"] and "enabled" in rows[2]["present_fields"]
    assert "entry" in rows[2]["present_fields"] and rows[2]["entry"] is None


def test_yaml_scalars(spark):
    head = "name: n\ndescription: d\ngroup: g\nmembers: [a]\nkind: backend\nentry: m:a\n"
    docs = [
        head + "slug: on\nmount_path: /g/on\n",
        head + "slug: 2024-01-31\nmount_path: /g/s\n",
        head + "slug: s\nmount_path: /g/s\nenabled: off\n",
        head + "slug: s\nmount_path: /g/s\nenabled: 2024-01-31\n",
        head + "slug: s\nmount_path: /g/s\nchecks: 2024-01-31\n",
        head + "slug: .nan\nmount_path: /g/s\n",
        head + "slug: s\nmount_path: /g/s\n1: x\n",
        head + "slug: !!binary cw==\nmount_path: /g/s\n",
        head + 'slug: "a" b\n',
        "a: &a [*a]\n",
        "slug: [tide, table]\nname: sea\n",
    ]
    got, rows = found(spark, docs, "yaml")
    bad = lambda f, c: [(1, f, c)]
    assert got[:6] == [
        bad("slug", "string_type"),
        bad("slug", "string_type"),
        [],
        bad("enabled", "bool_type"),
        bad("checks", "model_type"),
        bad("slug", "string_type"),
    ]
    assert got[6] == [(0, "", "decode")] and got[7] == []
    assert got[8] == [(0, "", "decode")]
    # A collection that holds itself is read like any field the record does not know.
    assert {(f, c) for _, f, c in got[9]} >= {("name", "missing"), ("slug", "missing")}
    assert (1, "slug", "string_type") in got[10] and (1, "group", "missing") in got[10]
    assert rows[2]["enabled"] is False


def test_scan_missing_root_and_empty_root(spark, tmp_path):
    for root in (tmp_path / "none", tmp_path):
        frame = manifest_scan(spark, str(root))
        assert frame.columns == ["path", "path_parts", "content"] and frame.count() == 0


def test_scan_takes_exactly_two_levels(spark, write_manifest):
    write_manifest("alpha", "one")
    write_manifest("x", "deep", folder="x/y/z")
    write_manifest("x", "flat", folder="flat")
    write_manifest("_g", "a b+c%20é")
    frame = manifest_scan(spark, write_manifest.root)
    assert sorted(r["path"] for r in frame.collect()) == [
        "_g/a b+c%20é/project.yaml", "alpha/one/project.yaml",
    ]


def test_empty_and_unreadable_files_are_rows(spark, write_manifest):
    write_manifest("alpha", "one")
    write_manifest("é +%", "empty", text="")
    write_manifest("beta", "bytes")
    (write_manifest("beta", "bytes") / "project.yaml").write_bytes(b"name: \xff\xfe\n")
    found = load_records(spark, write_manifest.root).collect()
    assert {r["path"]: r["decode_error"] for r in found} == {
        "alpha/one/project.yaml": None,
        "é +%/empty/project.yaml": "a mapping is needed, found NoneType",
        "beta/bytes/project.yaml": "not UTF-8 text",
    }


def test_several_groups_load_clean(spark, write_manifest):
    for group, slug in (("quay", "crane"), ("quay", "ferry"), ("reef", "dive-log")):
        write_manifest(group, slug)
    records = load_records(spark, write_manifest.root)
    assert {r["slug"] for r in records.collect()} == {"crane", "ferry", "dive-log"}
    assert problems(records, "path_parts", "path").count() == 0
    require_clean(records)


def test_strict_names_the_first_invalid_record_in_path_order(spark, write_manifest):
    write_manifest("a-b", "x", folder="a-b/x", text="name: sea\n")
    write_manifest("a", "x", folder="a/x", text="name: sea\nslug: [tide, table]\n")
    write_manifest("one", "s", folder="0/s")
    write_manifest("one", "s", folder="0/t")
    with pytest.raises(CatalogueError, match="Invalid manifest a/x/project.yaml"):
        require_clean(load_records(spark, write_manifest.root))


def test_strict_gives_the_reason_of_an_unreadable_file(spark, write_manifest):
    write_manifest("alpha", "one", text="")
    with pytest.raises(CatalogueError, match="alpha/one/project.yaml: a mapping is needed"):
        require_clean(load_records(spark, write_manifest.root))


def test_strict_names_duplicates_after_invalid_records(spark, write_manifest):
    write_manifest("alpha", "one")
    write_manifest("alpha", "one", folder="beta/one")
    write_manifest("alpha", "one", folder="gamma/one")
    records = load_records(spark, write_manifest.root)
    with pytest.raises(CatalogueError, match="duplicate mount_path '/alpha/one' in alpha/one and"):
        require_clean(records)
    places = [r["place"][0] for r in problems(records, "path_parts", "path").collect()]
    assert sorted(places) == ["beta", "gamma"]


def test_plain_table_rules_need_no_decode_columns(spark):
    schema = (
        "name string, slug string, description string, group string, members array<string>, "
        "kind string, mount_path string, entry string, static_dir string"
    )
    rows = [
        ("n", "s", "", "g", ["a"], "backend", "/g/s", "m:a", None),
        (None, "S", "", None, [], "other", "/g/s", None, None),
        ("n", "s", "", "g", None, "backend", "/g/s", None, None),
    ]
    got = check_records(spark.createDataFrame(rows, schema)).collect()
    assert [[(x["field"], x["code"]) for x in r["violations"]] for r in got] == [
        [],
        [
            ("name", "missing"),
            ("slug", "string_pattern_mismatch"),
            ("group", "missing"),
            ("members", "too_short"),
            ("kind", "enum"),
        ],
        [("members", "missing")],
    ]


def test_slug_pattern(spark):
    values = ["a", "a-1", "1a", "-a", "A", "a_b", "a\n", "", "aé"]
    frame = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    got = [r[1] for r in sorted(frame.select("i", is_slug("v")).collect())]
    assert got == [True, True] + [False] * 7


def test_dim_unless(spark):
    frame = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    dims = lambda active: [r[0] for r in frame.select(dim_unless("v", active, ["a", "b"])).collect()]
    assert dims(["a"]) == [False, True, True]
    assert dims([]) == dims(["b", "a"]) == [False] * 3


def test_yaml_is_read_once_per_row(spark):
    """A filter on the result stays above the decoding instead of repeating it."""
    frame = spark.createDataFrame([(json.dumps(record()),)], "content string")
    checked = typed_records(decode_records(frame, "yaml")).filter(F.size("violations") > 0)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1


@pytest.mark.parametrize("text", ["slug: !!bool maybe", "slug: !!int ''", "slug: !!float ''", "slug: !!timestamp x"])
def test_bad_tags_are_rows(spark, write_manifest, text):
    write_manifest("north", "one", text=f"name: a\n{text}\n")
    rows = decode_records(manifest_scan(spark, write_manifest.root), "yaml").collect()
    assert len(rows) == 1 and rows[0]["decode_error"]


def test_aliases_do_not_grow(spark, write_manifest):
    levels = "\n".join(f"a{i}: &a{i} [{', '.join([f'*a{i - 1}'] * 9)}]" for i in range(1, 12))
    write_manifest("north", "one", text=f"a0: &a0 x\n{levels}\nmembers: *a11\n")
    rows = typed_records(decode_records(manifest_scan(spark, write_manifest.root), "yaml")).collect()
    assert len(rows) == 1 and "members.0" in {v["field"] for v in rows[0]["violations"]}
