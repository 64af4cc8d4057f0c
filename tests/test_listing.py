"""Trees listed by tasks, modules read by their syntax, and the tree as a stream."""

import os
import time

import pytest
from pyspark.sql import functions as F

from cadastre.operators.catalogue import missing_targets, normal_path
from cadastre.plans.catalogue import catalogue_of_tree
from cadastre.sources import listing
from cadastre.sources.manifests import manifest_scan, manifest_stream
from cadastre.streaming.jobs import run_available


def put(root, path, content=b""):
    place = root / path
    place.parent.mkdir(parents=True, exist_ok=True)
    place.write_bytes(content)


def test_lengths_come_with_the_names(spark, tmp_path):
    put(tmp_path, "a/x/project.yaml", b"name: n")
    put(tmp_path, "a/y/project.yaml")
    put(tmp_path, "_b/.z/project.yaml", b"1")
    put(tmp_path, "a/x/other.yaml", b"1")
    put(tmp_path, "project.yaml", b"1")
    put(tmp_path, "a/project.yaml", b"1")
    (tmp_path / "a/folder/project.yaml").mkdir(parents=True)
    for uri in (str(tmp_path), f"file:{tmp_path}/", f"file://{tmp_path}"):
        got = {"/".join(r["path_parts"]): r["length"] for r in listing.list_files(spark, uri, "*/*/project.yaml").collect()}
        assert got == {"a/x/project.yaml": 7, "a/y/project.yaml": 0, "_b/.z/project.yaml": 1}
    assert listing.list_files(spark, f"{tmp_path}/none", "*/*/project.yaml").count() == 0
    tree = {"/".join(r["path_parts"]): r["length"] for r in listing.list_tree(spark, str(tmp_path)).collect()}
    assert tree["a/folder/project.yaml"] is None and tree["a"] is None and tree["a/x/other.yaml"] == 1
    assert "project.yaml" not in tree  # files of the root belong to no folder


def test_scan_has_no_list_of_names_in_its_plan(spark, tmp_path):
    """Names are made and read by tasks: the plan begins with one row and holds no path of a file."""
    for i in range(30):
        put(tmp_path, f"g{i}/p{i}/project.yaml", b"name: n" * (i % 3))
    scan = manifest_scan(spark, str(tmp_path))
    plan = scan._jdf.queryExecution().toString()
    assert "LocalTableScan" not in plan and "g7" not in plan and plan.count("MapInArrow") >= 3
    assert scan.count() == 30 and scan.filter("content = ''").count() == 10


def test_files_are_written_and_read_whole(spark, tmp_path):
    rows = [(["é +%", "b", "f"], b"\xff\xfe" * 5000), (["c", "d", "e"], None), (["c", "d", "f"], b"x")]
    frame = spark.createDataFrame(rows, "parts array<string>, content binary")
    listing.write_files(frame, str(tmp_path), "parts", "content")
    listing.write_files(frame, str(tmp_path), "parts", "content")
    found = listing.read_files(spark, str(tmp_path), listing.list_files(spark, str(tmp_path), "*/*/*"))
    assert sorted((r["path_parts"], bytes(r["content"])) for r in found.collect()) == sorted((p, c or b"") for p, c in rows)


SOURCE = b"""
import os.path, sys as system
from x import y as z, w
from star import *
a = b = 1
(c, [d, *e]) = q
f: int
g: int = 2
h += 1
if (i := 3):
    j = 1
else:
    def k(): inner = 1
try:
    l = 1
except E:
    m = 1
else:
    n = 1
finally:
    o = 1
for p, q in r:
    s = 1
while t:
    u = 1
with v as (aa, bb):
    cc = 1
match dd:
    case [ee, *ff]:
        gg = 1
class hh:
    member = 1
async def ii(): pass
jj = 1
del jj
kk.attribute = 1
ll[0] = 1
print(mm := 1)
"""


def test_top_level_names():
    want = "os system z w a b c d e g h i j k l m n o p q s u aa bb cc ee ff gg hh ii mm".split()
    assert listing.top_level_names(SOURCE) == set(want)
    assert listing.top_level_names(b"") == set()
    with pytest.raises(SyntaxError):
        listing.top_level_names(b"app = (")


def test_modules_are_not_imported(spark, tmp_path):
    put(tmp_path, "g/p/main.py", b"raise SystemExit\napp = 1\n")
    put(tmp_path, "g/p/__init__.py", b"app = 1")
    put(tmp_path, "g/p/deep/er/x.py", b"")
    put(tmp_path, "g/p/bad.py", b"app = (")
    put(tmp_path, "g/p/nul.py", b"app = 1\x00")
    put(tmp_path, "g/p/latin.py", b"app = '\xe9'")
    put(tmp_path, "g/p/__pycache__/c.py", b"app = 1")
    put(tmp_path, "g/p/notes.txt", b"app = 1")
    got = {(r["module"], r["attr"], r["error"] is not None) for r in listing.module_listing(spark, str(tmp_path)).collect()}
    assert got == {
        ("apps.g.p.main", "app", False), ("apps.g.p", "app", False), ("apps.g.p.deep.er.x", None, False),
        ("apps.g.p.bad", None, True), ("apps.g.p.nul", None, True), ("apps.g.p.latin", None, True),
    }


def test_paths_are_resolved(spark):
    cases = {
        "dist": "dist", "./dist//": "dist", "a/../dist": "dist", "a/b/../../dist": "dist", "/a/../../x": "/x", "..": "..",
        "../dist": "../dist", "a/../../dist": "../dist", "../..": "../..", "/": "/", "": "", "a/..": "", "..a/b": "..a/b",
    }
    frame = spark.createDataFrame([(k,) for k in cases] + [(None,)], "p string")
    got = {r[0]: r[1] for r in frame.select("p", normal_path(F.col("p"))).collect()}
    assert got == cases | {None: None}


def test_targets_beyond_their_project_are_found(spark):
    rows = [(1, "frontend", None, "../shared/dist"), (2, "frontend", None, "a/../dist"), (3, "frontend", None, "../../x")]
    frame = spark.createDataFrame([(*r, "g", "p") for r in rows], "i int, kind string, entry string, static_dir string, `group` string, slug string")
    modules = spark.createDataFrame([], "module string, attr string")
    static = spark.createDataFrame([("g/shared/dist",), ("g/p/dist",)], "static_path string")
    got = {r["i"]: r["static_ok"] for r in missing_targets(frame, modules, static).collect()}
    assert got == {1: True, 2: True, 3: False}


def test_catalogue_of_an_empty_tree(spark, tmp_path):
    assert catalogue_of_tree(spark, str(tmp_path)).count() == 0


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    root, state = tmp_path / "apps", str(tmp_path / "state")
    put(root, "a/x/project.yaml", b"name: n")
    put(root, "a/empty/project.yaml")
    put(root, "b/bytes/project.yaml", b"\xff")
    stream = lambda: manifest_stream(spark, str(root))
    rows = lambda df: sorted((r["path"], r["content"]) for r in df.collect())
    first = [("a/empty/project.yaml", ""), ("a/x/project.yaml", "name: n"), ("b/bytes/project.yaml", None)]
    assert rows(run_available(stream(), state)) == first
    assert rows(run_available(stream(), state)) == first
    time.sleep(0.05)
    put(root, "c/new/project.yaml", b"name: c")
    assert rows(run_available(stream(), state)) == [*first, ("c/new/project.yaml", "name: c")]
    later = time.time() + 3600
    put(root, "d/later/project.yaml", b"name: d")
    os.utime(root / "d/later/project.yaml", (later, later))
    assert len(rows(run_available(stream(), state))) == 4  # its time has not come
