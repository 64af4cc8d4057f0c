"""List operators against a replay in plain Python, with and without split lists."""

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cadastre.operators import sequence as seq
from cadastre.operators.skew import ordered_lists

KEY, ORDER = ["u"], ["at", "id"]


def make_events():
    """A third of the rows belong to one list; a null key is a list too; ties on ``at``."""
    rng = random.Random(7)
    out = []
    for i in range(900):
        u = 1 if i % 3 == 0 else None if i % 10 == 1 else rng.randrange(2, 40)
        burst = rng.random() < 0.3
        at = 50 if burst else rng.randrange(1000)
        out.append((i, u, at, rng.random() < 0.4, rng.choice([None, -2, 0, 1, 2, 3, 9])))
    for i in range(900, 950):
        out.append((i, 99, i, True, 0))
    rng.shuffle(out)
    return out


EVENTS = make_events()
SCHEMA = "id int, u int, at int, skip boolean, v int"
SPLITS = [10, 60, 10**9]


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(EVENTS, SCHEMA).repartition(8).cache()


def lists(rows=None):
    out = {}
    for e in sorted(rows or EVENTS, key=lambda e: (e[2], e[0])):
        out.setdefault(e[1], []).append(e)
    return out


def by_id(df, *columns):
    return {r["id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_hot_lists_are_cut(events):
    assert not ordered_lists(events, KEY, ORDER, 10**9).split
    cut = ordered_lists(events, KEY, ORDER, 60)
    assert cut.split
    slices = cut.df.filter("_hot").select("u", "_slice").distinct().count()
    assert slices > 4
    assert cut.df.count() == len(EVENTS)


@pytest.mark.parametrize("per_task", SPLITS)
def test_renumber(events, per_task):
    got = by_id(seq.renumber(events, KEY, ORDER, F.lit("x"), per_task), "position", "numbered_label")
    want = {e[0]: (i, f"{i + 1:02d} x") for rows in lists().values() for i, e in enumerate(rows)}
    assert got == want


@pytest.mark.parametrize("per_task", SPLITS)
def test_neighbours(events, per_task):
    got = by_id(
        seq.neighbours(events, KEY, ORDER, "id", F.col("skip"), per_task),
        "previous_visible",
        "next_visible",
    )
    want = {}
    for rows in lists().values():
        for i, e in enumerate(rows):
            before = [x[0] for x in rows[:i] if not x[3]]
            after = [x[0] for x in rows[i + 1 :] if not x[3]]
            want[e[0]] = (before[-1] if before else None, after[0] if after else None)
    assert got == want


@pytest.mark.parametrize("per_task", SPLITS)
def test_last_visible(events, per_task):
    frame = seq.last_visible(events, KEY, ORDER, F.col("skip"), per_task)
    got = {i for i, (x,) in by_id(frame, "is_last_visible").items() if x}
    want = set()
    for rows in lists().values():
        seen = [e[0] for e in rows if not e[3]]
        want.update(seen[-1:])
    assert got == want
    assert frame.count() == len(EVENTS)


@pytest.mark.parametrize("per_task", SPLITS)
def test_transitions(events, per_task):
    got = by_id(seq.transitions(events, KEY, ORDER, "v", per_task), "previous_index", "direction")
    want = {}
    for rows in lists().values():
        before = -1
        for e in rows:
            back = e[4] is not None and before is not None and e[4] < before
            want[e[0]] = (before, -1 if back else 1)
            before = e[4]
    assert got == want


@pytest.mark.parametrize("per_task", SPLITS)
def test_suppress_noop_equals_a_replay(spark, per_task):
    rows = [(*e[:4], e[4] or 0) for e in EVENTS]
    frame = spark.createDataFrame(rows, SCHEMA)
    kept = seq.suppress_noop(frame, KEY, ORDER, "v", 4, per_task)
    want = {}
    for group in lists(rows).values():
        state = 0
        for e in group:
            index = max(0, min(3, e[4]))
            if index != state:
                want[e[0]] = (index,)
                state = index
    assert by_id(kept, "index") == want
    again = seq.suppress_noop(kept.drop("index"), KEY, ORDER, "v", 4, per_task)
    assert by_id(again, "index") == want


@pytest.mark.parametrize("per_task", SPLITS)
def test_flagged_positions(events, per_task):
    found = seq.flagged_positions(events, KEY, ORDER, F.col("skip"), per_task)
    got = {}
    for r in sorted(found.collect(), key=lambda r: r["position"]):
        got.setdefault(r["u"], []).append(r["position"])
    want = {u: [i for i, e in enumerate(rows) if e[3]] for u, rows in lists().items()}
    assert got == {u: p for u, p in want.items() if p}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "double", "decimal(12,3)"])
def test_lists_ordered_by_other_types(spark, kind):
    start = datetime.datetime(2024, 3, 30)
    frame = spark.createDataFrame(
        [(i, i % 2, start + datetime.timedelta(hours=i)) for i in range(200)],
        "id int, u int, t timestamp_ntz",
    )
    value = F.col("id") * 1.5 if kind in ("double", "decimal(12,3)") else F.col("t")
    frame = frame.withColumn("at", value.cast(kind))
    cut = ordered_lists(frame, KEY, ORDER, 20)
    assert cut.split
    got = by_id(seq.renumber(frame, KEY, ORDER, F.lit(""), 20), "position")
    assert got == {i: (i // 2,) for i in range(200)}


def test_row_order_does_not_matter(events):
    for per_task in (10, 10**9):
        plain = seq.renumber(events, KEY, ORDER, F.lit("x"), per_task)
        other = seq.renumber(events.orderBy(F.desc("id")), KEY, ORDER, F.lit("x"), per_task)
        assert by_id(plain, "position") == by_id(other, "position")


@pytest.mark.parametrize(
    "values",
    [
        [float(i) for i in range(100)] + [float("inf")] * 20 + [float("nan")] * 20,
        [float("-inf")] * 20 + [float(i) for i in range(100)],
        [None] * 20 + [1e300 * i for i in range(100)],
    ],
)
def test_extreme_order_values(spark, values):
    frame = spark.createDataFrame([(i, 1, x) for i, x in enumerate(values)], "id int, u int, at double")
    assert ordered_lists(frame, KEY, ORDER, 10).split
    got = by_id(seq.renumber(frame, KEY, ORDER, F.lit(""), 10), "position")
    assert got == {i: (i,) for i in range(len(values))}


@pytest.mark.parametrize(
    "at",
    [
        "if(id = 0, timestamp'1970-01-01', timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id / 1000))",
        "id / 1000.0",
        "if(id = 0, -1000000000, id)",
        "lpad(id, 6, '0')",
        "id % 3",
    ],
)
def test_slices_have_rows_not_width(spark, at):
    frame = spark.range(1000).selectExpr("id", "1 AS u", f"{at} AS at")
    sizes = [r["count"] for r in ordered_lists(frame, KEY, ORDER, 100).df.groupBy("_slice").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 200


def test_wide_integers_do_not_overflow(spark):
    values = [-(2**63), -5, 0, 7, 2**63 - 1] * 10
    frame = spark.createDataFrame([(i, 1, x) for i, x in enumerate(values)], "id int, u int, at bigint")
    want = {e[0]: (n,) for n, e in enumerate(sorted(enumerate(values), key=lambda e: (e[1], e[0])))}
    assert by_id(seq.renumber(frame, KEY, ORDER, F.lit(""), 5), "position") == want


def test_with_place(spark):
    words = ["b", None, "", "a-b", "a", "é", "z" * 5000, "a"]
    frame = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id int, w string")
    got = {r["id"]: r["at"] for r in seq.with_place(frame, ["w", "id"], "at").collect()}
    ordered = sorted(enumerate(words), key=lambda e: (e[1] is not None, (e[1] or "").encode(), e[0]))
    assert got == {i: n for n, (i, _) in enumerate(ordered)}
    many = spark.range(20_000).withColumn("x", F.xxhash64("id"))
    placed = seq.with_place(many, ["x"]).withColumn("again", F.row_number().over(Window.orderBy("x")) - 1)
    assert placed.columns == ["id", "x", "place", "again"] and placed.filter("place = again").count() == 20_000
    assert seq.with_place(many.limit(0), ["x"]).count() == 0


def test_windows_of_places_keep_their_key(spark):
    placed = seq.with_place(spark.range(100).withColumn("x", F.xxhash64("id")), ["x"])
    plan = placed._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    assert windows and all("windowspecdefinition(_all#" in line for line in windows)
