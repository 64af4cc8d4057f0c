"""What the plans must and must not contain, and the streaming jobs."""

import re

import pytest
from pyspark.sql import functions as F

from cadastre.plans import views as v
from cadastre.plans.queries import QUERIES
from cadastre.sources.scratch import SETTING, scratch_folder, settle
from cadastre.streaming import jobs


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("stream", "s1_"))))
def test_no_plan_compares_all_pairs_or_gathers_all_rows(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    for line in plan.splitlines():
        if re.search(r"\bWindow \[", line):
            # windowspecdefinition lists the partition columns before the order
            assert not re.search(r"windowspecdefinition\([^,)]* (ASC|DESC)", line), line
    assert "BatchEvalPython" not in plan


def test_scans_read_only_what_is_used(spark, sf_dir):
    plan = plan_of(QUERIES["w3_neighbour_visible"](spark, sf_dir))
    assert "props" not in plan
    plan = plan_of(QUERIES["v10_enabled_filter"](spark, sf_dir))
    assert re.search(r"PushedFilters: \[.*Not\(EqualTo\(o_orderstatus,P\)\)", plan)
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>", plan)


def test_lists_are_shuffled_once(spark, sf_dir):
    for name in ("w1_renumber", "w2_last_visible", "w3_neighbour_visible", "w4_transitions"):
        assert plan_of(QUERIES[name](spark, sf_dir)).count("Exchange hashpartitioning") == 1


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert scratch_folder(spark).startswith(spark.conf.get(SETTING))
    assert scratch_folder(spark) != scratch_folder(spark)


def test_settle_keeps_rows_and_cuts_lineage(spark):
    frame = spark.range(100).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    kept = settle(frame)
    assert sorted(kept.collect()) == sorted(frame.collect())
    assert "HashAggregate" not in plan_of(kept)


def test_manifest_stream_goes_on_where_it_stopped(spark, write_manifest):
    write_manifest("alpha", "one")
    write_manifest("alpha", "bad", text="name: [open\n")
    folder = scratch_folder(spark)
    run = lambda: jobs.run_available(jobs.stream_records(spark, write_manifest.root), folder)
    seen = lambda df: sorted((r["path"], len(r["violations"])) for r in df.collect())
    assert seen(run()) == [("alpha/bad/project.yaml", 1), ("alpha/one/project.yaml", 0)]
    write_manifest("beta", "two")
    assert len(seen(run())) == 3
    assert len(seen(run())) == 3


def test_stream_tables_are_streams(spark, sf_dir):
    pages = jobs.stream_table(spark, sf_dir, "pages")
    assert pages.isStreaming
    assert jobs.route_stream(
        v.page_paths(spark, sf_dir, pages), v.page_routes(spark, sf_dir), "path"
    ).isStreaming
