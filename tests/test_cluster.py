"""Queries with separate executors' rules for the shared folder, on tables that are folders of part files."""

import os

import pytest

from cadastre.plans.queries import QUERIES
from cadastre.sources import scratch
from conftest import DATA, rows

NAMES = [
    "a2_duplicate_keys",
    "a3_ordered_concat",
    "a4_flagged_positions",
    "catalogue_index",
    "full_flow",
    "j1_from_tree",
    "j1_missing_targets",
    "j1_ref_integrity",
    "j2_status",
    "j3_array_lookup",
    "j5_catalogue_routes",
    "j5_route_resolve",
    "j6_affected_units",
    "j7_presence_report",
    "o1_path_order",
    "o2_group_order",
    "page_cards",
    "s1_manifest_scan",
    "s3_commit_records",
    "stream_array_lookup",
    "stream_endpoints",
    "stream_hot_lookup",
]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """The sample tables, each a folder of three files."""
    place = tmp_path_factory.mktemp("folders")
    for name in os.listdir(DATA):
        spark.read.parquet(f"{DATA}/{name}").repartition(3).write.parquet(f"{place}/{name}")
    return str(place)


@pytest.mark.parametrize("name", NAMES)
def test_a_cluster_gives_what_one_process_gives(spark, sf_dir, folders, monkeypatch, name):
    expected = rows(QUERIES[name](spark, sf_dir))
    monkeypatch.setattr(scratch, "_shared", set(), raising=False)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert expected and rows(QUERIES[name](spark, folders)) == expected
