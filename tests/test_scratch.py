"""The folder for derived tables on a cluster, whose master is not this process."""

import pytest
from pyspark.sql import DataFrameWriter

from cadastre.plans.queries import QUERIES
from cadastre.sources import scratch
from conftest import rows


@pytest.fixture
def cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(scratch, "_shared", set(), raising=False)
    yield spark
    spark.conf.unset(scratch.LIBRARY_SETTING)


@pytest.fixture
def unnamed(cluster, tmp_path, monkeypatch):
    """The session names no ``spark.checkpoint.dir``, and its warehouse is below ``tmp_path``."""
    monkeypatch.setattr(scratch, "SETTING", "cadastre.not.set")
    conf = {"spark.sql.warehouse.dir": f"{tmp_path}/warehouse"}
    real = type(cluster.conf).get
    monkeypatch.setattr(type(cluster.conf), "get", lambda self, k, *d: conf.get(k) or real(self, k, *d))
    return cluster


@pytest.mark.parametrize("name", ["a1_grouped_index", "j1_ref_integrity", "s1_manifest_scan", "stream_lookup"])
def test_queries_run_on_a_cluster_with_a_plain_path(cluster, sf_dir, monkeypatch, name):
    found = rows(QUERIES[name](cluster, sf_dir))
    monkeypatch.setattr(cluster.sparkContext, "master", "local[8]")
    assert found == rows(QUERIES[name](cluster, sf_dir))


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_a_cluster_uses_the_folder_that_is_named(unnamed, tmp_path, scheme):
    unnamed.conf.set(scratch.LIBRARY_SETTING, f"{scheme}{tmp_path}/shared")
    assert scratch.settle(unnamed.range(10)).count() == 10
    assert len([p for p in (tmp_path / "shared").iterdir() if p.is_dir()]) == 1


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[2,1,1024]"])
def test_separate_executors_without_a_folder_use_the_warehouse(unnamed, tmp_path, monkeypatch, master):
    monkeypatch.setattr(unnamed.sparkContext, "master", master)
    assert scratch.settle(unnamed.range(10)).count() == 10
    assert (tmp_path / "warehouse" / "_cadastre").is_dir()


def test_a_folder_that_the_driver_does_not_share_is_refused(cluster, monkeypatch):
    real = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: real(self._df.limit(0).write, path))
    with pytest.raises(ValueError, match="folder of one machine"):
        scratch.scratch_folder(cluster)
