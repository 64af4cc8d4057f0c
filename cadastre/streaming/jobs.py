"""Streams of records and requests.

Rules, defaults, endpoints and lookups against static tables work within a row, so they take a
streaming DataFrame as it is.  Operators that compare rows with each other (keys, lists, orders)
are for batches.  ``run_available`` drains what is there and stops; a restart goes on from the
checkpoint, and the file sink keeps each row once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastre.functions.rules import check_records
from cadastre.operators.lookup import array_lookup, array_lookup_inside
from cadastre.operators.routes import resolve_routes
from cadastre.operators.skew import fits_broadcast, salted_join
from cadastre.plans.catalogue import typed_records
from cadastre.sources.manifests import decode_records, manifest_stream
from cadastre.sources.scratch import exists, is_folder, remove, scratch_folder


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` in a folder, one parquet file or a folder of them, as a stream."""
    file = f"{name}.parquet"
    schema = spark.read.parquet(f"{folder}/{file}").schema
    stream = spark.readStream.schema(schema)
    if is_folder(spark, f"{folder}/{file}"):
        return stream.parquet(f"{folder}/{file}")
    return stream.option("pathGlobFilter", file).parquet(folder)


def stream_records(spark: SparkSession, root: str, fmt: str = "yaml") -> DataFrame:
    """Checked records of manifest files as they arrive."""
    return typed_records(decode_records(manifest_stream(spark, root), fmt))


def check_stream(records: DataFrame) -> DataFrame:
    return check_records(records)


def route_stream(
    requests: DataFrame,
    routes: DataFrame,
    path: str) -> DataFrame:
    """Requests as a stream against a static table of routes."""
    return resolve_routes(requests, routes, path)


def run_available(stream: DataFrame, folder: str) -> DataFrame:
    """Write everything available to ``folder/rows`` as parquet and read it back."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


def run_batches(stream: DataFrame, folder: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on each micro-batch of what is available, written below ``folder/rows`` and read back.

    A batch is written down first: work may read it several times, and it outlives its executors.  A batch
    that is repeated after a failure replaces what it had written.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        kept = scratch_folder(spark)
        batch.write.parquet(kept)
        work(spark.read.schema(batch.schema).parquet(kept)).write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")
        remove(spark, kept)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    kind = work(spark.createDataFrame([], stream.schema)).schema
    if not exists(spark, f"{folder}/rows"):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).parquet(f"{folder}/rows/batch=*")


def array_lookup_stream(
    stream: DataFrame, ids: str, dim: DataFrame, key: str, keep: list[str], folder: str
) -> DataFrame:
    """``array_lookup`` of what is available of a stream.

    A small ``dim`` is looked up within the row, in one stage without a shuffle; a large one is joined in
    each micro-batch, hot ids salted.
    """
    rows = stream.select(*keep, ids)
    if fits_broadcast(dim):
        found = array_lookup_inside(rows, ids, dim, key, "_items").select(*keep, F.inline("_items"))
        return run_available(found, folder)
    return run_batches(rows, folder, lambda batch: array_lookup(batch, ids, dim, key, keep, salted=True))


def hot_lookup_stream(stream: DataFrame, dim: DataFrame, on: list[str], folder: str, how: str = "left") -> DataFrame:
    """Join what is available of a stream to a large table with one row per key, hot keys of a batch salted."""
    return run_batches(stream, folder, lambda batch: salted_join(batch, dim, on, how))
