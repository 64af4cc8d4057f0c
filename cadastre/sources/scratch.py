"""The shared folder for tables that a job writes for itself."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
# A plain session setting: the one above belongs to the context and cannot be set at run time.
LIBRARY_SETTING = "cadastre.scratch.dir"

_written: list[str] = []
_shared: set[tuple[str, str]] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``, else in ``cadastre.scratch.dir``.

    Any path will do: one without a scheme belongs to the default file system, and one of the form ``file:``
    may be a mount that all machines have.  A session that names neither gets a temporary folder if it runs
    in one process, else a folder in the warehouse, which a cluster shares.  Executors of other processes
    write to a ``file:`` folder once, to see that the driver finds what they write.
    """
    base = spark.conf.get(SETTING, None) or spark.conf.get(LIBRARY_SETTING, None)
    one_process = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None
    if not base:
        if one_process:
            base = f"file:{os.path.realpath(tempfile.mkdtemp(prefix='cadastre-'))}"
        else:
            base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_cadastre"
        spark.conf.set(LIBRARY_SETTING, base)
    base = _with_store(spark, base)
    if "://" not in base and not one_process:
        _require_shared(spark, base)
    return base


def _with_store(spark: SparkSession, folder: str) -> str:
    """The folder by a name that Spark, Python and the file system's own client read alike.

    A path on the machine's own disk is left as it is, without ``//`` if it has a scheme.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return (folder if full.startswith("file:") and folder.startswith("/") else full).rstrip("/")


def _require_shared(spark: SparkSession, base: str) -> None:
    """Raise if a row that a task wrote below ``base`` is not found there; asked once a session and folder."""
    key = (spark.sparkContext.applicationId, base)
    if key in _shared:
        return
    tasks = 2 * max(spark.sparkContext.defaultParallelism, 1)
    folder = f"{base}/{uuid.uuid4().hex}"
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(folder)
        found = spark.read.schema("id long").parquet(folder).count()
    finally:
        remove(spark, folder)
    if found != tasks:
        raise ValueError(f"{base!r} is a folder of one machine; name one that executors share in {SETTING}")
    _shared.add(key)


def scratch_folder(spark: SparkSession) -> str:
    """A new path below the shared folder, forgotten by ``release``."""
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    _written.append(folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    For a table that is measured before it is joined, or that several results start from: its
    lineage runs once, its size is known, and it outlives the executors that made it.
    """
    folder = scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def cut(df: DataFrame) -> DataFrame:
    """``checkpoint()`` in the shared folder: cuts the lineage of a loop or of a costly stage.

    Spark removes the files with the frame if ``spark.cleaner.referenceTracking.cleanCheckpoints``
    is on.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def is_folder(spark: SparkSession, path: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()


def release(spark: SparkSession) -> None:
    """Remove the folders this process wrote; call it when the frames that read them are done."""
    while _written:
        remove(spark, _written.pop())
