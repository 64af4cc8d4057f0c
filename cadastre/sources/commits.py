"""A table of records to which several writers may add keys, each key once.

A writer checks its rows against what is committed, writes the accepted ones to a folder of their own and
claims the next number of the log with a file that must not exist yet.  Only one writer gets a number;
the others take back what they wrote and check again, now against the winner's rows.  Readers see the
folders that the log names, so never half a commit.

    data/<unique name>/     rows of a commit, as parquet
    log/<number>            the name of the folder with that commit's rows
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from cadastre.sources.register import RegistrationError, accepted, register_records, rejected
from cadastre.sources.scratch import exists, remove, settle

ATTEMPTS = 20


class CommitError(RuntimeError):
    """Other writers were faster every time."""


def _local(folder: str) -> str | None:
    if folder.startswith("file:"):
        return "/" + folder.removeprefix("file:").lstrip("/")
    return None if "://" in folder else folder


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this content, whole and only if it does not exist; whether that was so.

    On a local disk by a hard link, elsewhere by a rename that does not replace, which HDFS does in one
    step.  A store without such a rename needs a file system client that has one.
    """
    local = _local(path)
    if local:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        draft = f"{local}.{uuid.uuid4().hex}"
        with open(draft, "w") as f:
            f.write(text)
        try:
            os.link(draft, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs
    to, draft = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    files = to.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    context = hadoop.FileContext.getFileContext(to.toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, to, none)
    except Exception:
        if not files.exists(to):
            raise
        files.delete(draft, False)
        return False
    return True


def commits(spark: SparkSession, folder: str) -> list[str]:
    """Names of the data folders in the order of their commits; one name per commit."""
    if not exists(spark, f"{folder}/log"):
        return []
    log = spark.read.text(f"{folder}/log/*[0-9]", wholetext=True)
    rows = log.select("_metadata.file_name", "value").collect()
    return [r["value"] for r in sorted((r for r in rows if r["file_name"].isdigit()), key=lambda r: r["file_name"])]


def committed(spark: SparkSession, folder: str, schema: T.StructType, names: list[str] | None = None) -> DataFrame:
    """The rows of all commits, or of those named."""
    names = commits(spark, folder) if names is None else names
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{folder}/data/{n}" for n in names])


def commit_records(
    new: DataFrame, folder: str, keys: list[str], order: list[str], rule: Column, strict: bool = False, attempts: int = ATTEMPTS
) -> DataFrame:
    """Add the rows of ``new`` that pass ``rule`` and whose key is new; all rows with their ``refusal``.

    Of the rows with one key the first in ``order`` is taken.  ``strict`` adds nothing if any is refused.
    ``new`` may have no column called refusal.  Safe with any number of writers: see ``claim``.
    """
    spark = new.sparkSession
    new = settle(new)
    for _ in range(attempts):
        names = commits(spark, folder)
        decided = settle(register_records(new, committed(spark, folder, new.schema, names), keys, order, rule))
        if strict:
            bad = rejected(decided).select("refusal").limit(1).collect()
            if bad:
                raise RegistrationError(bad[0]["refusal"])
        rows = accepted(decided)
        if rows.isEmpty():
            return decided
        name = uuid.uuid4().hex
        rows.write.parquet(f"{folder}/data/{name}")
        if claim(spark, f"{folder}/log/{len(names):020d}", name):
            return decided
        remove(spark, f"{folder}/data/{name}")
    raise CommitError(f"{folder} was changed by others {attempts} times in a row")
