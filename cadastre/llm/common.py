"""What several operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

import cadastre
from cadastre.operators.skew import fits_broadcast
from cadastre.sources.scratch import cut

# Words of the result contracts; Java and Python read the pattern alike.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once a session, so that workers need no installation."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.realpath(cadastre.__file__))
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="cadastre-")), "cadastre.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def in_parts(batches, rows: int = 1024):
    """The frames of an Arrow stream in smaller ones, so that what is made of them stays small."""
    for pdf in batches:
        for low in range(0, len(pdf), rows):
            yield pdf.iloc[low : low + rows]


def map_frames(df: DataFrame, fn, schema: str, rows: int = 1024) -> DataFrame:
    """``mapInArrow`` that hands ``fn`` small pandas frames, so that a task holds little in Python.

    Whole numbers with nulls come as objects, not as floats.
    """
    kind = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                out = fn(batch.slice(low, rows).to_pandas(integer_object_nulls=True))
                yield pa.RecordBatch.from_pandas(out, schema=arrow, preserve_index=False)

    return df.mapInArrow(run, kind)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def maybe_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side that was measured to be small; else leave the join to be shuffled."""
    return F.broadcast(df) if fits_broadcast(df) else df


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the 0-based place of each row in a total order, without one task that sees all rows.

    Rows are dealt out by ranges; one count per range goes to the driver.
    """
    spark, part = df.sparkSession, fresh(df, "_part")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(df.repartitionByRange(n, *order).withColumn(part, F.spark_partition_id()))
    base, bases = 0, {}
    for row in dealt.groupBy(part).count().orderBy(part).collect():
        bases[row[part]], base = base, base + row["count"]
    if not bases:
        return dealt.drop(part).withColumn(name, F.lit(0).cast("long"))
    before = F.element_at(F.create_map(*[F.lit(x) for kv in bases.items() for x in kv]), F.col(part))
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return dealt.withColumn(name, (place - 1 + before).cast("long")).drop(part)
