"""Joins and windows that hold when one key has a large share of the rows.

A key with more than ``ROWS_PER_TASK`` rows is *hot*.  At most ``rows / ROWS_PER_TASK`` keys can be
hot, so the table of hot keys stays small however large the input is.  It is found by a count per
key that is combined map-side and reads the key columns only.  Windows use the plain plan when
nothing is hot and split the hot keys otherwise; joins leave the splitting to adaptive execution, or
salt the hot keys where it does not split, as in a micro-batch.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastre.sources.scratch import settle

ROWS_PER_TASK = 2_000_000
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
JOIN_KINDS = ("inner", "left", "left_semi", "left_anti")


def _row_bytes(schema: T.StructType) -> Column:
    size = F.lit(0)
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            size = size + F.coalesce(F.octet_length(c), F.lit(0)) + 16
        elif isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16
        else:
            size = size + 8
    return size


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure a lookup side: rows and bytes, summed per partition.  Settle a costly side first."""
    seen = df.select(_row_bytes(df.schema).alias("b")).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes")
    )
    seen = seen.first()
    return seen["n"] <= max_rows and seen["bytes"] <= max_bytes


def hot_keys(df: DataFrame, keys: list[str], rows_per_task: int, *aggs: Column) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows, their count ``_n`` and any further aggregates."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"), *aggs)
        .filter(F.col("_n") > rows_per_task)
    )


def _same(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Null-safe equality, so that a null key is one key, as it is in groupBy and windows."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def attach(df: DataFrame, small: DataFrame, keys: list[str], bounded: bool) -> DataFrame:
    """Left join a side that has one row per key; ``bounded`` says its size was measured."""
    names = {k: f"_key_{k}" for k in keys}
    small = small.withColumnsRenamed(names)
    side = F.broadcast(small) if bounded else small
    return df.join(side, _same(df, small, list(names.items())), "left").drop(*names.values())


def lookup_join(
    df: DataFrame, dim: DataFrame, on: list[str], how: str = "left", small: bool | None = None
) -> DataFrame:
    """Equi join to a side with one row per key; settle that side first if it is costly to derive.

    Broadcast when the side was measured to be small (``small`` gives an earlier measurement);
    otherwise both sides are shuffled, and adaptive execution splits the left rows of a hot key by
    the map tasks that wrote them, whatever their columns are.  It does so for these four kinds of
    join only, with ``spark.sql.adaptive.skewJoin.enabled`` on (the default), for partitions above
    ``skewedPartitionThresholdInBytes`` and ``skewedPartitionFactor`` times the median.  On a
    stream nothing is split: a batch should be small enough for one key of it to fit a task.
    """
    if how not in JOIN_KINDS:
        raise ValueError(f"{how!r} is not one of {', '.join(JOIN_KINDS)}")
    if small is None:
        small = fits_broadcast(dim)
    return df.join(F.broadcast(dim) if small else dim, on, how)


SHARES = 32


def salted_join(
    df: DataFrame, dim: DataFrame, on: list[str], how: str = "left", tasks: int | None = None
) -> DataFrame:
    """Equi join to a large side with one row per key, the hot keys of ``df`` dealt out over all tasks.

    For a table written already, such as a micro-batch: it is read for its keys and again for the join.  A
    key with more than a quarter of a task's fair share is hot.  Its rows take turns over as many salts as
    it has ``SHARES``-ths of a share, and only its row of ``dim`` is copied, once per salt.
    """
    if how not in JOIN_KINDS:
        raise ValueError(f"{how!r} is not one of {', '.join(JOIN_KINDS)}")
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.count()
    hot = settle(hot_keys(df, on, max(1, rows // (4 * tasks))))
    if hot.isEmpty():
        return df.join(dim, on, how)
    part = max(1, rows // (SHARES * tasks))
    salts = hot.select(*on, F.ceil(F.col("_n") / part).alias("_salts"))
    bounded = fits_broadcast(salts)
    many = F.coalesce("_salts", F.lit(1).cast("long"))
    dealt = attach(df, salts, on, bounded).withColumn("_salt", F.pmod(F.monotonically_increasing_id(), many))
    copies = attach(dim, salts, on, bounded).withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), many - 1)))
    return dealt.drop("_salts").join(copies.drop("_salts"), [*on, "_salt"], how).drop("_salt")


@dataclass
class Lists:
    """Ordered lists whose hot keys are cut into consecutive slices of nearly equal numbers of rows."""

    df: DataFrame
    keys: list[str]
    order: list[str]
    split: bool = False
    bounded: bool = True

    @property
    def window(self):
        part = [*self.keys, "_slice"] if self.split else self.keys
        return Window.partitionBy(*part).orderBy(*self.order)

    def slices(self, *aggs: Column) -> DataFrame:
        """One row per slice of the hot keys only."""
        return self.df.filter("_hot").groupBy(*self.keys, "_slice").agg(*aggs)

    @property
    def over_slices(self):
        return Window.partitionBy(*self.keys).orderBy("_slice")

    def carry(self, df: DataFrame, slices: DataFrame) -> DataFrame:
        """Bring what the slices before and after hold to the rows of a slice."""
        return attach(df, slices, [*self.keys, "_slice"], self.bounded)


def ordered_lists(
    df: DataFrame, keys: list[str], order: list[str], rows_per_task: int = ROWS_PER_TASK
) -> Lists:
    """Prepare a window over ``keys`` ordered by ``order`` (together unique within a key).

    A window puts all rows of a key into one task.  The rows of hot keys are therefore dealt out
    by ranges of the whole order, whatever its types, and each range of a key is a slice.  The
    window runs per slice, and the few values that cross slices are carried over a table with one
    row per slice.
    """
    hot = settle(hot_keys(df, keys, rows_per_task))
    total = hot.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]
    if not total:
        return Lists(df, keys, order)
    bounded = fits_broadcast(hot)
    marked = attach(df, hot.select(*keys, F.lit(True).alias("_hot")), keys, bounded)
    ranges = -(-total // rows_per_task)
    cut = marked.filter("_hot").repartitionByRange(ranges, *keys, *order)
    cut = settle(cut.withColumn("_slice", F.spark_partition_id()))
    rest = marked.filter("_hot is null").withColumn("_hot", F.lit(False))
    # A slice of a key and a range that begins with it: at most one slice more than keys and ranges.
    bounded = bounded and ranges <= BROADCAST_ROWS // 2
    rows = cut.unionByName(rest.withColumn("_slice", F.lit(-1)))
    return Lists(rows, keys, order, True, bounded)
