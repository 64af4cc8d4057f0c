"""Small lookup tables carried in a row, so that arrays are resolved without taking them apart.

A table is an array of buckets, as many as it has entries; a key's hash names its bucket.  A lookup is a
few expressions, whatever the size of the table, and works in lambdas of ``transform`` and ``aggregate``.
Tables are broadcast, so callers measure them first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_table(side: DataFrame, keys: list[str], name: str, group: str | None = None) -> DataFrame:
    """One row per ``group`` (one row in all without it) with ``name``, the table of its rows.

    An empty ``side`` gives no row; rows with a null key are in no table.  ``keys`` tell the rows of a
    group apart, else the first found counts.
    """
    side = side.dropna(subset=keys)
    by = group or "_all"
    if group is None:
        side = side.withColumn(by, F.lit(0))
    entries = side.select(by, F.struct(*[c for c in side.columns if c != by]).alias("_entry"))
    sizes = entries.groupBy(by).agg(F.count("*").cast("int").alias("_size"))
    kind = f"array<{entries.schema['_entry'].dataType.simpleString()}>"
    placed = entries.join(sizes, by)
    placed = placed.withColumn("_bucket", _bucket(F.col("_size"), *[F.col(f"_entry.{k}") for k in keys]))
    full = placed.groupBy(by, "_bucket").agg(F.collect_list("_entry").alias("_entries"))
    every = sizes.select(by, F.explode(F.sequence(F.lit(0), F.col("_size") - 1)).alias("_bucket"))
    filled = every.join(full, [by, "_bucket"], "left")
    pair = F.struct("_bucket", F.coalesce("_entries", F.array().cast(kind)).alias("_entries"))
    ordered = F.array_sort(F.collect_list(pair))
    out = filled.groupBy(by).agg(F.transform(ordered, lambda x: x["_entries"]).alias(name))
    return out if group else out.drop(by)


def _bucket(size: Column, *key: Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.nullif(size, F.lit(0))).cast("int")


def entry(table: Column, **key: Column) -> Column:
    """The row of a table with this key, null if there is none; types must be those of the table."""
    bucket = F.get(table, _bucket(F.size(table), *key.values()))
    same = lambda e: reduce(lambda a, b: a & b, [e[k] == v for k, v in key.items()])
    return F.get(F.filter(bucket, same), F.lit(0))
