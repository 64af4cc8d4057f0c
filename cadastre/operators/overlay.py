"""Layers of keyed rows: for one key the later layer wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def override(df: DataFrame, key: list[str], layer: str) -> DataFrame:
    """One row per key, from its highest layer.

    Rows of a key are reduced before the shuffle.  Rows that share key and layer are told apart by
    their other columns, so the result does not depend on the order rows arrive in.
    """
    rest = [c for c in df.columns if c not in (*key, layer)]
    top = F.max(F.struct(layer, *rest)).alias("_top")
    return df.groupBy(*key).agg(top).select(*key, "_top.*")


def layered_overlay(layers: list[tuple[DataFrame | None, str | None, bool]], key: str) -> DataFrame:
    """Union of ``(rows, prefix, optional)`` layers, adding ``layer``; the later layer wins.

    A prefix is put before the key, as a directory.  An optional layer may be ``None``.
    """
    parts = []
    for number, (rows, prefix, optional) in enumerate(layers):
        if rows is None:
            if not optional:
                raise ValueError(f"layer {number} is missing and not optional")
            continue
        if prefix:
            rows = rows.withColumn(key, F.concat(F.lit(f"{prefix.strip('/')}/"), F.col(key)))
        parts.append(rows.withColumn("layer", F.lit(number)))
    return override(reduce(DataFrame.unionByName, parts), [key], "layer")
