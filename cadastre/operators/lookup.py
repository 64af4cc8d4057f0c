"""Lookups by key, by an ordered array of keys, and by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastre.functions.text import json_array
from cadastre.operators.inline import entry, hash_table
from cadastre.operators.skew import lookup_join, salted_join
from cadastre.sources.scratch import settle


def array_lookup(
    df: DataFrame,
    ids: str,
    dim: DataFrame,
    key: str,
    keep: list[str],
    salted: bool = False) -> DataFrame:
    """One row per array item with ``position``, the looked-up columns and ``is_missing``.

    An id without a row is kept and marked, not dropped.  ``salted`` deals hot ids out by salts, for a
    table that adaptive execution does not split.
    """
    items = df.select(*keep, F.posexplode(ids).alias("position", key))
    side = dim.withColumn("_found", F.lit(True))
    found = salted_join(items, side, [key]) if salted else lookup_join(items, side, [key], "left")
    return found.withColumn("is_missing", F.col("_found").isNull()).drop("_found")


def array_lookup_inside(df: DataFrame, ids: str, dim: DataFrame, key: str, name: str) -> DataFrame:
    """Add ``name``: the items of ``ids`` in their order, each with position, key, the columns of ``dim`` and is_missing.

    For a ``dim`` that was measured to be small: it is one row, broadcast, and the array is resolved in
    its own row, on a stream too.  A null array stays null.  Repeated keys count once, nulls are missing.
    """
    others = [c for c in dim.columns if c != key]
    kind = dict(dim.dtypes)[key]
    table = settle(hash_table(dim, [key], "_table"))
    rows = df.withColumn("_table_of", F.lit(0))
    side = table.withColumn("_table_of", F.lit(0))
    joined = lookup_join(rows, side, ["_table_of"], "left", True)

    def item(id, position):
        found = entry(F.col("_table"), **{key: id.cast(kind)})
        values = [found[c].alias(c) for c in others]
        return F.struct(position.alias("position"), id.alias(key), *values, found.isNull().alias("is_missing"))

    return joined.withColumn(name, F.transform(ids, item)).drop("_table", "_table_of")


def dimension_lookup(
    df: DataFrame, dim: DataFrame, on: list[str]) -> DataFrame:
    """Rows with the attributes of their key; a key without attributes has no row."""
    return lookup_join(df, dim, on, "inner")


def ordered_concat(
    items: DataFrame, parent: list[str], position: str, text: Column, name: str, separator: str = "", chunk: int = 1000
) -> DataFrame:
    """Per parent, the children's text joined in the order of their whole-number positions.

    In two levels: children of ``chunk`` consecutive positions are joined to a text first, these texts
    then in their order, so no task holds the rows of a parent that has very many.  Null texts are left out.
    """
    run = F.floor(F.col(position) / F.lit(chunk)).alias("_run")
    pairs = lambda order, value: F.array_sort(F.collect_list(F.struct(F.col(order).alias("p"), value.alias("t"))))
    joined = lambda pairs: F.array_join(F.transform(pairs, lambda x: x["t"]), separator)
    rows = items.select(*parent, run, F.col(position).alias("_position"), text.alias("_text"))
    # A chunk of null texts only has no text either; an empty one would bring a separator.
    several = F.when(F.count("_text") > 0, joined(pairs("_position", F.col("_text"))))
    runs = rows.groupBy(*parent, "_run").agg(several.alias("_text"))
    return runs.groupBy(*parent).agg(joined(pairs("_run", F.col("_text"))).alias(name))


def positional_join(
    items: DataFrame, notes: DataFrame, key: str, position: str, notes_json: str
) -> DataFrame:
    """The i-th note of a JSON array with the i-th item; null where there is no such note.

    The join is on list and position together, so one long list does not gather in one task.
    """
    notes = notes.select(key, F.posexplode(json_array(notes_json)).alias(position, "note"))
    notes = notes.withColumn(position, F.col(position).cast(items.schema[position].dataType))
    return items.join(notes, [key, position], "left")
