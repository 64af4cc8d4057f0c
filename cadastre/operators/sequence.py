"""Operators on ordered lists: positions, neighbours and transitions.

``key`` names the list, ``order`` the columns that order it.  The rows are shuffled once, by list
(and slice, see ``skew.ordered_lists``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastre.functions.text import clamp, direction, zero_pad
from cadastre.operators.skew import ROWS_PER_TASK, Lists, ordered_lists
from cadastre.sources.scratch import settle

# Where a list starts, and what stands for no previous item.
INITIAL_INDEX = 0
NO_PREVIOUS = -1

_HELPERS = ("_hot", "_slice")


def _done(df: DataFrame, *more: str) -> DataFrame:
    return df.drop(*_HELPERS, *more)


def _number(lists: Lists) -> DataFrame:
    """Add ``_nth``, the 1-based position in the whole list."""
    out = lists.df.withColumn("_nth", F.row_number().over(lists.window).cast("bigint"))
    if lists.split:
        before = lists.over_slices.rowsBetween(Window.unboundedPreceding, -1)
        counts = lists.slices(F.count("*").alias("_rows"))
        counts = counts.withColumn("_before", F.sum("_rows").over(before)).drop("_rows")
        out = lists.carry(out, counts)
        out = out.withColumn("_nth", F.col("_nth") + F.coalesce("_before", F.lit(0)))
        out = out.drop("_before")
    return out


def with_place(df: DataFrame, order: list[Column | str], name: str = "place") -> DataFrame:
    """Add each row's place, from 0, in the order of the whole table; ``order`` should be unique.

    The rows are dealt out by ranges of the order and numbered range by range, so no task sees them
    all; a table with one row per range says how many rows are before it.
    """
    terms = [f"_order_{i}" for i in range(len(order))]
    rows = df.select("*", *[(F.col(c) if isinstance(c, str) else c).alias(t) for c, t in zip(order, terms)])
    rows = rows.repartitionByRange(*terms).withColumns({"_slice": F.spark_partition_id(), "_all": F.lit(0), "_hot": F.lit(True)})
    rows = settle(rows)  # with the key: Spark drops one that it sees to be constant from the windows
    out = _number(Lists(rows, ["_all"], terms, split=True))
    return _done(out.withColumn(name, F.col("_nth") - 1), "_nth", "_all", *terms)


def renumber(
    df: DataFrame, key: list[str], order: list[str], label, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Dense positions per list: ``position`` from 0 and ``numbered_label`` as ``NN label``."""
    label = F.col(label) if isinstance(label, str) else label
    out = _number(ordered_lists(df, key, order, rows_per_task))
    out = out.withColumn("position", F.col("_nth") - 1)
    out = out.withColumn("numbered_label", F.concat(zero_pad("_nth"), F.lit(" "), label))
    return _done(out, "_nth")


def _around(lists: Lists, value: Column) -> DataFrame:
    """Add ``_prev`` and ``_next``: the nearest non-null ``value`` before and after each row.

    lag/lead that skip nulls read a partition once; a frame to the end of the list would read it
    again for every row.
    """
    part = lists.keys + (["_slice"] if lists.split else [])
    over = f"OVER (PARTITION BY {_names(part)} ORDER BY {_names(lists.order)})"
    out = lists.df.withColumn("_value", value)
    out = out.withColumn("_prev", F.expr(f"lag(_value) IGNORE NULLS {over}"))
    out = out.withColumn("_next", F.expr(f"lead(_value) IGNORE NULLS {over}"))
    if lists.split:
        at = F.when(value.isNotNull(), F.struct(*lists.order))
        edges = lists.slices(
            F.min_by(value, at).alias("_first"), F.max_by(value, at).alias("_last")
        )
        over = f"OVER (PARTITION BY {_names(lists.keys)} ORDER BY _slice)"
        edges = edges.select(
            *lists.keys,
            "_slice",
            F.expr(f"lag(_last) IGNORE NULLS {over}").alias("_before"),
            F.expr(f"lead(_first) IGNORE NULLS {over}").alias("_after"),
        )
        out = lists.carry(out, edges)
        out = out.withColumn("_prev", F.coalesce("_prev", "_before"))
        out = out.withColumn("_next", F.coalesce("_next", "_after")).drop("_before", "_after")
    return out.drop("_value")


def _names(columns: list[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def neighbours(
    df: DataFrame,
    key: list[str],
    order: list[str],
    item: str,
    skip: Column,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``previous_visible`` and ``next_visible``: the nearest item that is not skipped."""
    lists = ordered_lists(df, key, order, rows_per_task)
    out = _around(lists, F.when(~F.coalesce(skip, F.lit(False)), F.col(item)))
    return _done(out.withColumnsRenamed({"_prev": "previous_visible", "_next": "next_visible"}))


def last_visible(
    df: DataFrame,
    key: list[str],
    order: list[str],
    skip: Column,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``is_last_visible``: the last row that is not skipped; no row if all are."""
    visible = ~F.coalesce(skip, F.lit(False))
    out = _around(ordered_lists(df, key, order, rows_per_task), F.when(visible, F.lit(True)))
    out = out.withColumn("is_last_visible", visible & F.col("_next").isNull())
    return _done(out, "_prev", "_next")


def _previous(lists: Lists, value: Column) -> DataFrame:
    """Add ``_before``: a struct with the previous row's value, null on the first row only."""
    out = lists.df.withColumn("_before", F.lag(F.struct(value.alias("v"))).over(lists.window))
    if lists.split:
        last = lists.slices(
            F.max_by(F.struct(value.alias("v")), F.struct(*lists.order)).alias("_end")
        )
        last = last.withColumn("_end", F.lag("_end").over(lists.over_slices))
        out = lists.carry(out, last)
        out = out.withColumn("_before", F.coalesce("_before", "_end")).drop("_end")
    return out


def transitions(
    df: DataFrame,
    key: list[str],
    order: list[str],
    index: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``previous_index`` (-1 on the first event of a list) and ``direction``."""
    out = _previous(ordered_lists(df, key, order, rows_per_task), F.col(index))
    out = out.withColumn(
        "previous_index",
        F.when(F.col("_before").isNull(), F.lit(NO_PREVIOUS)).otherwise(F.col("_before.v")),
    )
    out = out.withColumn("direction", direction(index, "previous_index"))
    return _done(out, "_before")


def suppress_noop(
    df: DataFrame,
    key: list[str],
    order: list[str],
    target: str,
    n,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Keep events that change the state; adds ``index``, the clamped target.

    After every event, kept or dropped, the state equals that event's clamped target, so comparing
    with the previous row is the same as replaying the list.
    """
    lists = ordered_lists(df.withColumn("index", clamp(target, n)), key, order, rows_per_task)
    out = _previous(lists, F.col("index"))
    state = F.when(F.col("_before").isNull(), F.lit(INITIAL_INDEX)).otherwise(F.col("_before.v"))
    return _done(out.filter(~F.col("index").eqNullSafe(state)), "_before")


def flagged_positions(
    df: DataFrame, key: list[str], order: list[str], flag: Column, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """0-based positions of the flagged rows of each list, one row ``(key, position)`` each."""
    lists = ordered_lists(df.withColumn("_flag", flag), key, order, rows_per_task)
    return _number(lists).filter("_flag").select(*key, (F.col("_nth") - 1).alias("position"))
