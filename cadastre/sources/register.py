"""Registering new records: check them, refuse keys that exist, append the rest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastre.functions.rules import KINDS, SLUG_PATTERN
from cadastre.functions.text import (
    canonical_path,
    default_entry,
    default_static_dir,
    slug_to_module,
)
from cadastre.sources.scratch import settle


class RegistrationError(ValueError):
    """Strict registration met a record it cannot accept."""


def refusal_by_rule() -> Column:
    """First rule a request breaks, in the order group, slug, kind; null when it breaks none."""
    bad = lambda c: ~F.coalesce(F.col(c).rlike(SLUG_PATTERN), F.lit(False))
    return (
        F.when(bad("group"), "invalid group")
        .when(bad("slug"), "invalid slug")
        .when(~F.coalesce(F.col("kind").isin(*KINDS), F.lit(False)), "invalid kind")
    )


def new_records(requests: DataFrame) -> DataFrame:
    """Fill the derived fields of a request: name, path, entry and static directory by kind."""
    return requests.withColumns(
        {
            "name": F.col("slug"),
            "mount_path": canonical_path("group", "slug"),
            "entry": default_entry("kind", "group", "slug"),
            "static_dir": default_static_dir("kind"),
            "enabled": F.lit(True),
            "directory": F.concat(slug_to_module("group"), F.lit("/"), slug_to_module("slug")),
        }
    )


def register_records(
    new: DataFrame, existing: DataFrame, keys: list[str], order: list[str], rule: Column
) -> DataFrame:
    """Add ``refusal`` to every new row; null means accepted.

    ``rule`` is null for rows that pass the checks.  Of the passing rows with one key the first in
    ``order`` (unique within a key) is taken, and only if the key does not exist yet.

    Existing keys are compared with one row per key, and its verdict goes back to the rows on key
    and order together, so a key that is repeated very often does not gather in one task.
    """
    names = {c: f"_{c}" for c in [*keys, *order]}
    rows = new.withColumn("_rule", rule)
    first = (
        rows.filter(F.col("_rule").isNull())
        .groupBy(*keys)
        .agg(F.min(F.struct(*order)).alias("_at"))
        .select(*keys, *[F.col(f"_at.{c}").alias(c) for c in order])
    )
    taken = existing.select(*keys).distinct().withColumn("_taken", F.lit(True))
    verdict = first.join(taken, keys, "left").withColumnsRenamed(names)
    verdict = verdict.withColumn("_first", F.lit(True))
    on = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(verdict[n]) for c, n in names.items()])
    return (
        rows.join(verdict, on, "left")
        .withColumn(
            "refusal",
            F.coalesce(
                "_rule",
                F.when(F.col("_first").isNull() | F.col("_taken").isNotNull(), "exists"),
            ),
        )
        .drop(*names.values(), "_rule", "_first", "_taken")
    )


def accepted(decided: DataFrame) -> DataFrame:
    return decided.filter(F.col("refusal").isNull()).drop("refusal")


def rejected(decided: DataFrame) -> DataFrame:
    return decided.filter(F.col("refusal").isNotNull())


def append_accepted(decided: DataFrame, path: str, strict: bool = False, mode: str = "append"):
    """Write the accepted rows; ``strict`` writes nothing if any row is refused."""
    if strict:
        decided = settle(decided)
        bad = rejected(decided).select("refusal").limit(1).collect()
        if bad:
            raise RegistrationError(bad[0]["refusal"])
    accepted(decided).write.mode(mode).parquet(path)
