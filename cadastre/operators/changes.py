"""From changed paths to the units they touch, and reports on those units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastre.operators.sequence import with_place
from cadastre.operators.skew import lookup_join
from cadastre.sources.scratch import settle

# Fixed values of the report.
APPS = "apps/"
NOTE_PRESENT = "see job logs"
NOTE_MISSING = "add a project.yaml"
NOTE_NONE = "No app paths changed"
SKIPPED = "skipped"


def changed_units(paths: DataFrame, path: str = "path") -> DataFrame:
    """Distinct ``unit`` = ``group/project`` of the paths below ``apps/``."""
    parts = F.split(F.col(path), "/")
    name = F.coalesce(F.try_element_at(parts, F.lit(3)), F.lit(""))
    return (
        paths.filter(F.col(path).startswith(APPS))
        .select(F.concat(F.try_element_at(parts, F.lit(2)), F.lit("/"), name).alias("unit"))
        .distinct()
    )


def affected_units(
    paths: DataFrame, manifests: DataFrame, path: str = "path") -> DataFrame:
    """Changed units that have a manifest, with the columns of ``manifests(unit, ...)``.

    Units are made distinct before the join, so a unit that changed very often is one row.
    """
    return lookup_join(changed_units(paths, path), manifests, ["unit"], "inner")


def presence_report(
    paths: DataFrame, manifests: DataFrame, path: str = "path") -> DataFrame:
    """``(unit, presence, note)`` of every changed unit; one ``none`` row when nothing changed."""
    units = settle(changed_units(paths, path))
    known = settle(manifests.select("unit").distinct()).withColumn("_known", F.lit(True))
    has = F.col("_known").isNotNull()
    report = lookup_join(units, known, ["unit"], "left").select(
        "unit",
        F.when(has, "present").otherwise("missing").alias("presence"),
        F.when(has, NOTE_PRESENT).otherwise(NOTE_MISSING).alias("note"),
    )
    none = (
        units.agg(F.count("*").alias("_n"))
        .filter("_n = 0")
        .select(
            F.lit("").alias("unit"), F.lit("none").alias("presence"), F.lit(NOTE_NONE).alias("note")
        )
    )
    return report.unionByName(none)


def status_matrix(
    df: DataFrame, unit: str, check: str, checks: list[str], status: Column, worst_first: list[str], unlisted: str = "unlisted"
) -> DataFrame:
    """One row per unit, one column per check; a check that did not run is ``skipped``.

    Of several results of a check the worst counts, by its place in ``worst_first``; a status that is not
    in it is worse than all, the least text first.  The checks are named by the caller, so no extra pass
    looks for them; ``unlisted`` counts the rows of other checks.  A null status is no result.
    """
    place = F.array_position(F.array(*map(F.lit, worst_first)), F.col("_status"))  # 0: not in it
    rows = df.select(unit, check, status.alias("_status"))
    ranked = rows.withColumn("_rank", F.when(F.col("_status").isNotNull(), F.struct(place.alias("rank"), "_status")))
    worst = [
        F.coalesce(F.min(F.when(F.col(check) == c, F.col("_rank")))["_status"], F.lit(SKIPPED)).alias(c) for c in checks
    ]
    others = F.count(F.when(~F.coalesce(F.col(check).isin(*checks), F.lit(False)), 1)).alias(unlisted)
    return ranked.groupBy(unit).agg(*worst, others)


def distinct_sorted(df: DataFrame, key: Column, name: str, place: str | None = None) -> DataFrame:
    """Distinct derived keys in order; or, with ``place``, each key's place in that order, from 0."""
    keys = df.select(key.alias(name)).distinct()
    return with_place(keys, [name], place) if place else keys.orderBy(name)
