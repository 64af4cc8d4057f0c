"""From manifest files to a checked catalogue, its endpoints and its index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastre.functions.rules import FIELDS, check_records, is_valid
from cadastre.operators.catalogue import (
    duplicate_keys,
    expand_endpoints,
    grouped_index,
    missing_targets,
    mounted,
    owners_only,
)
from cadastre.operators.routes import catalogue_routes
from cadastre.sources.listing import list_tree, module_listing, static_listing
from cadastre.sources.manifests import decode_records, manifest_scan
from cadastre.sources.scratch import settle


# Fixed values of the messages.
INVALID = "Invalid manifest "
DUPLICATE = "duplicate mount_path '"


class CatalogueError(ValueError):
    """Strict loading met a bad record; the message names the first one in path order."""


def typed_records(decoded: DataFrame) -> DataFrame:
    """Flat record columns with ``violations``; an undecodable row has the one violation
    ``decode``."""
    keep = [c for c in decoded.columns if c != "rec"]
    rows = decoded.select(*keep, *[F.col(f"rec.{f}").alias(f) for f in FIELDS])
    checked = check_records(rows, "present_fields", "type_errors")
    failed = F.array(
        F.struct(
            F.lit(0).alias("stage"), F.lit("").alias("field"), F.lit("decode").alias("code")
        )
    )
    return checked.withColumn(
        "violations",
        F.when(F.col("decode_error").isNotNull(), failed).otherwise(F.col("violations")),
    )


def load_records(spark: SparkSession, root: str, fmt: str = "yaml") -> DataFrame:
    """Scan, decode and check; every file gives a row, good or bad.

    The files are decoded once, for all that is asked of the records later.
    """
    return settle(typed_records(decode_records(manifest_scan(spark, root), fmt)))


def violation_text() -> Column:
    return F.array_join(
        F.transform("violations", lambda v: F.concat_ws(" ", v["field"], v["code"])), "; "
    )


def invalid_problems(records: DataFrame, order: str, path: str, root: str = "") -> DataFrame:
    """``root`` is the name of the root folder, which the messages then begin paths with."""
    detail = violation_text()
    if "decode_error" in records.columns:
        detail = F.coalesce("decode_error", detail)
    return records.filter(~is_valid()).select(
        F.lit(0).alias("severity"),
        F.col(order).alias("place"),
        F.concat(
            F.lit(INVALID + (f"{root}/" if root else "")), F.col(path).cast("string"), F.lit(": "), detail
        ).alias("message"),
    )


def duplicate_problems(
    records: DataFrame, order: str) -> DataFrame:
    found = duplicate_keys(
        records.filter(is_valid()).select(order, "group", "slug", "mount_path"),
        "mount_path",
        order,
        ["group", "slug"])
    return found.select(
        F.lit(1).alias("severity"),
        F.col(order).alias("place"),
        F.concat(
            F.lit(DUPLICATE),
            "mount_path",
            F.lit("' in "),
            F.concat_ws("/", "group", "slug"),
            F.lit(" and "),
            F.concat_ws("/", "owner.group", "owner.slug"),
        ).alias("message"),
    )


def problems(
    records: DataFrame, order: str, path: str, root: str = "") -> DataFrame:
    """``(severity, place, message)`` of every invalid row and every later row of a taken key."""
    return invalid_problems(records, order, path, root).unionByName(
        duplicate_problems(records, order)
    )


def first_problem(found: DataFrame) -> DataFrame:
    """The problem that stops a strict load: any invalid row comes before any duplicate."""
    first = F.min(F.struct("severity", "place", "message")).alias("_first")
    return found.agg(first).filter(F.col("_first").isNotNull()).select("_first.*")


def require_clean(records: DataFrame, order: str = "path_parts", path: str = "path", root: str = "") -> None:
    """Raise ``CatalogueError`` with the first problem.  One job; it brings one row to the driver."""
    bad = first_problem(problems(records, order, path, root)).first()
    if bad:
        raise CatalogueError(bad["message"])


def build_catalogue(
    records: DataFrame,
    modules: DataFrame,
    static_dirs: DataFrame,
    order: str = "path_parts") -> DataFrame:
    """Valid owners of their key with ``module_ok``, ``static_ok`` and ``status``."""
    owners = owners_only(records.filter(is_valid()), "mount_path", order)
    checked = missing_targets(owners, modules, static_dirs)
    return checked.withColumn("status", status_on_row())


def catalogue_of_tree(spark: SparkSession, root: str, package: str = "apps") -> DataFrame:
    """The catalogue of a tree of files, nothing handed in: manifests, modules and folders are read from it.

    Bad manifests and later owners of a path are left out; ``problems`` reports them.
    """
    listed = settle(list_tree(spark, root))
    modules = module_listing(spark, root, package, listed)
    return build_catalogue(load_records(spark, root), modules, static_listing(spark, root, listed))


def status_on_row() -> Column:
    """Status where the key is unique, so that the row itself knows whether it is broken."""
    ok = F.coalesce("module_ok", F.lit(True)) & F.coalesce("static_ok", F.lit(True))
    return F.when(~F.col("enabled"), "offline").when(~ok, "broken").otherwise("online")


def catalogue_index(catalogue: DataFrame, order: str = "path_parts") -> DataFrame:
    """Cards of the catalogue, which is built once for the groups and the cards."""
    return grouped_index(settle(catalogue), order)


def routes_of(catalogue: DataFrame, order: str = "path_parts") -> DataFrame:
    return catalogue_routes(mounted(expand_endpoints(catalogue)), order)
