"""Keys, targets, status and grouping of catalogue records.

``order`` is the column that carries the record's place in the catalogue (``path_parts`` after a
scan).  Places are compared; they are counted only where a caller asks for the place of each row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastre.functions.rules import NEEDS_ENTRY, NEEDS_STATIC_DIR
from cadastre.functions.text import entry_attr, entry_module, slug_to_module
from cadastre.operators.sequence import with_place
from cadastre.operators.skew import lookup_join
from cadastre.sources.scratch import settle


def duplicate_keys(
    df: DataFrame,
    key: str,
    order: str,
    owner_fields: list[str]) -> DataFrame:
    """Rows whose key an earlier row already has, each with ``owner``: the first row's fields."""
    owner = F.min(F.struct(order, *owner_fields)).alias("owner")
    owners = df.groupBy(key).agg(owner, F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    out = lookup_join(df, settle(owners), [key], "inner")
    return out.filter(F.col(order) > F.col(f"owner.{order}"))


def owners_only(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of every key, in one pass; rows of a key are reduced before the shuffle."""
    first = F.min_by(F.struct(*[c for c in df.columns if c != key]), order).alias("_first")
    return df.groupBy(key).agg(first).select(key, "_first.*").select(*df.columns)


def static_path() -> Column:
    """Where the record's static files are: module directories, then ``static_dir``.

    A null part gives null, since such a record has no directory; an absolute ``static_dir`` is
    the whole path.
    """
    own = F.concat_ws("/", F.lit(""), F.col("static_dir"))
    below = F.concat(slug_to_module("group"), F.lit("/"), slug_to_module("slug"), own)
    below = F.when(F.col("static_dir").isNotNull(), below)
    return normal_path(F.when(F.col("static_dir").startswith("/"), F.col("static_dir")).otherwise(below))


def normal_path(path: Column) -> Column:
    """The path without empty and ``.`` parts and with ``..`` resolved: ``dist``, ``./dist`` and ``a/../dist`` are one.

    ``..`` at the root stays there; before the start of a relative path it is kept.
    """
    parts = F.filter(F.split(path, "/"), lambda x: ~x.isin("", "."))
    absolute = path.startswith("/")

    def step(done, part):
        up = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1)) != "..")
        back = F.when(up, F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        back = back.when(absolute, done).otherwise(F.concat(done, F.array(part)))
        return F.when(part == "..", back).otherwise(F.concat(done, F.array(part)))

    parts = F.when(F.array_contains(parts, ".."), F.aggregate(parts, F.array().cast("array<string>"), step)).otherwise(parts)
    return F.concat(F.when(absolute, "/").otherwise(""), F.array_join(parts, "/"))


def missing_targets(
    df: DataFrame, modules: DataFrame, static_dirs: DataFrame) -> DataFrame:
    """Add ``module_ok`` and ``static_ok``; null where the record's kind has no such target.

    ``modules(module, attr)`` and ``static_dirs(static_path)`` list what exists.
    """
    needs_entry, needs_static = F.col("kind").isin(*NEEDS_ENTRY), F.col("kind").isin(*NEEDS_STATIC_DIR)
    rows = df.withColumns(
        {
            "module": F.when(needs_entry, entry_module("entry")),
            "attr": F.when(needs_entry, entry_attr("entry")),
            "static_path": F.when(needs_static, static_path()),
        }
    )
    modules = settle(modules.select("module", "attr").distinct()).withColumn("_module", F.lit(True))
    static_dirs = static_dirs.select(normal_path(F.col("static_path")).alias("static_path"))
    static_dirs = settle(static_dirs.distinct()).withColumn(
        "_static", F.lit(True)
    )
    rows = lookup_join(rows, modules, ["module", "attr"], "left")
    rows = lookup_join(rows, static_dirs, ["static_path"], "left")
    return rows.withColumns(
        {
            "module_ok": F.when(needs_entry, F.col("_module").isNotNull()),
            "static_ok": F.when(needs_static, F.col("_static").isNotNull()),
        }
    ).drop("module", "attr", "static_path", "_module", "_static")


def broken_records(checked: DataFrame) -> DataFrame:
    """Enabled rows with a missing target; every other row is unaffected."""
    bad = ~F.coalesce("module_ok", F.lit(True)) | ~F.coalesce("static_ok", F.lit(True))
    return checked.filter(F.col("enabled") & bad)


def without_reference(
    df: DataFrame, listing: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not in the listing."""
    keys = settle(listing.select(*on).distinct())
    return lookup_join(df, keys, on, "left_anti")


def with_status(
    df: DataFrame, broken: DataFrame, key: str = "mount_path") -> DataFrame:
    """Add ``status``: a disabled row is offline even when broken."""
    keys = settle(broken.select(key).distinct()).withColumn("_broken", F.lit(True))
    rows = lookup_join(df, keys, [key], "left")
    status = (
        F.when(~F.col("enabled"), "offline")
        .when(F.col("_broken").isNotNull(), "broken")
        .otherwise("online")
    )
    return rows.withColumn("status", status).drop("_broken")


def expand_endpoints(df: DataFrame) -> DataFrame:
    """One row per endpoint of a record: ``role_order``, ``role``, ``mount_at`` and ``target``.

    A fullstack record has its API below ``/api``, registered before its static files.
    """
    kind, mount = F.col("kind"), F.col("mount_path")

    def endpoint(order, role, at, target):
        return F.struct(
            F.lit(order).alias("role_order"),
            F.lit(role).alias("role"),
            at.alias("mount_at"),
            target.alias("target"),
        )

    entry, static = F.col("entry"), static_path()
    by_kind = (
        F.when(kind == "backend", F.array(endpoint(0, "app", mount, entry)))
        .when(kind == "frontend", F.array(endpoint(1, "static", mount, static)))
        .when(
            kind == "fullstack",
            F.array(
                endpoint(0, "app", F.concat(mount, F.lit("/api")), entry),
                endpoint(1, "static", mount, static),
            ),
        )
    )
    return df.select("*", F.explode(by_kind).alias("_endpoint")).select(
        *df.columns, "_endpoint.*"
    )


def mounted(endpoints: DataFrame) -> DataFrame:
    """Endpoints that exist: registration of a record stops at its first missing target, what was
    registered before stays."""
    app = F.coalesce("module_ok", F.lit(True))
    static = app & F.coalesce("static_ok", F.lit(True))
    return endpoints.filter("enabled").filter(
        F.when(F.col("role") == "app", app).otherwise(static)
    )


CARD = ("name", "description", "members", "mount_path", "status")


def grouped_index(
    df: DataFrame,
    order: str,
    group: str = "group",
    card: tuple[str, ...] = CARD) -> DataFrame:
    """Cards with ``group_key``, the place of the group's first row.

    The rows stay flat, one per card, so a group may be of any size; sorting by
    ``(group_key, order)`` lists groups by first appearance and cards in source order.
    """
    first = settle(df.groupBy(group).agg(F.min(order).alias("group_key")))
    return lookup_join(df.select(group, order, *card), first, [group], "inner")


def index_order(df: DataFrame, order: str, place: str | None = None) -> DataFrame:
    """Sorted by group and card; or, with ``place``, each row's place in that order, from 0."""
    return with_place(df, ["group_key", order], place) if place else df.orderBy("group_key", order)


def path_order(df: DataFrame, parts: Column, *ties: str, place: str | None = None) -> DataFrame:
    """Sort by path components, so that ``a/x`` comes before ``a-b/x``, and equal paths by ``ties``.

    With ``place`` the rows are not sorted but get their place in that order, from 0.
    """
    return with_place(df, [parts, *ties], place) if place else df.orderBy(parts, *ties)
