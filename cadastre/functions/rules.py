"""Record rules.  One projection adds ``violations``; no rule drops a row.

Field errors form stage 1 and are reported together.  The kind rule (stage 2) is looked at only
when there are none, the path rule (stage 3) only when the kind rule holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastre.functions.text import canonical_path

# Fixed values of the record format.  ``\z`` rather than ``$``: a trailing newline must not pass.
SLUG_PATTERN = r"^[a-z][a-z0-9-]*\z"
KINDS = ("backend", "frontend", "fullstack")
REQUIRED = ("name", "slug", "description", "group", "members", "kind", "mount_path")
FIELDS = REQUIRED + ("entry", "static_dir", "enabled", "checks")
NEEDS_ENTRY = ("backend", "fullstack")
NEEDS_STATIC_DIR = ("frontend", "fullstack")

VIOLATIONS = "array<struct<stage:int,field:string,code:string>>"


def violation(stage: int, field, code: str) -> Column:
    field = F.lit(field) if isinstance(field, str) else field
    return F.struct(
        F.lit(stage).alias("stage"), field.alias("field"), F.lit(code).alias("code")
    )


def is_slug(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).rlike(SLUG_PATTERN)


def _none() -> Column:
    return F.array().cast(VIOLATIONS)


def _one(stage: int, field: str, code: str) -> Column:
    return F.array(violation(stage, field, code))


def _own_rules(present: str | None) -> list[tuple[str, Column, str]]:
    """Presence and content rules as ``(field, broken, code)``; a null value breaks no content rule."""
    content = {
        "slug": (~is_slug("slug"), "string_pattern_mismatch"),
        "group": (~is_slug("group"), "string_pattern_mismatch"),
        "members": (F.size("members") < 1, "too_short"),
        "kind": (~F.col("kind").isin(*KINDS), "enum"),
    }
    found = []
    for field in REQUIRED:
        absent = ~F.array_contains(present, field) if present else F.col(field).isNull()
        found.append((field, absent, "missing"))
        if field in content:
            found.append((field, *content[field]))
    return found


def field_violations(present: str | None = None, type_errors: str | None = None) -> Column:
    """Stage 1: required, type and content errors of all fields, in field order.

    ``present`` and ``type_errors`` are columns that decoding adds.  On a plain table both are
    omitted and a null required column counts as missing.
    """
    if not type_errors:
        return F.concat(
            *[
                F.when(broken, _one(1, field, code)).otherwise(_none())
                for field, broken, code in _own_rules(present)
            ]
        )
    order = F.array(*[F.lit(f) for f in FIELDS])

    def ranked(field: Column, nth: Column, code: Column) -> Column:
        top = F.substring_index(field, ".", 1)
        rank = F.array_position(order, top).cast("int")
        return F.struct(
            rank.alias("rank"), nth.alias("nth"), field.alias("field"), code.alias("code")
        )

    own = F.array_compact(
        F.array(
            *[
                F.when(broken, ranked(F.lit(field), F.lit(0), F.lit(code)))
                for field, broken, code in _own_rules(present)
            ]
        )
    )
    typed = F.transform(F.col(type_errors), lambda e, i: ranked(e["field"], i, e["code"]))
    return F.transform(
        F.array_sort(F.concat(own, typed)),
        lambda e: F.struct(
            F.lit(1).alias("stage"), e["field"].alias("field"), e["code"].alias("code")
        ),
    )


def kind_violation() -> Column:
    """Stage 2: what the kind requires; empty text counts as missing, entry is named first."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return (
        F.when(F.col("kind").isin(*NEEDS_ENTRY) & blank("entry"), _one(2, "entry", "required"))
        .when(
            F.col("kind").isin(*NEEDS_STATIC_DIR) & blank("static_dir"),
            _one(2, "static_dir", "required"),
        )
        .otherwise(_none())
    )


def path_violation() -> Column:
    """Stage 3: ``mount_path`` equals the canonical path."""
    wrong = ~F.col("mount_path").eqNullSafe(canonical_path("group", "slug"))
    return F.when(wrong, _one(3, "mount_path", "not_canonical")).otherwise(_none())


def check_records(
    df: DataFrame, present: str | None = None, type_errors: str | None = None
) -> DataFrame:
    """Add ``violations``; only the lowest stage that fails is kept.  Works on streams too."""
    staged = df.withColumn("_fields", field_violations(present, type_errors))
    staged = staged.withColumn("_kind", kind_violation()).withColumn("_path", path_violation())
    return staged.withColumn(
        "violations",
        F.when(F.size("_fields") > 0, F.col("_fields"))
        .when(F.size("_kind") > 0, F.col("_kind"))
        .otherwise(F.col("_path")),
    ).drop("_fields", "_kind", "_path")


def is_valid() -> Column:
    return F.size("violations") == 0


def enabled_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("enabled"))


def dim_unless(value, active, every) -> Column:
    """Facet highlight: true for rows outside the active set; a full or empty set dims nothing."""
    value = F.col(value) if isinstance(value, str) else value
    active, every = set(active), set(every)
    if not active or active == every:
        return F.lit(False)
    return ~F.coalesce(value.isin(*sorted(active)), F.lit(False))


def exclude_types(df: DataFrame, column: str, types) -> DataFrame:
    """Drop rows of the given types before positions are counted; an untyped row stays."""
    return df.filter(~F.coalesce(F.col(column).isin(*types), F.lit(False)))
