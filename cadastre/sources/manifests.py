"""Manifest files: scan a two-level tree, decode each file to a typed record."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastre.functions.rules import FIELDS
from cadastre.sources.listing import list_files, read_files, stream_files, utf8

# Fixed value: where manifests are.
MANIFEST_GLOB = "*/*/project.yaml"

# Text accepted as a boolean, whatever its case.
TRUE_TEXT = ("1", "on", "t", "true", "y", "yes")
FALSE_TEXT = ("0", "off", "f", "false", "n", "no")

TEXT_FIELDS = ("name", "slug", "description", "group", "mount_path")
OPTIONAL_TEXT = ("entry", "static_dir")
CHECKS = ("pytest", "mypy")
_END = "end of text"

TYPE_ERRORS = "array<struct<field:string,code:string>>"
YAML_RESULT = T.StructType(
    [T.StructField("json", T.StringType()), T.StructField("error", T.StringType())]
)


def _with_path(files: DataFrame) -> DataFrame:
    return files.select(
        F.array_join("path_parts", "/").alias("path"), "path_parts", utf8(F.col("content")).alias("content")
    )


def manifest_scan(spark: SparkSession, root: str, depth_glob: str = MANIFEST_GLOB) -> DataFrame:
    """One row per file at ``root/depth_glob``; no match gives an empty table.

    ``path`` is relative to the root; ``path_parts`` is its sort key.  ``content`` is null for a file that
    is not UTF-8 and empty for one without bytes.  Tasks list and read; see ``listing``.
    """
    return _with_path(read_files(spark, root, list_files(spark, root, depth_glob)))


def manifest_stream(
    spark: SparkSession, root: str, depth_glob: str = MANIFEST_GLOB, lag: float = 0
) -> DataFrame:
    """The same rows as a stream: each trigger brings the files written since the last one."""
    return _with_path(stream_files(spark, root, depth_glob, lag))


def _plain(value, depth=2):
    """YAML value as a JSON value.  Dates, NaN and undecodable bytes fit no field of the record;
    they become a fraction, which no field accepts either.

    Typing looks ``depth`` levels deep.  Below, a collection is written empty: YAML lets a short
    text name the same collection again and again at every level.
    """
    if isinstance(value, dict):
        return {str(k): _plain(v, depth - 1) for k, v in value.items()} if depth else {}
    if isinstance(value, list | tuple | set):
        return [_plain(v, depth - 1) for v in value] if depth else []
    if isinstance(value, bytes):
        try:
            return value.decode()
        except UnicodeDecodeError:
            return 0.5
    if isinstance(value, float):
        if value.is_integer():
            return value if abs(value) < 1e15 else 2.0  # whole, and not 0 or 1, as it was
        return value if abs(value) < 1e15 else 0.5
    return value if value is None or isinstance(value, str | bool | int) else 0.5


def _yaml_row(text: str | None, load) -> tuple[str | None, str | None]:
    import json

    if text is None:
        return None, "not UTF-8 text"
    try:
        raw = load(text)
        if not isinstance(raw, dict):
            return None, f"a mapping is needed, found {type(raw).__name__}"
        if not all(isinstance(k, str) for k in raw):
            return None, "field names must be text"
        known = {k: v for k, v in raw.items() if k in FIELDS or not isinstance(v, dict | list | tuple | set)}
        return json.dumps(_plain(known)), None
    except Exception as e:  # constructors of tags raise whatever they meet
        return None, f"{type(e).__name__}: {' '.join(str(e).split())}"


@F.pandas_udf(YAML_RESULT)
def yaml_to_json(content: pd.Series) -> pd.DataFrame:
    import yaml

    loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
    rows = [_yaml_row(text, lambda t: yaml.load(t, Loader=loader)) for text in content]
    return pd.DataFrame(rows, columns=["json", "error"])


def _json_fields(text: Column) -> Column:
    """The known fields of a JSON mapping, each as a variant; null when the text is malformed.

    An explicit null stays a variant, so it differs from an absent field.  The parser stops after
    the first value; with the text inside another mapping, anything that follows it is an error.
    """
    known = ", ".join(f"`{f}` variant" for f in FIELDS)
    outer = F.from_json(
        F.concat(F.lit('{"doc":'), text, F.lit(f',"end":"{_END}"}}')),
        f"doc struct<{known}>, end string, malformed string",
        {"columnNameOfCorruptRecord": "malformed", "allowSingleQuotes": "false"},
    )
    return F.when(
        outer["malformed"].isNull() & (outer["end"] == _END), outer["doc"]
    )


def _json_type(v) -> Column:
    """Type of a JSON value; null when the field is absent, VOID for an explicit null."""
    return F.schema_of_variant(v)


def _is_number(tag: Column) -> Column:
    return (tag == "BIGINT") | (tag == "DOUBLE") | tag.startswith("DECIMAL")


def _as_bool(name: str) -> Column:
    """Booleans as written, 0/1, and the accepted words; null for anything else."""
    tag, v = F.col(f"_t_{name}"), F.col(f"_v_{name}")
    word, number = F.lower(F.try_variant_get(v, "$", "string")), F.try_variant_get(v, "$", "double")
    return (
        F.when(tag == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(_is_number(tag) & number.isin(0.0, 1.0), number == 1)
        .when((tag == "STRING") & word.isin(*TRUE_TEXT, *FALSE_TEXT), word.isin(*TRUE_TEXT))
    )


def _error(broken: Column, field, code) -> Column:
    field, code = (F.lit(x) if isinstance(x, str) else x for x in (field, code))
    return F.when(broken, F.struct(field.alias("field"), code.alias("code")))


def _bool_error(name: str, field: str) -> Column:
    tag, number = F.col(f"_t_{name}"), F.try_variant_get(f"_v_{name}", "$", "double")
    readable = (tag == "STRING") | (_is_number(tag) & (number == F.floor(number)))
    return _error(
        tag.isNotNull() & F.col(f"_b_{name}").isNull(),
        field,
        F.when(readable, "bool_parsing").otherwise("bool_type"),
    )


def _type_errors() -> Column:
    tag = {f: F.col(f"_t_{f}") for f in FIELDS}
    text = {f: _error(tag[f] != "STRING", f, "string_type") for f in TEXT_FIELDS}
    for f in OPTIONAL_TEXT:
        text[f] = _error(~tag[f].isin("STRING", "VOID"), f, "string_type")
    is_list, is_map = tag["members"].startswith("ARRAY"), tag["checks"].startswith("OBJECT")
    members = (
        F.when(tag["members"] == "ARRAY<STRING>", F.array().cast(TYPE_ERRORS))
        .when(
            is_list,
            F.transform(
                F.try_variant_get("_v_members", "$", "array<variant>"),
                lambda v, i: _error(
                    _json_type(v) != "STRING",
                    F.concat(F.lit("members."), i.cast("string")),
                    "string_type",
                ),
            ),
        )
        .otherwise(F.array(_error(tag["members"].isNotNull(), "members", "list_type")))
    )
    return F.array_compact(
        F.concat(
            F.array(*[text[f] for f in ("name", "slug", "description", "group")]),
            members,
            F.array(
                _error(tag["kind"] != "STRING", "kind", "enum"),
                text["mount_path"],
                text["entry"],
                text["static_dir"],
                _bool_error("enabled", "enabled"),
                _error(~is_map, "checks", "model_type"),
                *[_bool_error(c, f"checks.{c}") for c in CHECKS],
            ),
        )
    )


def _record() -> Column:
    """The typed record.  A default applies only where the field is absent."""
    fields = {
        f: F.when(F.col(f"_t_{f}") == "STRING", F.try_variant_get(f"_v_{f}", "$", "string"))
        for f in TEXT_FIELDS + OPTIONAL_TEXT + ("kind",)
    }
    fields["members"] = F.try_variant_get("_v_members", "$", "array<string>")
    fields["enabled"] = F.when(F.col("_t_enabled").isNull(), True).otherwise(F.col("_b_enabled"))
    fields["checks"] = F.struct(
        *[F.when(F.col(f"_t_{c}").isNull(), False).otherwise(F.col(f"_b_{c}")).alias(c) for c in CHECKS]
    )
    return F.struct(*[fields[f].alias(f) for f in FIELDS])


def decode_records(df: DataFrame, fmt: str = "yaml", content: str = "content") -> DataFrame:
    """Decode ``content`` to ``rec``, ``present_fields``, ``type_errors`` and ``decode_error``.

    Only the YAML text itself is read in Python, in Arrow batches; typing, defaults and JSON stay
    in the JVM.  A row that cannot be decoded keeps its error and a null record.
    """
    keep = [c for c in df.columns if c != content]
    if fmt == "yaml":
        df = df.withColumn("_yaml", yaml_to_json(F.col(content)))
        text, problem = F.col("_yaml.json"), F.col("_yaml.error")
    elif fmt == "json":
        text, problem = F.col(content), F.lit(None).cast("string")
    else:
        raise ValueError(f"unknown format {fmt!r}")
    df = df.withColumn("_doc", _json_fields(text))
    fields = {f: F.col(f"_doc.{f}") for f in FIELDS}
    fields |= {c: F.try_variant_get("_doc.checks", f"$.{c}", "variant") for c in CHECKS}
    df = df.withColumns({f"_v_{f}": v for f, v in fields.items()})
    df = df.withColumns({f"_t_{f}": _json_type(f"_v_{f}") for f in fields})
    df = df.withColumns({f"_b_{f}": _as_bool(f) for f in ("enabled", *CHECKS)})
    broken = F.when(F.col("_doc").isNull(), "malformed text or not a mapping")
    df = df.withColumn("decode_error", F.coalesce(problem, broken))
    ok = F.col("decode_error").isNull()
    present = F.array_compact(
        F.array(*[F.when(F.col(f"_t_{f}").isNotNull(), F.lit(f)) for f in FIELDS])
    )
    decoded = F.struct(
        F.when(ok, _record()).alias("rec"),
        F.when(ok, present).alias("present_fields"),
        F.when(ok, _type_errors()).alias("type_errors"),
        "decode_error",
    )
    # As the output of a generator the record is computed once: a later filter on it is not
    # pushed below, where it would parse the text again.
    return df.withColumn("_decoded", decoded).select(*keep, F.inline(F.array("_decoded")))
