"""Queries on single records: sources, expressions and rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadastre.functions import rules, text
from cadastre.functions.rules import check_records, is_valid
from cadastre.operators.catalogue import path_order
from cadastre.plans import oracle as q
from cadastre.plans import views as v
from cadastre.plans.catalogue import (
    duplicate_problems,
    first_problem,
    problems,
    typed_records,
)
from cadastre.plans.registry import register
from cadastre.sources.manifests import decode_records, manifest_scan, manifest_stream
from cadastre.sources.commits import commit_records, committed
from cadastre.sources.register import new_records, refusal_by_rule, register_records
from cadastre.sources.scratch import scratch_folder
from cadastre.streaming.jobs import run_available

def as_text(c) -> Column:
    """An optional flag or number as text, empty when null."""
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


# --- sources -----------------------------------------------------------------------------------


SCANNED = """SELECT split_part(path, '/', 1) AS group_dir, split_part(path, '/', 2) AS project_dir,
  empty OR undecodable AS failed,
  CASE WHEN empty THEN 'a mapping is needed, found NoneType' WHEN undecodable THEN 'not UTF-8 text' END AS reason,
  CASE WHEN NOT failed THEN s_name END AS name, CASE WHEN NOT failed THEN slug END AS slug,
  CASE WHEN NOT failed THEN "group" END AS "group", CASE WHEN NOT failed THEN n_name END AS description
FROM manifests"""


def _scanned(found):
    return found.select(
        F.col("path_parts")[0].alias("group_dir"),
        F.col("path_parts")[1].alias("project_dir"),
        F.col("decode_error").isNotNull().alias("failed"),
        F.col("decode_error").alias("reason"),
        "rec.name",
        "rec.slug",
        "rec.group",
        "rec.description",
    )


@register("s1_manifest_scan", q.with_tables(q.TREE) + SCANNED)
def s1_manifest_scan(spark, sf_dir):
    """Every supplier's project is written as files of a tree, whose manifests are then scanned."""
    folder = scratch_folder(spark)
    v.supplier_tree(spark, sf_dir, folder)
    return _scanned(decode_records(manifest_scan(spark, folder), "yaml"))


@register("stream_scan", q.with_tables(q.TREE) + SCANNED)
def stream_scan(spark, sf_dir):
    """The same tree as a stream: files without bytes and files that are not text are rows too."""
    folder = scratch_folder(spark)
    v.supplier_tree(spark, sf_dir, folder)
    found = decode_records(manifest_stream(spark, folder), "yaml")
    return _scanned(run_available(found, scratch_folder(spark)))


def _decoded(rows):
    return rows.select(
        v.KEY,
        F.col("decode_error").isNotNull().alias("failed"),
        F.array_join("present_fields", " ").alias("present"),
        "rec.name",
        "rec.slug",
        F.array_join("rec.members", "|").alias("members"),
        "rec.kind",
        "rec.entry",
        as_text("rec.enabled").alias("enabled"),
        as_text("rec.checks.pytest").alias("pytest"),
        F.array_join(
            F.transform("type_errors", lambda e: F.concat_ws(" ", e["field"], e["code"])), "; "
        ).alias("wrong_types"),
    )


@register(
    "s2_decode_json",
    q.with_tables(q.CATALOG)
    + f"""SELECT o_orderkey, {q.UNREADABLE} AS failed,
  CASE WHEN NOT failed THEN concat_ws(' ', CASE WHEN o_orderkey % 19 <> 0 THEN 'name' END, 'slug',
    'description', 'group', 'members', 'kind', 'mount_path', 'entry',
    CASE WHEN static_dir IS NOT NULL THEN 'static_dir' END,
    CASE WHEN o_orderkey % 47 = 0 OR o_orderkey % 53 = 0 OR o_orderstatus <> 'O' THEN 'enabled' END,
    CASE WHEN o_orderkey % 59 = 0 OR o_orderstatus = 'F' THEN 'checks' END) END AS present,
  CASE WHEN NOT failed AND o_orderkey % 19 <> 0 THEN name END AS name,
  CASE WHEN NOT failed AND o_orderkey % 23 <> 0 THEN slug END AS slug,
  CASE WHEN failed THEN NULL WHEN o_orderkey % 31 = 0 THEN '' WHEN o_orderkey % 37 = 0 THEN name || '|7'
       WHEN o_orderkey % 41 = 0 THEN NULL ELSE name END AS members,
  CASE WHEN failed THEN NULL WHEN o_orderkey % 43 = 0 THEN 'other' ELSE kind END AS kind,
  CASE WHEN NOT failed THEN entry END AS entry,
  CASE WHEN failed OR o_orderkey % 47 = 0 OR o_orderkey % 53 = 0 THEN ''
       WHEN o_orderstatus <> 'P' THEN 'true' ELSE 'false' END AS enabled,
  CASE WHEN failed THEN '' WHEN o_orderkey % 59 <> 0 AND o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS pytest,
  CASE WHEN NOT failed THEN concat_ws('; ', CASE WHEN o_orderkey % 23 = 0 THEN 'slug string_type' END,
    CASE WHEN o_orderkey % 29 = 0 THEN 'description string_type' END,
    CASE WHEN o_orderkey % 31 = 0 THEN NULL
         WHEN o_orderkey % 37 = 0 THEN 'members.1 string_type; members.2 string_type'
         WHEN o_orderkey % 41 = 0 THEN 'members list_type' END,
    CASE WHEN o_orderkey % 47 = 0 THEN 'enabled bool_type'
         WHEN o_orderkey % 53 = 0 THEN 'enabled bool_parsing' END,
    CASE WHEN o_orderkey % 59 = 0 THEN 'checks model_type' END) END AS wrong_types
FROM catalog""",
)
def s2_decode_json(spark, sf_dir):
    return _decoded(decode_records(v.json_manifests(spark, sf_dir), "json"))


@register(
    "s2_decode_yaml",
    q.with_tables(q.CATALOG)
    + f"""SELECT o_orderkey, {q.UNREADABLE} AS failed,
  CASE WHEN NOT failed THEN concat_ws(' ', 'name', 'slug', 'description', 'group', 'members', 'kind',
    'mount_path', 'entry', CASE WHEN static_dir IS NOT NULL THEN 'static_dir' END,
    CASE WHEN o_orderstatus <> 'O' THEN 'enabled' END,
    CASE WHEN o_orderstatus = 'F' THEN 'checks' END) END AS present,
  CASE WHEN NOT failed THEN name END AS name,
  CASE WHEN NOT failed AND o_orderkey % 23 <> 0 THEN slug END AS slug,
  CASE WHEN NOT failed THEN name END AS members,
  CASE WHEN NOT failed THEN kind END AS kind,
  CASE WHEN NOT failed THEN entry END AS entry,
  CASE WHEN failed THEN '' WHEN o_orderstatus <> 'P' THEN 'true' ELSE 'false' END AS enabled,
  CASE WHEN failed THEN '' WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS pytest,
  CASE WHEN NOT failed THEN concat_ws('; ', CASE WHEN o_orderkey % 23 = 0 THEN 'slug string_type' END,
    CASE WHEN o_orderkey % 29 = 0 THEN 'description string_type' END) END AS wrong_types
FROM catalog""",
)
def s2_decode_yaml(spark, sf_dir):
    return _decoded(decode_records(v.yaml_manifests(spark, sf_dir), "yaml"))


@register(
    "s3_register_records",
    q.with_tables(q.CATALOG)
    + """, requests AS (
  SELECT o_orderkey, "group", slug,
         CASE o_orderstatus WHEN 'F' THEN 'frontend' WHEN 'O' THEN 'backend' ELSE 'pending' END AS kind
  FROM catalog),
firsts AS (SELECT slug, min(o_orderkey) AS first_key FROM requests WHERE kind <> 'pending' GROUP BY slug)
SELECT o_orderkey, '/' || "group" || '/' || r.slug AS mount_path,
  CASE WHEN kind = 'backend' THEN 'apps.' || "group" || '.' || replace(r.slug, '-', '_') || '.main:app' END AS entry,
  CASE WHEN kind = 'frontend' THEN 'dist' END AS static_dir,
  CASE WHEN kind = 'pending' THEN 'invalid kind'
       WHEN o_orderkey <> first_key OR c_acctbal < 0 THEN 'exists' END AS refusal
FROM requests r JOIN customer ON r.slug = 'c-' || c_custkey LEFT JOIN firsts f ON r.slug = f.slug""",
)
def s3_register_records(spark, sf_dir):
    """Every order asks to register its customer; customers in debt are registered already."""
    status = F.col("o_orderstatus")
    kind = F.when(status == "F", "frontend").when(status == "O", "backend").otherwise("pending")
    requests = new_records(v.catalog(spark, sf_dir).withColumn("kind", kind))
    existing = v.table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(
        F.concat(
            F.lower("c_mktsegment"), F.lit("/c_"), F.col("c_custkey").cast("string")
        ).alias("directory")
    )
    columns = [v.KEY, "group", "slug", "kind", "directory", "mount_path", "entry", "static_dir"]
    decided = register_records(
        requests.select(*columns), existing, ["directory"], [v.KEY], refusal_by_rule()
    )
    return decided.select(v.KEY, "mount_path", "entry", "static_dir", "refusal")


@register(
    "s3_commit_records",
    q.with_tables(q.CATALOG)
    + """, requests AS (SELECT o_orderkey, lower(c_mktsegment) || '/c_' || o_custkey AS directory, o_orderstatus
  FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT directory, min_by(o_orderkey, (o_orderstatus <> 'F', o_orderkey)) AS o_orderkey
FROM requests WHERE o_orderstatus <> 'P' GROUP BY directory""",
)
def s3_commit_records(spark, sf_dir):
    """Two writers, finished orders first, then all that are not pending: each directory is added once."""
    status = F.col("o_orderstatus")
    kind = F.when(status == "P", "pending").otherwise("backend")
    rows = new_records(v.catalog(spark, sf_dir).withColumn("kind", kind))
    rows = rows.select(v.KEY, "group", "slug", "kind", "directory", "o_orderstatus")
    folder = scratch_folder(spark)
    for mine in (rows.filter(status == "F"), rows):
        commit_records(mine, folder, ["directory"], [v.KEY], refusal_by_rule())
    return committed(spark, folder, rows.schema).select("directory", v.KEY)


# --- expressions -------------------------------------------------------------------------------


@register(
    "e1_slug_to_module",
    "SELECT c_custkey, replace(replace(lower(c_name), '#', '-'), '-', '_') AS module FROM customer",
)
def e1_slug_to_module(spark, sf_dir):
    slug = F.translate(F.lower("c_name"), "#", "-")
    return v.table(spark, sf_dir, "customer").select(
        "c_custkey", text.slug_to_module(slug).alias("module")
    )


@register(
    "e2_canonical_path",
    q.with_tables(q.CATALOG)
    + """SELECT o_orderkey, '/' || "group" || '/' || slug AS path,
  '/' || "group" || '/' || static_dir AS path_or_null FROM catalog""",
)
def e2_canonical_path(spark, sf_dir):
    return v.catalog(spark, sf_dir).select(
        v.KEY,
        text.canonical_path("group", "slug").alias("path"),
        text.canonical_path("group", "static_dir").alias("path_or_null"),
    )


@register(
    "e3_entry_split",
    q.with_tables(q.CATALOG)
    + """SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0 THEN split_part(entry, ':', 1) END AS module,
  CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0 THEN split_part(entry, ':', 2) END AS attr
FROM catalog""",
)
def e3_entry_split(spark, sf_dir):
    entry = (
        F.when(F.col(v.KEY) % 7 == 0, F.replace("entry", F.lit(":"), F.lit(".")))
        .when(F.col(v.KEY) % 5 == 0, F.concat("entry", F.lit(":x")))
        .otherwise(F.col("entry"))
    )
    return v.catalog(spark, sf_dir).select(
        v.KEY, text.entry_module(entry).alias("module"), text.entry_attr(entry).alias("attr")
    )


@register(
    "e4_defaults",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' ELSE '' END AS enabled FROM orders""",
)
def e4_defaults(spark, sf_dir):
    """F: field absent; O: present and false; P: present and null."""
    status = F.col("o_orderstatus")
    present = F.when(status == "F", F.array(F.lit("name"))).otherwise(
        F.array(F.lit("name"), F.lit("enabled"))
    )
    value = F.when(status == "O", F.lit(False))
    enabled = text.default_if_absent(value, present, "enabled", True).alias("enabled")
    return v.table(spark, sf_dir, "orders").select(v.KEY, enabled).withColumn(
        "enabled", as_text("enabled")
    )


@register(
    "e5_kind_defaults",
    q.with_tables(q.CATALOG)
    + """SELECT o_orderkey,
  CASE WHEN kind <> 'frontend' THEN 'apps.' || "group" || '.' || replace(slug, '-', '_') || '.main:app' END AS entry,
  CASE WHEN kind <> 'backend' THEN 'dist' END AS static_dir FROM catalog""",
)
def e5_kind_defaults(spark, sf_dir):
    return v.catalog(spark, sf_dir).select(
        v.KEY,
        text.default_entry("kind", "group", "slug").alias("entry"),
        text.default_static_dir("kind").alias("static_dir"),
    )


@register(
    "e6_zero_pad",
    """SELECT p_partkey, CASE WHEN length(p_size::VARCHAR) >= 2 THEN p_size::VARCHAR ELSE lpad(p_size::VARCHAR, 2, '0') END AS size2,
  CASE WHEN length(p_partkey::VARCHAR) >= 2 THEN p_partkey::VARCHAR ELSE lpad(p_partkey::VARCHAR, 2, '0') END AS key2
FROM part""",
)
def e6_zero_pad(spark, sf_dir):
    return v.table(spark, sf_dir, "part").select(
        "p_partkey",
        text.zero_pad("p_size").alias("size2"),
        text.zero_pad("p_partkey").alias("key2"),
    )


@register(
    "e7_strip_suffix",
    f"""SELECT doc_id, trim(regexp_replace(text, ',{q.NOT_LINE_END}*', ''), {q.SPACES}) AS head,
  trim(regexp_replace(source || ' · ' || text, '·{q.NOT_LINE_END}*', ''), {q.SPACES}) AS kicker
FROM documents""",
)
def e7_strip_suffix(spark, sf_dir):
    return v.documents(spark, sf_dir).select(
        "doc_id",
        text.strip_suffix("text", ",").alias("head"),
        text.strip_suffix(F.concat_ws(" · ", "source", "text")).alias("kicker"),
    )


@register(
    "e8_label_fallback",
    f"""WITH parts AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
  regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS heading FROM pages)
SELECT page_id, title AS from_explicit, trim(title, {q.SPACES}) AS from_existing,
  page_id::VARCHAR AS from_number,
  coalesce(nullif(substr(trim(heading, {q.SPACES}), 1, 40), ''), 'Slide') AS from_heading,
  'Slide' AS from_nothing FROM parts""",
)
def e8_label_fallback(spark, sf_dir):
    pages = v.table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.regexp_extract("html", "<h1>([^<]*)</h1>", 1).alias("heading"),
    )
    number, none = F.col("page_id").cast("string"), F.lit(None).cast("string")
    return pages.select(
        "page_id",
        text.label_fallback("title", number, "heading").alias("from_explicit"),
        text.label_fallback(F.lit(""), F.concat_ws(" ", number, "title"), "heading").alias(
            "from_existing"
        ),
        text.label_fallback(none, number, "heading").alias("from_number"),
        text.label_fallback(none, F.lit(""), "heading").alias("from_heading"),
        text.label_fallback(none, none, F.lit(" ")).alias("from_nothing"),
    )


@register(
    "e9_clamp",
    """SELECT l_orderkey, l_linenumber, l_partkey,
  greatest(0, least(l_quantity::INTEGER - 1, l_linenumber * 5 - 8)) AS index FROM lineitem""",
)
def e9_clamp(spark, sf_dir):
    index = text.clamp(F.col("l_linenumber") * 5 - 8, F.col("l_quantity").cast("int"))
    return v.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", index.alias("index")
    )


@register(
    "e10_bounded_index",
    """WITH numbered AS (SELECT page_id, regexp_extract(url, '/([0-9]+)', 1)::BIGINT AS n FROM pages)
SELECT page_id, CASE WHEN n BETWEEN 1 AND 500 THEN n - 1 ELSE 0 END AS index, 0::BIGINT AS from_anchor,
  CASE WHEN n BETWEEN 1 AND page_id THEN n - 1 ELSE -1 END AS index_in_list FROM numbered""",
)
def e10_bounded_index(spark, sf_dir):
    fragment = F.concat(F.lit("#"), F.regexp_extract("url", "/([0-9]+)", 1))
    anchor = F.regexp_extract("url", "#.*", 0)
    return v.table(spark, sf_dir, "pages").select(
        "page_id",
        text.bounded_index(fragment, 500).alias("index"),
        text.bounded_index(anchor, 500).alias("from_anchor"),
        text.bounded_index(fragment, "page_id", -1).alias("index_in_list"),
    )


@register(
    "e11_json_array",
    """SELECT doc_id, CASE WHEN lang = 'en' THEN len(string_split(text, chr(10))) ELSE 0 END::INTEGER AS notes,
  CASE WHEN lang = 'en' THEN string_split(text, chr(10))[-1] ELSE '' END AS last_note FROM documents""",
)
def e11_json_array(spark, sf_dir):
    """English: a JSON array of lines; German: an object; Spanish: text after the array; other
    languages: no JSON."""
    lines, lang = F.to_json(F.split("text", "\n")), F.col("lang")
    json = (
        F.when(lang == "en", lines)
        .when(lang == "de", F.concat(F.lit('{"lines":'), lines, F.lit("}")))
        .when(lang == "es", F.concat(lines, F.lit("]")))
        .otherwise(F.col("text"))
    )
    documents = v.documents(spark, sf_dir).select(
        "doc_id", text.json_array(json).alias("items")
    )
    return documents.select(
        "doc_id",
        F.size("items").alias("notes"),
        F.coalesce(F.try_element_at("items", F.lit(-1)), F.lit("")).alias("last_note"),
    )


@register(
    "e11_json_not_array",
    "SELECT event_id, 0 AS notes FROM events",
)
def e11_json_not_array(spark, sf_dir):
    return v.table(spark, sf_dir, "events").select(
        "event_id", F.size(text.json_array("props")).alias("notes")
    )


@register(
    "e12_array_join",
    """SELECT page_id, array_to_string(regexp_extract_all(html, '<li><a href="/([^"]*)"', 1), ', ') AS links
FROM pages""",
)
def e12_array_join(spark, sf_dir):
    return v.page_links(spark, sf_dir).select("page_id", text.join_members("links").alias("links"))


@register(
    "e13_direction",
    """SELECT event_id, CASE WHEN value < regexp_extract(props, '[0-9]+')::INTEGER THEN -1 ELSE 1 END AS direction
FROM events""",
)
def e13_direction(spark, sf_dir):
    previous = F.get_json_object("props", "$.k").cast("int")
    return v.table(spark, sf_dir, "events").select(
        "event_id", text.direction("value", previous).alias("direction")
    )


@register(
    "e14_link_or_badge",
    q.with_tables(q.CATALOG)
    + """, s AS (SELECT *, CASE WHEN NOT enabled THEN 'offline' WHEN entry IS NULL THEN 'broken' ELSE 'online' END AS status FROM catalog)
SELECT o_orderkey, CASE WHEN status = 'online' THEN mount_path END AS href,
  CASE WHEN status <> 'online' THEN status END AS badge FROM s""",
)
def e14_link_or_badge(spark, sf_dir):
    status = (
        F.when(~F.col("enabled"), "offline")
        .when(F.col("entry").isNull(), "broken")
        .otherwise("online")
    )
    return v.catalog(spark, sf_dir).select(
        v.KEY, text.link(status, "mount_path").alias("href"), text.badge(status).alias("badge")
    )


@register(
    "e15_diagnostic_lines",
    q.with_tables(q.LINES)
    + """SELECT doc_id, position::INTEGER AS position,
  CASE WHEN position > 0 THEN source END AS file, CASE WHEN position > 0 THEN position::VARCHAR ELSE '' END AS line,
  CASE WHEN position > 0 THEN length(text)::VARCHAR ELSE '' END AS col,
  CASE WHEN position > 0 THEN text END AS message FROM lines""",
)
def e15_diagnostic_lines(spark, sf_dir):
    """The first line of a document is left as it is, the others get a place in front."""
    place = F.format_string("%s:%d:%d: ", "source", "position", F.length("text"))
    raw = F.when(F.col("position") > 0, F.concat(place, "text")).otherwise(F.col("text"))
    return (
        v.document_lines(spark, sf_dir)
        .withColumn("parsed", text.diagnostic(raw))
        .select(
            "doc_id",
            "position",
            "parsed.file",
            as_text("parsed.line").alias("line"),
            as_text("parsed.col").alias("col"),
            "parsed.message",
        )
    )


# --- rules -------------------------------------------------------------------------------------


def _json_records(spark, sf_dir):
    return typed_records(decode_records(v.json_manifests(spark, sf_dir), "json"))


def _violations(rows):
    # The outer form: for the plain one Spark would work out the violations once more, in a filter.
    each = rows.select(v.KEY, F.explode_outer("violations").alias("_v")).filter("_v IS NOT NULL")
    return each.select(v.KEY, "_v.stage", "_v.field", "_v.code")


READABLE = f"FROM orders WHERE NOT {q.UNREADABLE} AND "


@register(
    "v1_required_fields",
    f"""SELECT o_orderkey, 1 AS stage, 'name' AS field, 'missing' AS code {READABLE} o_orderkey % 19 = 0""",
)
def v1_required_fields(spark, sf_dir):
    return _violations(_json_records(spark, sf_dir)).filter("code = 'missing'")


@register(
    "v2_type_strictness",
    f"""SELECT o_orderkey, 1 AS stage, 'slug' AS field, 'string_type' AS code {READABLE} o_orderkey % 23 = 0
UNION ALL SELECT o_orderkey, 1, 'description', 'string_type' {READABLE} o_orderkey % 29 = 0
UNION ALL SELECT o_orderkey, 1, unnest(['members.1', 'members.2']), 'string_type' {READABLE} o_orderkey % 37 = 0 AND o_orderkey % 31 <> 0
UNION ALL SELECT o_orderkey, 1, 'members', 'list_type' {READABLE} o_orderkey % 41 = 0 AND o_orderkey % 31 <> 0 AND o_orderkey % 37 <> 0
UNION ALL SELECT o_orderkey, 1, 'enabled', 'bool_type' {READABLE} o_orderkey % 47 = 0
UNION ALL SELECT o_orderkey, 1, 'enabled', 'bool_parsing' {READABLE} o_orderkey % 53 = 0 AND o_orderkey % 47 <> 0
UNION ALL SELECT o_orderkey, 1, 'checks', 'model_type' {READABLE} o_orderkey % 59 = 0""",
)
def v2_type_strictness(spark, sf_dir):
    return _violations(_json_records(spark, sf_dir)).filter(
        F.col("code").endswith("_type") | (F.col("code") == "bool_parsing")
    )


@register(
    "v3_slug_format",
    """SELECT o_orderkey, 1 AS stage, 'group' AS field, 'string_pattern_mismatch' AS code FROM orders
WHERE o_orderkey % 4 = 0 OR o_orderstatus = 'P'""",
)
def v3_slug_format(spark, sf_dir):
    """Every fourth order's group is its priority, which begins with a digit; some groups hold a blank."""
    orders = v.table(spark, sf_dir, "orders")
    group = F.when(F.col(v.KEY) % 4 == 0, F.col("o_orderpriority"))
    group = group.when(F.col("o_orderstatus") == "P", F.lit("two words")).otherwise(F.col("c_mktsegment"))
    found = _violations(check_records(v.catalog(spark, sf_dir, group, orders)))
    return found.filter("code = 'string_pattern_mismatch'")


@register(
    "v3_slug_forms",
    """SELECT c_custkey, c_custkey % 2 <> 0 AS name, c_acctbal >= 0 AS segment, c_nationkey < 10 AS nation,
  c_custkey % 3 = 0 AS ending FROM customer""",
)
def v3_slug_forms(spark, sf_dir):
    """Some names keep their ``#``, some segments their capitals; some slugs begin with a digit or end in a line end."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    name, slug = F.lower("c_name"), F.concat(F.lit("c-"), key.cast("string"))
    forms = {
        "name": F.when(key % 2 == 0, name).otherwise(F.translate(name, "#", "-")),
        "segment": F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")).otherwise(F.lower("c_mktsegment")),
        "nation": F.when(F.col("c_nationkey") < 10, F.concat(F.lit("n"), nation)).otherwise(nation),
        "ending": F.when(key % 3 == 0, slug).otherwise(F.concat(slug, F.lit("\n"))),
    }
    return v.table(spark, sf_dir, "customer").select("c_custkey", *[rules.is_slug(c).alias(n) for n, c in forms.items()])


@register(
    "v4_enum_membership",
    f"""SELECT o_orderkey, 1 AS stage, 'kind' AS field, 'enum' AS code {READABLE} o_orderkey % 43 = 0""",
)
def v4_enum_membership(spark, sf_dir):
    return _violations(_json_records(spark, sf_dir)).filter("code = 'enum'")


@register(
    "v5_list_not_empty",
    f"""SELECT o_orderkey, 1 AS stage, 'members' AS field, 'too_short' AS code {READABLE} o_orderkey % 31 = 0""",
)
def v5_list_not_empty(spark, sf_dir):
    return _violations(_json_records(spark, sf_dir)).filter("code = 'too_short'")


@register(
    "v6_kind_requirements",
    q.with_tables(q.CATALOG, q.CHECKED)
    + """SELECT o_orderkey, 2 AS stage, split_part(problem, ' ', 2) AS field, 'required' AS code
FROM checked WHERE starts_with(problem, '2')""",
)
def v6_kind_requirements(spark, sf_dir):
    return _violations(check_records(v.catalog(spark, sf_dir))).filter("stage = 2")


@register(
    "v7_derived_path",
    q.with_tables(q.CATALOG, q.CHECKED)
    + """SELECT o_orderkey, 3 AS stage, 'mount_path' AS field, 'not_canonical' AS code
FROM checked WHERE starts_with(problem, '3')""",
)
def v7_derived_path(spark, sf_dir):
    return _violations(check_records(v.catalog(spark, sf_dir))).filter("stage = 3")


@register(
    "v8_precedence",
    q.with_tables(q.CATALOG)
    + f"""SELECT o_orderkey, coalesce(
  CASE WHEN {q.UNREADABLE} THEN '0  decode' END,
  nullif(concat_ws('; ', CASE WHEN o_orderkey % 19 = 0 THEN '1 name missing' END,
    CASE WHEN o_orderkey % 23 = 0 THEN '1 slug string_type' END,
    CASE WHEN o_orderkey % 29 = 0 THEN '1 description string_type' END,
    CASE WHEN o_orderkey % 31 = 0 THEN '1 members too_short'
         WHEN o_orderkey % 37 = 0 THEN '1 members.1 string_type; 1 members.2 string_type'
         WHEN o_orderkey % 41 = 0 THEN '1 members list_type' END,
    CASE WHEN o_orderkey % 43 = 0 THEN '1 kind enum' END,
    CASE WHEN o_orderkey % 47 = 0 THEN '1 enabled bool_type'
         WHEN o_orderkey % 53 = 0 THEN '1 enabled bool_parsing' END,
    CASE WHEN o_orderkey % 59 = 0 THEN '1 checks model_type' END), ''),
  CASE WHEN kind <> 'frontend' AND entry IS NULL THEN '2 entry required'
       WHEN kind <> 'backend' AND static_dir IS NULL THEN '2 static_dir required'
       WHEN o_orderkey % 17 = 0 THEN '3 mount_path not_canonical' ELSE '' END) AS problems
FROM catalog""",
)
def v8_precedence(spark, sf_dir):
    parts = F.transform(
        "violations",
        lambda x: F.concat_ws(" ", x["stage"].cast("string"), x["field"], x["code"]),
    )
    return _json_records(spark, sf_dir).select(v.KEY, F.array_join(parts, "; ").alias("problems"))


@register(
    "v9_first_invalid",
    q.with_tables(q.CATALOG, q.CHECKED)
    + """SELECT 0 AS severity, o_orderkey AS place,
  'Invalid manifest apps/' || o_orderkey || ': ' || substr(problem, 3) AS message
FROM checked WHERE problem IS NOT NULL ORDER BY o_orderkey LIMIT 1""",
)
def v9_first_invalid(spark, sf_dir):
    records = check_records(v.catalog(spark, sf_dir))
    return first_problem(problems(records, v.KEY, v.KEY, "apps"))


@register(
    "v9_first_duplicate",
    q.with_tables(q.CATALOG, q.CHECKED)
    + """, valid AS (SELECT *, first_value("group" || '/' || slug) OVER w AS owner, row_number() OVER w AS nth
  FROM checked WHERE problem IS NULL WINDOW w AS (PARTITION BY mount_path ORDER BY o_orderkey))
SELECT 1 AS severity, o_orderkey AS place,
  'duplicate mount_path ''' || mount_path || ''' in ' || "group" || '/' || slug || ' and ' || owner AS message
FROM valid WHERE nth > 1 ORDER BY o_orderkey LIMIT 1""",
)
def v9_first_duplicate(spark, sf_dir):
    records = check_records(v.catalog(spark, sf_dir)).filter(is_valid())
    return first_problem(duplicate_problems(records, v.KEY))


@register(
    "v10_enabled_filter",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'",
)
def v10_enabled_filter(spark, sf_dir):
    orders = v.table(spark, sf_dir, "orders").withColumn("enabled", F.col("o_orderstatus") != "P")
    return rules.enabled_only(orders).select(v.KEY, "o_orderstatus")


@register(
    "v11_facet_filter",
    """SELECT doc_id, lang NOT IN ('en', 'fr') AS dim, false AS dim_by_none, false AS dim_by_all FROM documents""",
)
def v11_facet_filter(spark, sf_dir):
    every = ["de", "en", "es", "fr"]
    return v.table(spark, sf_dir, "documents").select(
        "doc_id",
        rules.dim_unless("lang", ["en", "fr"], every).alias("dim"),
        rules.dim_unless("lang", [], every).alias("dim_by_none"),
        rules.dim_unless("lang", every, every).alias("dim_by_all"),
    )


@register(
    "v12_exclude_types",
    "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('error', 'signup')",
)
def v12_exclude_types(spark, sf_dir):
    events = v.table(spark, sf_dir, "events")
    return rules.exclude_types(events, "event_type", ["error", "signup"]).select(
        "event_id", "event_type"
    )


@register(
    "o1_path_order",
    q.with_tables(q.PAGE_PATHS)
    + """SELECT page_id, array_to_string(string_split(path, '/'), chr(1)) AS sort_text,
  row_number() OVER (ORDER BY string_split(path, '/'), page_id) - 1 AS place FROM paths""",
)
def o1_path_order(spark, sf_dir):
    """The place of each path in the order of components; ``sort_text`` sorts the same way as plain text."""
    parts = text.path_parts("path")
    return path_order(v.page_paths(spark, sf_dir), parts, "page_id", place="place").select(
        "page_id", F.array_join(parts, "\x01").alias("sort_text"), "place"
    )
