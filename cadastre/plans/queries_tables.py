"""Queries on whole tables: keys, targets, lookups, routes, layers, lists and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastre.functions import text
from cadastre.functions.rules import check_records, exclude_types, is_valid
from cadastre.operators import catalogue as cat
from cadastre.operators import changes, lookup, overlay, sequence
from cadastre.operators.routes import resolve_routes
from cadastre.plans import oracle as q
from cadastre.plans import views as v
from cadastre.plans.catalogue import (
    build_catalogue,
    catalogue_index,
    catalogue_of_tree,
    load_records,
    routes_of,
)
from cadastre.plans.page import page_cards
from cadastre.plans.queries_records import as_text
from cadastre.plans.registry import ORACLE, register
from cadastre.sources.listing import list_tree, module_listing, static_listing
from cadastre.sources.scratch import scratch_folder, settle
from cadastre.streaming import jobs

# --- catalogue ---------------------------------------------------------------------------------

VALID = 'valid AS (SELECT * FROM checked WHERE problem IS NULL)'
OWNERS = """owners AS (SELECT * FROM valid
  WHERE o_orderkey IN (SELECT min(o_orderkey) FROM valid GROUP BY mount_path))"""
STATUS = """status_rows AS (SELECT *, CASE WHEN NOT enabled THEN 'offline'
  WHEN NOT coalesce(module_ok, true) OR NOT coalesce(static_ok, true) THEN 'broken' ELSE 'online' END AS status
  FROM targeted)"""
BUILT = q.with_tables(q.CATALOG, q.CHECKED, VALID, OWNERS, q.TARGETS.format(rows="owners"), STATUS)


def _built(spark, sf_dir):
    return build_catalogue(
        check_records(v.catalog(spark, sf_dir)),
        v.module_listing(spark, sf_dir),
        v.static_listing(spark, sf_dir),
        v.KEY,
    )


@register(
    "catalogue_index",
    BUILT
    + """SELECT "group", o_orderkey, min(o_orderkey) OVER (PARTITION BY "group") AS group_key, name, description,
  name AS members, mount_path, status FROM status_rows""",
)
def catalogue_index_query(spark, sf_dir):
    """The whole flow: check, keep first owners, find broken targets, group the cards."""
    cards = catalogue_index(_built(spark, sf_dir), v.KEY)
    return cat.index_order(cards, v.KEY).withColumn("members", text.join_members("members"))


@register(
    "full_flow",
    q.with_tables(q.TREE)
    + """, good AS (SELECT m.*, module_ok, static_ok FROM manifests m JOIN targets t ON m.s_suppkey = t.s_suppkey
  WHERE NOT m.empty AND NOT m.undecodable AND m.s_suppkey % 11 <> 0 AND NOT ends_with(path, '_copy/project.yaml'))
SELECT "group", path, min(path) OVER (PARTITION BY "group") AS group_path, s_name AS name,
  '/' || "group" || '/' || slug AS mount_path,
  CASE WHEN (kind = 'frontend' OR module_ok) AND (kind = 'backend' OR static_ok) THEN 'online' ELSE 'broken' END AS status
FROM good""",
)
def full_flow(spark, sf_dir):
    """From files to the index: manifests, modules and static folders all come from the tree."""
    root = scratch_folder(spark)
    v.supplier_tree(spark, sf_dir, root)
    index = catalogue_index(catalogue_of_tree(spark, root))
    path = lambda c, name: F.array_join(c, "/").alias(name)
    return cat.index_order(index, "path_parts").select(
        "group", path("path_parts", "path"), path("group_key", "group_path"), "name", "mount_path", "status"
    )


@register(
    "a1_grouped_index",
    q.with_tables(q.CATALOG)
    + """SELECT "group", o_orderkey, min(o_orderkey) OVER (PARTITION BY "group") AS group_key, name, mount_path FROM catalog""",
)
def a1_grouped_index(spark, sf_dir):
    rows = cat.grouped_index(v.catalog(spark, sf_dir), v.KEY, card=("name", "mount_path"))
    return cat.index_order(rows, v.KEY)


@register(
    "o2_group_order",
    """SELECT *, row_number() OVER (ORDER BY group_key, c_custkey) - 1 AS place FROM (
  SELECT n_name, r_name, c_custkey, min(c_custkey) OVER (PARTITION BY n_name) AS group_key
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
)
def o2_group_order(spark, sf_dir):
    """Nations in the order their first customer appears."""
    rows = cat.grouped_index(_placed(spark, sf_dir), "c_custkey", "n_name", ("r_name",))
    return cat.index_order(rows, "c_custkey", "place")


@register(
    "a2_duplicate_keys",
    q.with_tables(q.CATALOG)
    + """, w AS (SELECT o_orderkey, mount_path, first_value(o_orderkey) OVER k AS owner_key,
  first_value(description) OVER k AS owner_description, row_number() OVER k AS nth
  FROM catalog WINDOW k AS (PARTITION BY mount_path ORDER BY o_orderkey))
SELECT o_orderkey, mount_path, owner_key, owner_description FROM w WHERE nth > 1""",
)
def a2_duplicate_keys(spark, sf_dir):
    rows = v.catalog(spark, sf_dir).select(v.KEY, "mount_path", "description")
    return cat.duplicate_keys(rows, "mount_path", v.KEY, ["description"]).select(
        v.KEY,
        "mount_path",
        F.col(f"owner.{v.KEY}").alias("owner_key"),
        F.col("owner.description").alias("owner_description"),
    )


@register(
    "a2_key_owners",
    """SELECT min(o_orderkey) AS o_orderkey, o_custkey FROM orders GROUP BY o_custkey""",
)
def a2_key_owners(spark, sf_dir):
    orders = v.table(spark, sf_dir, "orders").select(v.KEY, "o_custkey")
    return cat.owners_only(orders, "o_custkey", v.KEY)


@register(
    "j1_ref_integrity",
    "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def j1_ref_integrity(spark, sf_dir):
    documents = v.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return cat.without_reference(documents, v.table(spark, sf_dir, "labels"), ["doc_id"])


@register(
    "j1_missing_targets",
    q.with_tables(q.CATALOG, q.TARGETS.format(rows="catalog"))
    + """SELECT o_orderkey, mount_path, coalesce(module_ok::VARCHAR, '') AS module_ok, coalesce(static_ok::VARCHAR, '') AS static_ok FROM targeted
WHERE enabled AND (NOT coalesce(module_ok, true) OR NOT coalesce(static_ok, true))""",
)
def j1_missing_targets(spark, sf_dir):
    return cat.broken_records(_targeted(spark, sf_dir)).select(
        v.KEY,
        "mount_path",
        as_text("module_ok").alias("module_ok"),
        as_text("static_ok").alias("static_ok"),
    )


@register(
    "j1_from_tree",
    q.with_tables(q.TREE)
    + """SELECT s_suppkey, CASE WHEN kind <> 'frontend' THEN CASE WHEN module_ok THEN 'true' ELSE 'false' END ELSE '' END AS module_ok,
  CASE WHEN kind <> 'backend' THEN CASE WHEN static_ok THEN 'true' ELSE 'false' END ELSE '' END AS static_ok
FROM targets WHERE NOT empty AND NOT undecodable""",
)
def j1_from_tree(spark, sf_dir):
    """Targets compared with what the syntax trees of the sources bind and with the folders there are."""
    root = scratch_folder(spark)
    v.supplier_tree(spark, sf_dir, root)
    records = load_records(spark, root).filter("decode_error IS NULL AND path_parts[1] NOT LIKE '%\\\\_copy'")
    listed = settle(list_tree(spark, root))
    found = cat.missing_targets(records, module_listing(spark, root, listed=listed), static_listing(spark, root, listed))
    return found.select(
        F.substring_index("slug", "-", -1).cast("long").alias("s_suppkey"),
        as_text("module_ok").alias("module_ok"),
        as_text("static_ok").alias("static_ok"),
    )


def _targeted(spark, sf_dir):
    return cat.missing_targets(
        v.catalog(spark, sf_dir), v.module_listing(spark, sf_dir), v.static_listing(spark, sf_dir)
    )


@register(
    "j2_status",
    q.with_tables(q.CATALOG, q.TARGETS.format(rows="catalog"))
    + """, broken AS (SELECT mount_path FROM targeted
  WHERE enabled AND (NOT coalesce(module_ok, true) OR NOT coalesce(static_ok, true)))
SELECT o_orderkey, CASE WHEN NOT enabled THEN 'offline'
  WHEN mount_path IN (SELECT mount_path FROM broken) THEN 'broken' ELSE 'online' END AS status FROM catalog""",
)
def j2_status(spark, sf_dir):
    rows = settle(_targeted(spark, sf_dir).select(v.KEY, "mount_path", "enabled", "module_ok", "static_ok"))
    return cat.with_status(rows, cat.broken_records(rows)).select(v.KEY, "status")


@register(
    "g1_endpoint_expand",
    q.with_tables(q.CATALOG)
    + """SELECT o_orderkey, 0 AS role_order, 'app' AS role,
  CASE WHEN kind = 'fullstack' THEN mount_path || '/api' ELSE mount_path END AS mount_at, entry AS target
FROM catalog WHERE kind <> 'frontend'
UNION ALL SELECT o_orderkey, 1, 'static', mount_path,
  "group" || '/' || replace(slug, '-', '_') || '/' || static_dir FROM catalog WHERE kind <> 'backend'""",
)
def g1_endpoint_expand(spark, sf_dir):
    return cat.expand_endpoints(v.catalog(spark, sf_dir)).select(
        v.KEY, "role_order", "role", "mount_at", "target"
    )


@register(
    "j5_catalogue_routes",
    BUILT
    + """, endpoints AS (
  SELECT mount_path || CASE WHEN kind = 'fullstack' THEN '/api' ELSE '' END AS mount_at, entry AS target,
    o_orderkey * 2 AS place FROM status_rows WHERE enabled AND kind <> 'frontend' AND module_ok
  UNION ALL SELECT mount_path, "group" || '/' || replace(slug, '-', '_') || '/' || static_dir, o_orderkey * 2 + 1
  FROM status_rows WHERE enabled AND kind <> 'backend' AND coalesce(module_ok, true) AND static_ok),
requests AS (SELECT o_orderkey, '/' || "group" || '/' || slug || CASE o_orderstatus WHEN 'P' THEN '/api/x'
  WHEN 'F' THEN '' ELSE '/index.html' END AS path FROM catalog),
best AS (SELECT o_orderkey, path, arg_min(mount_at, place) AS mount_at, arg_min(target, place) AS endpoint
  FROM (SELECT r.*, e.* FROM requests r JOIN endpoints e ON r.path = e.mount_at
        UNION ALL SELECT r.*, e.* FROM requests r JOIN endpoints e ON array_to_string(string_split(r.path, '/')[:3], '/') = e.mount_at AND r.path <> e.mount_at
        UNION ALL SELECT r.*, e.* FROM requests r JOIN endpoints e ON array_to_string(string_split(r.path, '/')[:4], '/') = e.mount_at AND r.path <> e.mount_at)
  GROUP BY ALL)
SELECT r.o_orderkey, r.path, b.mount_at, b.endpoint FROM requests r LEFT JOIN best b ON r.o_orderkey = b.o_orderkey""",
)
def j5_catalogue_routes(spark, sf_dir):
    """Requests to every order's record, resolved against the endpoints that are mounted."""
    rest = (
        F.when(F.col("o_orderstatus") == "P", "/api/x")
        .when(F.col("o_orderstatus") == "F", "")
        .otherwise("/index.html")
    )
    requests = v.catalog(spark, sf_dir).select(
        v.KEY, F.concat(text.canonical_path("group", "slug"), rest).alias("path")
    )
    return resolve_routes(requests, routes_of(_built(spark, sf_dir), v.KEY), "path").select(
        v.KEY, "path", "route.mount_at", "route.endpoint"
    )


ROUTES = """firsts AS (SELECT mount_at, min(reg_key) AS reg_key FROM (
    SELECT '/' || split_part(path, '/', 2) || '/' || split_part(path, '/', 3) AS mount_at, page_id * 2 AS reg_key FROM paths
    UNION ALL SELECT '/' || split_part(path, '/', 2), page_id * 2 + 1 FROM paths) GROUP BY 1),
matched AS (SELECT page_id, path, arg_min(mount_at, reg_key) AS mount_at, min(reg_key) AS reg_key
  FROM paths JOIN firsts ON path = mount_at OR starts_with(path, mount_at || '/') GROUP BY ALL)
SELECT page_id, path, 'page of ' || mount_at AS endpoint, reg_key FROM matched"""


@register("j5_route_resolve", q.with_tables(q.PAGE_PATHS, ROUTES).rstrip())
def j5_route_resolve(spark, sf_dir):
    requests, routes = v.page_paths(spark, sf_dir), v.page_routes(spark, sf_dir)
    return resolve_routes(requests, routes, "path").select(
        "page_id", "path", "route.endpoint", "route.reg_key"
    )


# --- lookups -----------------------------------------------------------------------------------

FIRST_WORDS = """words AS (SELECT word, min(doc_id) AS first_doc FROM (
  SELECT doc_id, unnest(regexp_split_to_array(text, '[ \\n]')) AS word FROM documents) WHERE word <> '' GROUP BY word),
links AS (SELECT page_id, unnest(l) AS word, generate_subscripts(l, 1) - 1 AS position
  FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="/([^"]*)"', 1) AS l FROM pages))"""


def _links(spark, sf_dir):
    return lookup.array_lookup(
        v.page_links(spark, sf_dir), "links", v.first_words(spark, sf_dir), "word", ["page_id"]
    )


@register(
    "j3_array_lookup",
    q.with_tables(FIRST_WORDS)
    + """SELECT page_id, position::INTEGER AS position, l.word, coalesce(first_doc, -1) AS first_doc,
  first_doc IS NULL AS is_missing FROM links l LEFT JOIN words w ON l.word = w.word""",
)
def j3_array_lookup(spark, sf_dir):
    found = _links(spark, sf_dir)
    return found.withColumn("first_doc", F.coalesce("first_doc", F.lit(-1)))


@register(
    "j4_dimension_lookup",
    """SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
)
def j4_dimension_lookup(spark, sf_dir):
    return _placed(spark, sf_dir).select("c_custkey", "n_name", "r_name")


def _placed(spark, sf_dir, customer=None):
    customer = v.table(spark, sf_dir, "customer") if customer is None else customer
    customer = customer.withColumnRenamed("c_nationkey", "n_nationkey")
    rows = lookup.dimension_lookup(customer, v.table(spark, sf_dir, "nation"), ["n_nationkey"])
    rows = rows.withColumnRenamed("n_regionkey", "r_regionkey")
    return lookup.dimension_lookup(rows, v.table(spark, sf_dir, "region"), ["r_regionkey"])


@register(
    "a3_ordered_concat",
    q.with_tables(FIRST_WORDS)
    + """SELECT page_id, string_agg('<' || CASE WHEN length(position::VARCHAR) < 2 THEN '0' ELSE '' END || position || ' '
  || l.word || ' ' || coalesce(first_doc::VARCHAR, '?') || '>', '' ORDER BY position) AS cards
FROM links l LEFT JOIN words w ON l.word = w.word GROUP BY page_id""",
)
def a3_ordered_concat(spark, sf_dir):
    card = F.concat(
        F.lit("<"),
        text.zero_pad("position"),
        F.lit(" "),
        F.col("word"),
        F.lit(" "),
        F.coalesce(F.col("first_doc").cast("string"), F.lit("?")),
        F.lit(">"),
    )
    return lookup.ordered_concat(_links(spark, sf_dir), ["page_id"], "position", card, "cards")


@register(
    "page_cards",
    q.with_tables(FIRST_WORDS)
    + """SELECT page_id, string_agg('[' || CASE WHEN length(position::VARCHAR) < 2 THEN '0' ELSE '' END || position || ' '
  || l.word || ' (' || source || ')]', '' ORDER BY position) AS cards
FROM links l JOIN words w ON l.word = w.word JOIN documents d ON d.doc_id = w.first_doc GROUP BY page_id""",
)
def page_cards_query(spark, sf_dir):
    """Navigation words of every page with the source of the first document that has them."""
    words = v.first_words(spark, sf_dir).withColumn("title", F.col("word"))
    sources = v.table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "first_doc")
    return page_cards(
        v.page_links(spark, sf_dir), "page_id", "links", words, "word", "title", sources,
        "first_doc", "source",
    )


@register(
    "j8_positional_join",
    """SELECT conv_id, turn, role, string_split(d.text, chr(10))[turn + 1] AS note
FROM conversations c LEFT JOIN documents d ON d.doc_id = c.conv_id""",
)
def j8_positional_join(spark, sf_dir):
    """The turns of a conversation with the lines of the document of the same number."""
    turns = v.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    notes = v.documents(spark, sf_dir).select(
        F.col("doc_id").alias("conv_id"), F.to_json(F.split("text", "\n")).alias("notes")
    )
    return lookup.positional_join(turns, notes, "conv_id", "turn", "notes")


# --- layers and changes ------------------------------------------------------------------------


@register(
    "s4_layered_overlay",
    """WITH layers AS (SELECT 'chat/' || conv_id || '/' || (turn // 2) AS path, 0 AS layer, text FROM conversations WHERE role = 'user'
  UNION ALL SELECT 'chat/' || conv_id || '/' || (turn // 2), 1, text FROM conversations WHERE role = 'assistant'
  UNION ALL SELECT 'chat/' || conv_id || '/' || (turn // 2), 3, text FROM conversations WHERE role = 'system')
SELECT path, max(layer)::INTEGER AS layer, arg_max(text, layer) AS text FROM layers GROUP BY path""",
)
def s4_layered_overlay(spark, sf_dir):
    """Question, answer over it, system text on top; the optional third layer is absent."""
    rows = v.table(spark, sf_dir, "conversations")
    path = F.concat_ws(
        "/", F.col("conv_id").cast("string"), F.expr("turn div 2").cast("string")
    )
    by_role = lambda role: rows.filter(F.col("role") == role).select(path.alias("path"), "text")
    return overlay.layered_overlay(
        [
            (by_role("user"), "chat", False),
            (by_role("assistant"), "/chat/", False),
            (None, "chat", True),
            (by_role("system"), "chat", False),
        ],
        "path",
    )


@register(
    "u2_union_override",
    """SELECT conv_id, role, max(turn) AS turn, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id, role""",
)
def u2_union_override(spark, sf_dir):
    return overlay.override(
        v.table(spark, sf_dir, "conversations"), ["conv_id", "role"], "turn"
    )


@register(
    "j6_affected_units",
    q.with_tables(q.PAGE_PATHS, q.CHANGED_UNITS, q.UNIT_MANIFESTS)
    + "SELECT unit, pytest, mypy FROM units JOIN manifests USING (unit)",
)
def j6_affected_units(spark, sf_dir):
    return changes.affected_units(v.changed_paths(spark, sf_dir), v.unit_manifests(spark, sf_dir))


@register(
    "j7_presence_report",
    q.with_tables(q.PAGE_PATHS, q.CHANGED_UNITS, q.UNIT_MANIFESTS)
    + """SELECT unit, CASE WHEN m.unit IS NULL THEN 'missing' ELSE 'present' END AS presence,
  CASE WHEN m.unit IS NULL THEN 'add a project.yaml' ELSE 'see job logs' END AS note
FROM units LEFT JOIN manifests m USING (unit)""",
)
def j7_presence_report(spark, sf_dir):
    return changes.presence_report(v.changed_paths(spark, sf_dir), v.unit_manifests(spark, sf_dir))


@register(
    "u1_distinct_sorted",
    q.with_tables(q.PAGE_PATHS)
    + """SELECT unit, row_number() OVER (ORDER BY unit) - 1 AS place
FROM (SELECT DISTINCT split_part(path, '/', 2) || '/' || split_part(path, '/', 3) AS unit FROM paths)""",
)
def u1_distinct_sorted(spark, sf_dir):
    parts = text.path_parts("path")
    unit = F.concat(F.try_element_at(parts, F.lit(2)), F.lit("/"), F.try_element_at(parts, F.lit(3)))
    return changes.distinct_sorted(v.page_paths(spark, sf_dir), unit, "unit", "place")


CHECKS = ["click", "view", "purchase", "signup"]


@register(
    "a5_status_matrix",
    "SELECT user_id, "
    + ", ".join(
        f"""CASE WHEN count(*) FILTER (event_type = '{c}') = 0 THEN 'skipped'
  WHEN bool_or(value < 50) FILTER (event_type = '{c}') THEN 'failed' ELSE 'passed' END AS {c}"""
        for c in CHECKS
    )
    + f""", count(*) FILTER (event_type NOT IN ({', '.join(f"'{c}'" for c in CHECKS)})) AS unlisted
FROM events GROUP BY user_id""",
)
def a5_status_matrix(spark, sf_dir):
    """The worst result of each check; errors and refunds are checks that the report does not list."""
    status = F.when(F.col("value") < 50, "failed").otherwise("passed")
    return changes.status_matrix(
        v.table(spark, sf_dir, "events"), "user_id", "event_type", CHECKS, status, ["failed", "passed"]
    )


# --- lists -------------------------------------------------------------------------------------

LIST = (["user_id"], ["ts", "event_id"])


def _events(spark, sf_dir):
    return v.table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value"
    )


def _skip():
    return F.col("event_type") == "error"


@register(
    "a4_flagged_positions",
    q.with_tables(q.SEQ)
    + "SELECT user_id, position FROM seq WHERE skip",
)
def a4_flagged_positions(spark, sf_dir):
    return sequence.flagged_positions(_events(spark, sf_dir), *LIST, _skip())


@register(
    "w1_renumber",
    """WITH kept AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
  FROM events WHERE event_type <> 'error')
SELECT event_id, user_id, n - 1 AS position,
  CASE WHEN n < 10 THEN '0' ELSE '' END || n || ' ' || event_type AS numbered_label FROM kept""",
)
def w1_renumber(spark, sf_dir):
    kept = exclude_types(_events(spark, sf_dir), "event_type", ["error"])
    label = text.label_fallback("event_type", F.lit(""), F.lit(""))
    return sequence.renumber(kept, *LIST, label).select(
        "event_id", "user_id", "position", "numbered_label"
    )


@register(
    "w2_last_visible",
    q.with_tables(q.SEQ)
    + """SELECT event_id, user_id, NOT skip AND position =
  max(CASE WHEN NOT skip THEN position END) OVER (PARTITION BY user_id) AS is_last_visible FROM seq""",
)
def w2_last_visible(spark, sf_dir):
    return sequence.last_visible(_events(spark, sf_dir), *LIST, _skip()).select(
        "event_id", "user_id", "is_last_visible"
    )


@register(
    "w3_neighbour_visible",
    q.with_tables(q.SEQ)
    + """SELECT event_id,
  coalesce(last_value(CASE WHEN NOT skip THEN event_id END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS previous_visible,
  coalesce(first_value(CASE WHEN NOT skip THEN event_id END IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), -1) AS next_visible
FROM seq WINDOW w AS (PARTITION BY user_id ORDER BY position)""",
)
def w3_neighbour_visible(spark, sf_dir):
    found = sequence.neighbours(_events(spark, sf_dir), *LIST, "event_id", _skip())
    return found.select(
        "event_id",
        F.coalesce("previous_visible", F.lit(-1)).alias("previous_visible"),
        F.coalesce("next_visible", F.lit(-1)).alias("next_visible"),
    )


@register(
    "w4_transitions",
    q.with_tables(q.SEQ)
    + """, moves AS (SELECT event_id, user_id, value, lag(value, 1, -1) OVER (PARTITION BY user_id ORDER BY position) AS previous_index FROM seq)
SELECT *, CASE WHEN value < previous_index THEN -1 ELSE 1 END AS direction FROM moves""",
)
def w4_transitions(spark, sf_dir):
    return sequence.transitions(_events(spark, sf_dir), *LIST, "value").select(
        "event_id", "user_id", "value", "previous_index", "direction"
    )


@register(
    "w5_suppress_noop",
    q.with_tables(q.SEQ)
    + """, moves AS (SELECT *, greatest(0, least(3, value)) AS index FROM seq),
states AS (SELECT *, lag(index, 1, 0) OVER (PARTITION BY user_id ORDER BY position) AS state FROM moves)
SELECT event_id, user_id, index FROM states WHERE index <> state""",
)
def w5_suppress_noop(spark, sf_dir):
    return sequence.suppress_noop(_events(spark, sf_dir), *LIST, "value", 4).select(
        "event_id", "user_id", "index"
    )


# --- streams -----------------------------------------------------------------------------------


@register(
    "stream_rules",
    q.with_tables(q.CATALOG, q.CHECKED)
    + "SELECT o_orderkey, enabled, coalesce(substr(problem, 3), '') AS problems FROM checked",
)
def stream_rules(spark, sf_dir):
    """Orders arrive as a stream, are joined to static customers and checked."""
    orders = jobs.stream_table(spark, sf_dir, "orders")
    checked = jobs.check_stream(v.catalog(spark, sf_dir, orders=orders))
    problems = F.array_join(
        F.transform("violations", lambda x: F.concat_ws(" ", x["field"], x["code"])), "; "
    )
    return jobs.run_available(
        checked.select(v.KEY, "enabled", problems.alias("problems")), scratch_folder(spark)
    )


@register("stream_routes", q.with_tables(q.PAGE_PATHS, ROUTES).rstrip())
def stream_routes(spark, sf_dir):
    """Page requests arrive as a stream and are resolved against a static table of routes."""
    pages = jobs.stream_table(spark, sf_dir, "pages")
    routed = jobs.route_stream(
        v.page_paths(spark, sf_dir, pages), v.page_routes(spark, sf_dir), "path"
    )
    return jobs.run_available(
        routed.select("page_id", "path", "route.endpoint", "route.reg_key"), scratch_folder(spark)
    )


@register(
    "stream_endpoints",
    q.with_tables(q.CATALOG)
    + """SELECT o_orderkey, 'app' AS role, CASE WHEN kind = 'fullstack' THEN mount_path || '/api' ELSE mount_path END AS mount_at
FROM catalog WHERE enabled AND kind <> 'frontend'
UNION ALL SELECT o_orderkey, 'static', mount_path FROM catalog WHERE enabled AND kind <> 'backend'""",
)
def stream_endpoints(spark, sf_dir):
    """Endpoints of enabled records as they arrive."""
    orders = jobs.stream_table(spark, sf_dir, "orders")
    rows = v.catalog(spark, sf_dir, orders=orders).filter("enabled")
    return jobs.run_available(
        cat.expand_endpoints(rows).select(v.KEY, "role", "mount_at"), scratch_folder(spark)
    )


@register("stream_lookup", ORACLE["j4_dimension_lookup"])
def stream_lookup(spark, sf_dir):
    """Customers arrive as a stream and get the names of their nation and region."""
    customers = jobs.stream_table(spark, sf_dir, "customer")
    rows = _placed(spark, sf_dir, customers).select("c_custkey", "n_name", "r_name")
    return jobs.run_available(rows, scratch_folder(spark))


@register("stream_array_lookup", ORACLE["j3_array_lookup"])
def stream_array_lookup(spark, sf_dir):
    """Pages arrive as a stream; the ordered array of their links is resolved within the row."""
    pages = jobs.stream_table(spark, sf_dir, "pages")
    found = jobs.array_lookup_stream(
        v.page_links(spark, sf_dir, pages), "links", v.first_words(spark, sf_dir), "word", ["page_id"], scratch_folder(spark)
    )
    return found.withColumn("first_doc", F.coalesce("first_doc", F.lit(-1)))


@register(
    "stream_hot_lookup",
    """SELECT l_orderkey, l_linenumber, s_name FROM lineitem
JOIN supplier ON CASE WHEN l_quantity > 5 THEN 1 ELSE l_suppkey END = s_suppkey""",
)
def stream_hot_lookup(spark, sf_dir):
    """Line items arrive as a stream; nine of ten ask for one supplier."""
    key = F.when(F.col("l_quantity") > 5, F.lit(1)).otherwise(F.col("l_suppkey")).cast("long").alias("s_suppkey")
    items = jobs.stream_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", key)
    suppliers = v.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name")
    found = jobs.hot_lookup_stream(items, suppliers, ["s_suppkey"], scratch_folder(spark), "inner")
    return found.select("l_orderkey", "l_linenumber", "s_name")
