"""Common parts of the SQL that states what each query must return."""

from cadastre.functions.text import LINE_ENDS, WHITESPACE

CATALOG = """catalog AS (
  SELECT o_orderkey, c_name AS name, 'c-' || o_custkey AS slug,
         o_orderpriority || ' ' || o_orderstatus AS description,
         lower(c_mktsegment) AS "group", o_custkey, o_orderstatus, o_orderpriority,
         CASE o_orderkey % 3 WHEN 0 THEN 'backend' WHEN 1 THEN 'frontend' ELSE 'fullstack' END AS kind,
         o_orderstatus <> 'P' AS enabled,
         CASE WHEN o_orderkey % 11 <> 0
              THEN 'apps.' || lower(c_mktsegment) || '.c_' || o_custkey || '.main:app' END AS entry,
         CASE WHEN o_orderkey % 13 <> 0 THEN 'dist' END AS static_dir,
         CASE WHEN o_orderkey % 17 = 0 THEN '/wrong/c-' || o_custkey
              ELSE '/' || lower(c_mktsegment) || '/c-' || o_custkey END AS mount_path
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

CHECKED = """checked AS (
  SELECT *,
    CASE WHEN kind IN ('backend', 'fullstack') AND entry IS NULL THEN '2 entry required'
         WHEN kind IN ('frontend', 'fullstack') AND static_dir IS NULL THEN '2 static_dir required'
         WHEN mount_path <> '/' || "group" || '/' || slug THEN '3 mount_path not_canonical'
    END AS problem
  FROM catalog)"""

TARGETS = """listed_modules AS (
  SELECT 'apps.' || lower(c_mktsegment) || '.c_' || c_custkey || '.main' AS module
  FROM customer WHERE c_acctbal >= 0),
listed_dirs AS (
  SELECT lower(c_mktsegment) || '/c_' || c_custkey || '/dist' AS static_path
  FROM customer WHERE c_acctbal < 8000
  UNION ALL SELECT lower(c_mktsegment) || '/c_' || c_custkey FROM customer),
targeted AS (
  SELECT *,
    CASE WHEN kind IN ('backend', 'fullstack') THEN
      coalesce(replace(entry, ':app', '') IN (SELECT module FROM listed_modules), false) END AS module_ok,
    CASE WHEN kind IN ('frontend', 'fullstack') THEN coalesce("group" || '/' || replace(slug, '-', '_')
      || '/' || static_dir IN (SELECT static_path FROM listed_dirs), false) END AS static_ok
  FROM {rows})"""

# What ``views.supplier_tree`` writes: its manifests, and what their targets are.
TREE = """tree AS (
  SELECT s_suppkey, s_name, n_name, s_acctbal, 'nation-' || s_nationkey AS "group", 's-' || s_suppkey AS slug,
         'nation_' || s_nationkey || '/s_' || s_suppkey AS folder, s_suppkey % 7 = 0 AS empty,
         s_suppkey % 7 <> 0 AND s_suppkey % 9 = 0 AS undecodable,
         CASE s_suppkey % 3 WHEN 0 THEN 'backend' WHEN 1 THEN 'frontend' ELSE 'fullstack' END AS kind
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
manifests AS (
  SELECT *, folder || '/project.yaml' AS path FROM tree
  UNION ALL SELECT *, folder || '_copy/project.yaml' FROM tree WHERE s_suppkey % 5 = 0),
targets AS (
  SELECT *, s_acctbal >= 0 AND s_suppkey % 4 <> 1 AND s_suppkey % 10 <> 3 AS module_ok, s_acctbal < 8000 AS static_ok
  FROM tree)"""

# Order keys that make a derived manifest undecodable.
UNREADABLE = "(o_orderkey % 61 = 0 OR o_orderkey % 67 = 0)"

PAGE_PATHS = """paths AS (
  SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages)"""

UNIT_MANIFESTS = """manifests AS (
  SELECT split_part(path, '/', 2) || '/' || split_part(path, '/', 3) AS unit,
         max(contains(url, '?')) AS pytest, max(contains(url, '#')) AS mypy
  FROM (SELECT url, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages
        WHERE starts_with(url, 'https:')) GROUP BY 1)"""

CHANGED_UNITS = """units AS (
  SELECT DISTINCT split_part(path, '/', 2) || '/' || split_part(path, '/', 3) AS unit
  FROM paths WHERE NOT starts_with(path, '/de/'))"""

LINES = """lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS text,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS position
  FROM documents)"""

SEQ = """seq AS (
  SELECT *, event_type = 'error' AS skip,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS position
  FROM events)"""


def sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SPACES = sql_text(WHITESPACE)
NOT_LINE_END = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in LINE_ENDS) + "]"


def with_tables(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
