"""Views of the sample tables in the shape the operators take.

Attributes are derived from keys over whole tables; no view leaves rows out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastre.functions.text import canonical_path, slug_to_module
from cadastre.operators.skew import lookup_join
from cadastre.sources.listing import write_files
from cadastre.sources.scratch import settle

KEY = "o_orderkey"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for costly work per row on a scan that has fewer partitions than cores.

    A file of one row group is one partition.  A scan with partitions enough is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _every(n: int) -> Column:
    return F.col(KEY) % n == 0


def kind_of_order() -> Column:
    return (
        F.when(F.col(KEY) % 3 == 0, "backend")
        .when(F.col(KEY) % 3 == 1, "frontend")
        .otherwise("fullstack")
    )


def catalog(
    spark: SparkSession,
    sf_dir: str,
    group: str = "c_mktsegment",
    orders: DataFrame | None = None,
) -> DataFrame:
    """One record per order; orders of one customer share a path, so keys repeat."""
    orders = spread(table(spark, sf_dir, "orders")) if orders is None else orders
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"
    )
    rows = lookup_join(orders, customer, ["o_custkey"], "inner").select(
        KEY,
        F.col("c_name").alias("name"),
        F.concat(F.lit("c-"), F.col("o_custkey").cast("string")).alias("slug"),
        F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("description"),
        F.lower(group).alias("group"),
        F.array("c_name").alias("members"),
        kind_of_order().alias("kind"),
        (F.col("o_orderstatus") != "P").alias("enabled"),
        "o_orderstatus",
        "o_orderpriority",
        "o_custkey",
    )
    module = F.concat(F.lit("apps."), "group", F.lit("."), slug_to_module("slug"), F.lit(".main:app"))
    return rows.withColumns(
        {
            "entry": F.when(~_every(11), module),
            "static_dir": F.when(~_every(13), F.lit("dist")),
            "mount_path": F.when(_every(17), F.concat(F.lit("/wrong/"), "slug")).otherwise(
                canonical_path("group", "slug")
            ),
        }
    )


def module_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modules that exist: those of customers whose balance is not negative."""
    c = table(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    return c.select(
        F.concat(
            F.lit("apps."), F.lower("c_mktsegment"), F.lit(".c_"), F.col("c_custkey").cast("string"),
            F.lit(".main"),
        ).alias("module"),
        F.lit("app").alias("attr"),
    )


def static_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directories that exist: every project's own, and ``dist`` where the balance is below 8000.

    The latter are written in three ways that mean the same.
    """
    c = table(spark, sf_dir, "customer")
    own = F.concat(F.lower("c_mktsegment"), F.lit("/c_"), F.col("c_custkey").cast("string"))
    ways = F.array(F.lit("/dist"), F.lit("/dist/"), F.lit("/./dist"))
    dist = F.concat(own, F.get(ways, (F.col("c_custkey") % 3).cast("int")))
    dist = F.when(F.col("c_acctbal") < 8000, dist)
    return c.select(F.explode(F.array_compact(F.array(own, dist))).alias("static_path"))


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _member(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), value)


def json_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as JSON text, with absent, null and wrongly typed fields by order key."""
    rows = catalog(spark, sf_dir)
    name, slug, group = F.col("name"), F.col("slug"), F.col("group")
    fields = [
        F.when(~_every(19), _member("name", _quoted(name))),
        _member(
            "slug", F.when(_every(23), F.col("o_custkey").cast("string")).otherwise(_quoted(slug))
        ),
        _member("description", F.when(_every(29), F.lit("null")).otherwise(_quoted(F.col("description")))),
        _member("group", _quoted(group)),
        _member(
            "members",
            F.when(_every(31), F.lit("[]"))
            .when(_every(37), F.concat(F.lit("["), _quoted(name), F.lit(",7,null]")))
            .when(_every(41), _quoted(name))
            .otherwise(F.concat(F.lit("["), _quoted(name), F.lit("]"))),
        ),
        _member("kind", _quoted(F.when(_every(43), F.lit("other")).otherwise(F.col("kind")))),
        _member("mount_path", _quoted(F.col("mount_path"))),
        _member("entry", F.coalesce(_quoted(F.col("entry")), F.lit("null"))),
        _member("static_dir", _quoted(F.col("static_dir"))),
        F.when(_every(47), F.lit('"enabled":null'))
        .when(_every(53), F.lit('"enabled":"maybe"'))
        .when(F.col("o_orderstatus") == "P", F.lit('"enabled":"No"'))
        .when(F.col("o_orderstatus") == "F", F.lit('"enabled":1')),
        F.when(_every(59), F.lit('"checks":[]')).when(
            F.col("o_orderstatus") == "F", F.lit('"checks":{"pytest":"on"}')
        ),
    ]
    text = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    text = F.when(_every(61), F.concat(text, F.lit("]"))).when(_every(67), F.lit("[1]")).otherwise(text)
    return rows.select(KEY, text.alias("content"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\n"))


def yaml_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as YAML text in block form, with YAML's own surprises by order key."""
    rows = catalog(spark, sf_dir)
    none = F.lit("")
    lines = [
        _line("name", _quoted(F.col("name"))),
        _line("slug", F.when(_every(23), F.lit("on")).otherwise(F.col("slug"))),
        _line(
            "description",
            F.when(_every(29), F.lit("2024-01-31")).otherwise(_quoted(F.col("description"))),
        ),
        _line("group", F.col("group")),
        F.concat(F.lit("members:\n  - "), F.col("name"), F.lit("\n")),
        _line("kind", F.col("kind")),
        _line("mount_path", F.col("mount_path")),
        F.when(F.col("entry").isNull(), F.lit("entry:\n")).otherwise(_line("entry", F.col("entry"))),
        F.coalesce(_line("static_dir", F.col("static_dir")), none),
        F.when(F.col("o_orderstatus") == "P", F.lit("enabled: off\n"))
        .when(F.col("o_orderstatus") == "F", F.lit("enabled: 'yes'\n"))
        .otherwise(none),
        F.when(F.col("o_orderstatus") == "F", F.lit("checks:\n  pytest: true\n")).otherwise(none),
    ]
    text = F.concat(*lines)
    text = F.when(_every(61), F.concat(text, F.lit("name: [open\n"))).when(_every(67), F.lit("")).otherwise(text)
    return rows.select(KEY, text.alias("content"))


def page_paths(
    spark: SparkSession, sf_dir: str, pages: DataFrame | None = None
) -> DataFrame:
    """Path of every page's URL."""
    pages = table(spark, sf_dir, "pages") if pages is None else pages
    return pages.select(
        "page_id", F.parse_url("url", F.lit("PATH")).alias("path")
    )


def page_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes at one and two segments, registered in the order pages first show them.

    The two-segment route of a page comes just before its one-segment route, so some deep routes
    win and the others are shadowed.
    """
    parts = F.split("path", "/")
    first = F.concat(F.lit("/"), F.try_element_at(parts, F.lit(2)))
    second = F.concat(first, F.lit("/"), F.try_element_at(parts, F.lit(3)))
    paths = page_paths(spark, sf_dir)
    deep = paths.select(second.alias("mount_at"), (F.col("page_id") * 2).alias("reg_key"))
    flat = paths.select(first.alias("mount_at"), (F.col("page_id") * 2 + 1).alias("reg_key"))
    return deep.unionByName(flat).select(
        "mount_at", F.concat(F.lit("page of "), "mount_at").alias("endpoint"), "reg_key"
    )


def page_links(spark: SparkSession, sf_dir: str, pages: DataFrame | None = None) -> DataFrame:
    """Ordered array of the navigation targets of every page."""
    pages = table(spark, sf_dir, "pages") if pages is None else pages
    return pages.select(
        "page_id",
        F.regexp_extract_all("html", F.lit('<li><a href="/([^"]*)"'), F.lit(1)).alias("links"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def first_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with the first document that has it."""
    words = documents(spark, sf_dir).select(
        "doc_id", F.explode(F.split("text", r"[ \n]")).alias("word")
    )
    words = words.filter("word <> ''")
    return settle(words.groupBy("word").agg(F.min("doc_id").alias("first_doc")))


def changed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page paths as changed files: German pages lie outside ``apps/``."""
    path = F.expr("substring(path, 2)")
    return page_paths(spark, sf_dir).select(
        "page_id",
        F.when(F.col("path").startswith("/de/"), path)
        .otherwise(F.concat(F.lit("apps/"), path))
        .alias("path"),
    )


def unit_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units with a manifest: pages served over https, with their check flags."""
    parts = F.split(F.parse_url("url", F.lit("PATH")), "/")
    pages = table(spark, sf_dir, "pages").filter(F.col("url").startswith("https:"))
    name = F.coalesce(F.try_element_at(parts, F.lit(3)), F.lit(""))
    unit = F.concat(F.try_element_at(parts, F.lit(2)), F.lit("/"), name).alias("unit")
    return settle(
        pages.groupBy(unit).agg(
            F.max(F.col("url").contains("?")).alias("pytest"),
            F.max(F.col("url").contains("#")).alias("mypy"),
        )
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document with its position."""
    return documents(spark, sf_dir).select(
        "doc_id", "source", F.posexplode(F.split("text", "\n")).alias("position", "text")
    )


def supplier_tree(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Every supplier as a project in a tree of files: manifest, source and static files, with faults by key.

    Manifests: empty (every 7th), not UTF-8 (9th), at a wrong path (11th), and a copy in a second folder (5th).
    Sources: none where the balance is negative, without the attribute (4n + 1), no Python (10n + 3).
    Static files: where the balance is below 8000; every 4th names their folder by a detour.
    """
    key = F.col("s_suppkey")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    rows = lookup_join(spread(table(spark, sf_dir, "supplier")), nation, ["s_nationkey"], "inner")
    every = lambda n, rest=0: key % n == rest
    group, slug = F.concat(F.lit("nation-"), "s_nationkey"), F.concat(F.lit("s-"), key)
    folder, project = slug_to_module("group"), slug_to_module("slug")
    rows = rows.select("s_suppkey", "s_name", "n_name", "s_acctbal", group.alias("group"), slug.alias("slug"))
    kind = F.when(every(3), "backend").when(every(3, 1), "frontend").otherwise("fullstack")
    mount = F.when(every(11), F.concat(F.lit("/wrong/"), "slug")).otherwise(canonical_path("group", "slug"))
    static = F.when(every(4), "./dist/../dist").otherwise("dist")
    text = F.format_string(
        'name: "%s"\nslug: %s\ndescription: %s\ngroup: %s\nmembers: ["%s"]\nkind: %s\nmount_path: %s\n'
        "entry: apps.%s.%s.main:app\nstatic_dir: %s\n",
        "s_name", "slug", "n_name", "group", "s_name", kind, mount, folder, project, static,
    )
    broken = F.concat(F.unhex(F.lit("FFFE")), text.cast("binary"))
    manifest = F.when(every(7), F.lit("").cast("binary")).when(every(9), broken).otherwise(text.cast("binary"))
    source = (
        F.when(every(4, 1), "def create():\n    app = 1\n    return app\n")
        .when(every(10, 3), "app = (\n")
        .otherwise("try:\n    from fast import app\nexcept ImportError:\n    app = None\n")
    )
    own = F.array(folder, project)
    file = lambda place, name, content: F.struct(
        F.concat(place, F.array(*map(F.lit, name))).alias("parts"), content.cast("binary").alias("content")
    )
    files = F.array(
        file(own, ["project.yaml"], manifest),
        F.when(every(5), file(F.array(folder, F.concat(project, F.lit("_copy"))), ["project.yaml"], manifest)),
        F.when(F.col("s_acctbal") >= 0, file(own, ["main.py"], source)),
        F.when(F.col("s_acctbal") < 8000, file(own, ["dist", "index.html"], F.lit("<p>"))),
    )
    each = rows.select(F.explode(F.array_compact(files)).alias("file")).select("file.*")
    write_files(each, root, "parts", "content")
