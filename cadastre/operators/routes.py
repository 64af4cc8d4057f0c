"""Path to endpoint.  Routes match whole segments; the first one registered wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastre.operators.inline import entry, hash_table
from cadastre.operators.skew import fits_broadcast, lookup_join
from cadastre.sources.scratch import settle


# Fixed values: (phase, step, path, endpoint, matched whole); records' endpoints are phase 1.
FIXED_ROUTES = [
    (0, 0, "/static", "static", False),
    (2, 0, "/health", "health", True),
    (2, 1, "/", "index", True),
]


def resolve_routes(requests: DataFrame, routes: DataFrame, path: str) -> DataFrame:
    """Add ``route``: ``(reg_key, endpoint, mount_at)`` of the winning route, null if none.

    ``routes(mount_at, endpoint, reg_key[, exact])``: a route matches its own path and, unless it
    is ``exact``, every path below it; a route at ``/`` matches everything then.  ``reg_key`` is
    any value that sorts in registration order.

    A prefix test as a join condition would compare every request with every route.  Routes that
    are few are compiled to a trie per first segment, which is broadcast and walked within the row: one
    join at any depth, on a stream too.  Otherwise the different paths are expanded to their prefixes,
    joined once, reduced to the winner per path and joined back: the number of shuffles does not depend
    on the depth, and a path that very many requests have is one row.  A stream, which cannot be
    reduced, is then joined depth by depth.
    """
    if "exact" not in routes.columns:
        routes = routes.withColumn("exact", F.lit(False))
    at_root = (F.col("mount_at") == "/") & ~F.col("exact")
    depth = F.when(at_root, 0).when(~F.col("exact"), F.size(F.split("mount_at", "/")) - 1)
    first = F.min(F.struct("reg_key", "endpoint", "mount_at")).alias("_route")
    best = settle(routes.groupBy("mount_at", "exact").agg(first).withColumn("depth", depth))
    if fits_broadcast(best):
        trie = settle(route_trie(best))
        if fits_broadcast(trie):
            return _walk(requests, trie, best.filter(at_root).select("_route"), path)
    kind = best.schema["_route"].dataType
    # Null, -1 and up: the exact routes, and each depth that has routes.
    depths = sorted(-1 if r["depth"] is None else r["depth"] for r in best.select("depth").distinct().collect())
    if not depths:
        return requests.withColumn("route", F.lit(None).cast(kind))
    parts = F.split(F.col(path), "/")
    if requests.isStreaming:
        out, found = requests, []
        for level in depths:
            name = f"_route_{level + 1}"
            side = best.filter(F.col("depth") == level if level >= 0 else F.col("depth").isNull())
            side = side.select(F.col("mount_at").alias("_prefix"), F.col("_route").alias(name))
            # A shorter path gets a value no mount has; null would gather all of them in one task.
            asked = F.coalesce(_prefix_of(parts, level), F.concat(F.col(path), F.lit("/")))
            out = lookup_join(out.withColumn("_prefix", asked), side, ["_prefix"], "left", level == 0)
            out = out.drop("_prefix")
            found.append(F.col(name))
        return out.withColumn("route", F.array_min(F.array(*found))).drop(*[f"_route_{d + 1}" for d in depths])

    paths = requests.select(F.col(path).alias("_path")).distinct()
    parts = F.split(F.col("_path"), "/")
    asked = F.array(
        *[F.struct(F.lit(d).alias("_depth"), _prefix_of(parts, d).alias("_prefix")) for d in depths]
    )
    each = paths.select("_path", F.explode(asked).alias("_ask")).select("_path", "_ask.*").filter("_prefix IS NOT NULL")
    side = best.select(
        F.coalesce("depth", F.lit(-1)).alias("_depth"), F.col("mount_at").alias("_prefix"), "_route"
    )
    winners = each.join(side, ["_depth", "_prefix"]).groupBy("_path").agg(F.min("_route").alias("route"))
    winners = settle(winners.withColumnRenamed("_path", "_winner"))
    side = F.broadcast(winners) if fits_broadcast(winners) else winners
    return requests.join(side, requests[path] == side["_winner"], "left").drop("_winner")


# Ends the segments of a path.  No segment holds it, so the step over it is that of the exact routes.
END = "/"


def _steps(path: Column) -> tuple[Column, Column]:
    """(first segment, the segments after it) of a path; one that does not begin with ``/`` is all first."""
    parts = F.split(path, "/")
    rooted = path.startswith("/")
    rest = F.slice(parts, F.lit(3), F.greatest(F.size(parts) - 2, F.lit(0)))
    return (
        F.when(rooted, F.try_element_at(parts, F.lit(2))).otherwise(F.concat(F.lit("/"), path)),
        F.when(rooted, rest).otherwise(F.array().cast("array<string>")),
    )


def route_trie(best: DataFrame) -> DataFrame:
    """``(_first, _root, _top, _table)`` per first segment of ``best(mount_at, exact, _route)``.

    ``_root`` is the node of the first segment and ``_top`` its route; ``_table`` holds the other nodes as
    steps ``(node, segment, child, route)``.  A route at ``/`` that matches everything is not in it.
    """
    first, rest = _steps(F.col("mount_at"))
    routes = best.filter(F.col("exact") | (F.col("mount_at").startswith("/") & (F.col("mount_at") != "/")))
    rest = F.when(F.col("exact"), F.concat(rest, F.array(F.lit(END)))).otherwise(rest)
    routes = routes.select(first.alias("_first"), rest.alias("rest"), "_route")
    each = routes.select("_first", "rest", "_route", F.explode(F.sequence(F.lit(0), F.size("rest"))).alias("n"))
    nodes = each.groupBy("_first", F.slice("rest", F.lit(1), F.col("n")).alias("prefix")).agg(
        F.min(F.when(F.col("n") == F.size("rest"), F.col("_route"))).alias("route")
    )
    nodes = settle(nodes.withColumn("child", F.monotonically_increasing_id()))
    last = F.size("prefix")
    steps = nodes.filter(last > 0).select(
        "_first", F.slice("prefix", F.lit(1), last - 1).alias("prefix"),
        F.element_at("prefix", -1).alias("segment"), "child", "route",
    )
    parents = nodes.select("_first", "prefix", F.col("child").alias("node"))
    steps = steps.join(parents, ["_first", "prefix"]).select("_first", "node", "segment", "child", "route")
    roots = nodes.filter(last == 0).select("_first", F.col("child").alias("_root"), F.col("route").alias("_top"))
    return roots.join(hash_table(steps, ["node", "segment"], "_table", "_first"), "_first", "left")


def _walk(requests: DataFrame, trie: DataFrame, everywhere: DataFrame, path: str) -> DataFrame:
    """Walk the trie from segment to segment, keeping the least route passed on the way."""
    first, rest = _steps(F.col(path))
    out = lookup_join(requests.withColumn("_first", first), trie, ["_first"], "left", True)

    def step(state, segment):
        to = entry(F.col("_table"), node=state["node"], segment=segment)
        return F.struct(
            F.coalesce(to["child"], F.lit(-1).cast("long")).alias("node"), F.least(state["best"], to["route"]).alias("best")
        )

    begin = F.struct(F.coalesce("_root", F.lit(-1).cast("long")).alias("node"), F.col("_top").alias("best"))
    walked = F.aggregate(F.concat(rest, F.array(F.lit(END))), begin, step, lambda state: state["best"])
    out = out.withColumn("route", walked).drop("_first", "_root", "_top", "_table")
    if everywhere.isEmpty():
        return out
    side = everywhere.select(F.lit("/").alias("_root"), F.col("_route").alias("_everywhere"))
    out = lookup_join(out.withColumn("_root", F.lit("/")), side, ["_root"], "left", True)
    return out.withColumn("route", F.least("route", "_everywhere")).drop("_root", "_everywhere")


def _prefix_of(parts: Column, depth: int) -> Column:
    """A path's prefix of so many segments, null if it has fewer; -1 is the path itself."""
    if depth < 0:
        return F.array_join(parts, "/")
    if depth == 0:
        return F.lit("/")
    return F.when(F.size(parts) > depth, F.array_join(F.slice(parts, 1, depth + 1), "/"))


def catalogue_routes(endpoints: DataFrame, order: str) -> DataFrame:
    """Routes of a catalogue in registration order.

    ``/static`` comes first, so a group named ``static`` is shadowed; then the endpoints in
    catalogue order, a record's API before its files; ``/health`` and ``/`` last, matched whole.
    """
    spark = endpoints.sparkSession
    place = endpoints.schema[order].dataType.simpleString()
    fixed = spark.createDataFrame(
        FIXED_ROUTES, "phase int, step int, mount_at string, endpoint string, exact boolean"
    )
    # null sorts first within a phase, and only the middle phase has places.
    fixed = fixed.select(
        "mount_at",
        "endpoint",
        F.struct("phase", F.lit(None).cast(place).alias("place"), "step").alias("reg_key"),
        "exact",
    )
    listed = endpoints.select(
        "mount_at",
        F.col("target").alias("endpoint"),
        F.struct(
            F.lit(1).alias("phase"), F.col(order).alias("place"), F.col("role_order").alias("step")
        ).alias("reg_key"),
        F.lit(False).alias("exact"),
    )
    return fixed.unionByName(listed)
