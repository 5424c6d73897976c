"""Bounded walks from one author."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from colophon.operators.skew import checked_broadcast, prune_to
from colophon.session import Scratch


def khop_paths(edges: DataFrame, start, depth: int, src: str = "author1_id",
               dst: str = "author2_id") -> DataFrame:
    """All simple paths of 1..``depth`` edges from ``start``: ``id`` (last vertex), ``depth``
    and ``path``. For reachability use ``component_of``, which needs no paths.

    ``edges`` should be a written table that has each undirected edge once; it is not copied,
    but joined with the current paths from either end.
    """
    scratch = Scratch(edges.sparkSession, "paths")
    links = edges.select(src, dst).where(F.col(src) != F.col(dst))
    kind = edges.schema[src].dataType.simpleString()
    step = edges.sparkSession.createDataFrame([(start, 0, [start])],
                                              f"id {kind}, depth int, path array<{kind}>")
    rows, found = 1, []
    for hop in range(1, depth + 1):
        here = checked_broadcast(step.select(F.col("id").alias("end"), "path"), rows)
        ways = [links.join(here, F.col(a) == F.col("end")).select(F.col(b).alias("id"), "path")
                for a, b in ((src, dst), (dst, src))]
        longer = ways[0].unionAll(ways[1]).where(~F.array_contains("path", F.col("id"))).select(
            "id", F.lit(hop).alias("depth"), F.array_append("path", F.col("id")).alias("path"))
        step = scratch.table(longer, f"hop{hop}")
        rows = scratch.rows[f"hop{hop}"]
        found.append(step)
    return reduce(DataFrame.unionByName, found)


def walk_layers(edges: DataFrame, start, depth: int, src: str = "author1_id",
                dst: str = "author2_id") -> DataFrame:
    """``hop, id, came_from``: where walks of exactly ``hop`` edges from ``start`` can end, and the vertices they can
    come from. Each link is there once per hop however many walks take it, so a layer is never larger than
    the graph in both directions, and no path is written.

    ``edges`` should be a written table that has each undirected edge once.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark, "layers")
    links = edges.select(src, dst).where(F.col(src) != F.col(dst))
    kind = edges.schema[src].dataType.simpleString()
    here, rows = spark.createDataFrame([(start,)], f"end {kind}"), 1
    for hop in range(1, depth + 1):
        listed = checked_broadcast(here, rows)
        ways = [links.join(listed, F.col(a) == F.col("end")).select(F.col(b).alias("id"), F.col(a).alias("came_from"))
                for a, b in ((src, dst), (dst, src))]
        layer = scratch.table(ways[0].unionAll(ways[1]).distinct(), f"layers/hop={hop}")
        here = scratch.table(layer.select(F.col("id").alias("end")).distinct(), f"ends{hop}")
        rows = scratch.rows[f"ends{hop}"]
    return spark.read.schema(f"id {kind}, came_from {kind}, hop int").parquet(f"{scratch.path}/layers")


def reach(layers: DataFrame, start) -> DataFrame:
    """``id, depth``: every vertex but the start that the walks reach, with the fewest edges it takes."""
    return layers.where(F.col("id") != F.lit(start)).groupBy("id").agg(F.min("hop").alias("depth"))


def paths_to(layers: DataFrame, ends: DataFrame, start, depth: int) -> DataFrame:
    """All simple paths of 1..``depth`` edges from ``start`` to the wanted ``ends(id)``, like ``khop_paths``.

    They are listed backwards through the layers, so only paths that lead to a wanted vertex are formed.
    """
    scratch = Scratch(layers.sparkSession, "ends")
    wanted = scratch.table(ends.select("id").where(F.col("id") != F.lit(start)).distinct(), "wanted")
    parts, rows = None, 0
    for hop in range(depth, 0, -1):
        layer = layers.where(F.col("hop") == hop).select("id", "came_from")
        own = prune_to(layer.select("id"), wanted, "id", "id", rows=scratch.rows["wanted"]).distinct().select(
            "id", F.array("id").alias("path"), F.col("id").alias("_at"))
        parts = own if parts is None else parts.unionByName(own)
        parts = scratch.table(parts, f"at{hop}")
        rows = scratch.rows[f"at{hop}"]
        back = checked_broadcast(parts, rows).withColumnRenamed("id", "_end")
        parts = layer.join(back, F.col("id") == F.col("_at")).where(~F.array_contains("path", F.col("came_from"))).select(
            F.col("_end").alias("id"), F.array_prepend("path", F.col("came_from")).alias("path"),
            F.col("came_from").alias("_at"))
    return parts.select("id", (F.size("path") - 1).alias("depth"), "path")
