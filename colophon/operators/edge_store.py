"""Co-author edges that grow by small changes, and the labels of their components.

The edges lie in folders by a hash of both ends. A change reads only the folders that its own edges belong to and
adds files with what is missing there; nothing is written again. A merge that failed can be repeated, as edges
that it has added are found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from colophon.operators.coauthor import EDGE_COLUMNS, missing_edges
from colophon.operators.components import connected_components
from colophon.operators.skew import lookup_join
from colophon.session import Scratch

BUCKETS = 256


def _in_buckets(edges: DataFrame, buckets: int) -> DataFrame:
    """Edges with the folder they belong to; a hub's edges are in all folders."""
    place: Column = F.pmod(F.xxhash64("author1_id", "author2_id"), F.lit(buckets)).cast("int")
    return edges.select(*EDGE_COLUMNS).withColumn("bucket", place)


def _append(edges: DataFrame, folder: str) -> None:
    edges.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(folder)


def write_store(edges: DataFrame, folder: str, buckets: int = BUCKETS) -> None:
    """Write all edges to a new folder."""
    _append(_in_buckets(edges, buckets), folder)


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """``author1_id, author2_id, pair_count, pair_weight, bucket``."""
    return spark.read.schema("author1_id long, author2_id long, pair_count long, pair_weight double, "
                             "bucket int").parquet(folder)


def merge_into(store: str, new: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Add the new edges that a store lacks in this form (see ``merge_edges``), and return them.

    ``buckets`` is the number the store was written with. Folders that no new edge belongs to are not read.
    """
    scratch = Scratch(new.sparkSession, "merge")
    change = scratch.table(_in_buckets(new, buckets), "change")
    met = [r[0] for r in change.select("bucket").distinct().collect()]  # at most ``buckets``
    held = read_store(new.sparkSession, store).where(F.col("bucket").isin(met))
    missing = scratch.table(_in_buckets(missing_edges(held, change), buckets), "missing")
    if scratch.rows["missing"]:
        _append(missing, store)
    return missing.drop("bucket")


def merged_labels(labels: DataFrame, new: DataFrame, src: str = "author1_id",
                  dst: str = "author2_id") -> DataFrame:
    """``id, component`` after new edges were added to the graph that the written ``labels`` are of.

    The earlier edges are not read. Each component that a new edge meets is one vertex; the small graph of
    new edges between them is labelled, and what it joins gets the smallest label. Vertices that had no label
    are their own component until then.
    """
    scratch = Scratch(labels.sparkSession, "labels")
    rows = labels.count()  # from the file footers
    ends = new.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    known = scratch.table(ends, "ends")
    for end in ("u", "v"):
        known = lookup_join(known, labels.select(F.col("id").alias(end), F.col("component").alias(f"new_{end}")),
                            end, lookup_rows=rows)
    met = scratch.table(known.select(
        "u", "v", F.coalesce("new_u", "u").alias("cu"), F.coalesce("new_v", "v").alias("cv"),
        F.col("new_u").isNull().alias("fresh_u"), F.col("new_v").isNull().alias("fresh_v")), "met")
    joined = scratch.table(connected_components(met, "cu", "cv").select(
        F.col("id").alias("component"), F.col("component").alias("_to")), "joined")
    fresh = met.where("fresh_u and u <> v").select(F.col("u").alias("id")).unionAll(
        met.where("fresh_v and u <> v").select(F.col("v").alias("id"))).distinct()
    every = labels.select("id", "component").unionByName(fresh.select("id", F.col("id").alias("component")))
    return lookup_join(every, joined, "component", lookup_rows=scratch.rows["joined"]).select(
        "id", F.coalesce("_to", "component").alias("component"))
