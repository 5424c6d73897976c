"""Subgraphs of the bibliography: which vertices and relationships they take."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from colophon.operators.authors import authorship, with_publication_count


def relationships_within(relation: DataFrame, vertices: DataFrame, src: str, dst: str,
                         id_col: str = "id") -> DataFrame:
    """Relationships with both ends among the vertices."""
    ids = vertices.select(F.col(id_col)).distinct()
    return relation.join(ids, relation[src] == ids[id_col], "left_semi").join(
        ids, relation[dst] == ids[id_col], "left_semi")


def minimal_vertices(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Vertices that have an edge."""
    return edges.select(F.col(src).alias("id")).union(
        edges.select(F.col(dst).alias("id"))).distinct()


def weighted_relation(author: DataFrame) -> DataFrame:
    """Authorships with the publication's weight per author."""
    return with_publication_count(authorship(author)).select(
        "person_id", "publication_key", (F.lit(1.0) / F.col("n_authors")).alias("weight"))


def projection_sizes(projections: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``name, nodes, relationships`` of each ``name -> (vertices, edges)``."""
    def count(name: str, kind: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("name"), F.lit(kind).alias("kind"), "n")

    parts = [count(name, kind, df)
             for name, pair in projections.items()
             for kind, df in zip(("nodes", "relationships"), pair)]
    return reduce(DataFrame.unionByName, parts).groupBy("name").agg(
        F.sum(F.when(F.col("kind") == "nodes", F.col("n"))).alias("nodes"),
        F.sum(F.when(F.col("kind") == "relationships", F.col("n"))).alias("relationships"))
