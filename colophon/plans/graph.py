"""The co-author graph with its rankings and components, written next to the tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from colophon.operators import coauthor, components, forest, stats
from colophon.session import Scratch
from colophon.sources import graphfiles, tables as table_io


def save_coauthor_graph(graph: DataFrame, table: str, path: str, buckets: int) -> None:
    """Write the edges as a table bucketed by their first end, so that later joins and
    aggregations on it need no shuffle of the edges."""
    (graph.write.mode("overwrite").option("path", path)
     .options(**table_io.bloom_filters("coauthor_graph", graph))
     .bucketBy(buckets, "author1_id").sortBy("author1_id", "author2_id").saveAsTable(table))


def build_graph(spark: SparkSession, folder: str, thresholds: Sequence[float] = (),
                buckets: int | None = None, table: str | None = None) -> None:
    """Write ``coauthor_graph``, ``top_authors``, ``components``, ``component_sizes``,
    ``component_distribution`` and, for thresholds, ``spanning_forest`` and ``components_above``. The
    forest answers any other threshold later, without the graph.

    With ``buckets`` the graph is bucketed and the catalogue knows it as ``table``, a name that
    the caller chooses, so that the graphs of several folders do not replace each other.
    """
    if buckets and not table:
        raise ValueError("a bucketed graph needs a table name")
    author = table_io.read_table(spark, folder, "author").select("person_id", "publication_key")
    author = Scratch(spark, "graph").table(author.distinct(), "author")
    person = table_io.read_table(spark, folder, "person")

    def write(df: DataFrame, name: str) -> DataFrame:
        table_io.write_tables({name: df}, folder)
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    if buckets:
        save_coauthor_graph(coauthor.coauthor_graph(author), table,
                            f"{folder}/coauthor_graph", buckets)
        graph = spark.table(table)
    else:
        graph = write(coauthor.coauthor_graph(author), "coauthor_graph")
    write(coauthor.top_authors(coauthor.weighted_degree_of_authors(author), person),
          "top_authors")
    labels = write(components.author_components(author), "components")
    sizes = write(components.component_sizes(labels), "component_sizes")
    write(stats.size_distribution(sizes), "component_distribution")
    if thresholds:
        kept = write(forest.spanning_forest(graph), "spanning_forest")
        write(components.components_above(kept, thresholds, person), "components_above")


def component_above(spark: SparkSession, folder: str, person_id: int, threshold: float) -> DataFrame:
    """``id`` of every person connected with one by edges above a threshold, from the written forest;
    nothing if no such edge is there."""
    kept = spark.read.parquet(f"{folder}/spanning_forest")
    return components.component_of(kept.where(coauthor.above(threshold)), person_id)


def export(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """Write the tables as property-graph files and return how many nodes and relationships
    an import of them must report."""
    return graphfiles.export_graph(spark, table_io.read_tables(spark, folder), target)
