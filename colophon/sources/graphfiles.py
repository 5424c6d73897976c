"""Node and relationship files of the property graph."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from colophon.sources.tables import table_counts

RELATIONSHIPS = {"author": "authored", "editor": "edited"}

# How the import format marks a node's id and a relationship's two ends.
ID_MARK, START_MARK, END_MARK = ":ID({}-ID)", ":START_ID({}-ID)", ":END_ID({}-ID)"
# Spark's short names of types that the format spells in another way.
SPELLINGS = {"bigint": "long", "smallint": "short", "tinyint": "byte", "timestamp": "datetime"}


def headers(table: str, schema: T.StructType) -> list[str]:
    """Import headers of a table's columns: keys are marked, and every column that is no text
    names the type that the schema gives it."""
    marks = {"id": "id" + ID_MARK.format(table), "key": "key" + ID_MARK.format(table)}
    if table in RELATIONSHIPS:
        marks |= {"person_id": START_MARK.format("person"),
                  "publication_key": END_MARK.format("publication")}
    found = []
    for field in schema.fields:
        kind = field.dataType.simpleString()
        typed = field.name if kind == "string" else f"{field.name}:{SPELLINGS.get(kind, kind)}"
        found.append(marks.get(field.name, typed))
    return found


def graph_file(table: str, df: DataFrame) -> DataFrame:
    """A table as a node or relationship file: renamed columns, each row once."""
    return df.dropDuplicates().toDF(*headers(table, df.schema))


def graph_file_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``kind, entity, header, rows`` of every file of the export."""
    found = None
    for table, df in tables.items():
        part = df.dropDuplicates().agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit("relationship" if table in RELATIONSHIPS else "node").alias("kind"),
            F.lit(RELATIONSHIPS.get(table, table.capitalize())).alias("entity"),
            F.lit(", ".join(headers(table, df.schema))).alias("header"),
            "rows")
        found = part if found is None else found.unionByName(part)
    return found


def export_graph(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> DataFrame:
    """Write ``<table>.csv`` folders without header lines and a ``<table>.csv.header`` each.

    Returns ``kind, n``: how many nodes and relationships were written, observed on the way.
    """
    written = []
    for table, df in tables.items():
        rows, lines = graph_file(table, df), Observation()
        rows.observe(lines, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").csv(
            f"{folder}/{table}.csv", header=False, quoteAll=True, escape='"')
        header = spark.createDataFrame([(", ".join(rows.columns),)], "value string")
        header.write.mode("overwrite").text(f"{folder}/{table}.csv.header")
        written.append((table, lines.get["rows"]))
    return _by_kind(spark.createDataFrame(written, "table_name string, rows long"))


def graph_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``kind, n``: how many nodes and relationships an import of these tables' files must report,
    where each row is once."""
    return _by_kind(table_counts({t: df.dropDuplicates() for t, df in tables.items()}))


def _by_kind(counts: DataFrame) -> DataFrame:
    relationship = F.col("table_name").isin(list(RELATIONSHIPS))
    return (
        counts
        .groupBy(F.when(relationship, "relationships").otherwise("nodes").alias("kind"))
        .agg(F.sum("rows").alias("n"))
    )
