"""Copies of the tables in the orders that author lookups read them by.

A copy is sorted by its first column over all of its files, and has only the columns that lookups return.
A lookup of listed keys then reads the row groups and pages whose least and greatest value enclose one of
them, so what it reads grows with its result and not with the table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from colophon.operators.authors import PUBLICATION_COLUMNS
from colophon.sources import tables as table_io

# Copy, its table, and its columns; the first is what it is sorted by. The second one is part of the order, so
# that a key that holds a large share of the rows is spread over many files.
COPIES = {
    "person_by_name": ("person", ["full_name", "id"]),
    "person_by_id": ("person", ["id", "full_name"]),
    "author_by_person": ("author", ["person_id", "publication_key"]),
    "author_by_publication": ("author", ["publication_key", "person_id"]),
    "publication_by_key": ("publication", PUBLICATION_COLUMNS),
}


def clustered(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with these columns, sorted by the first two over all partitions."""
    return df.select(*columns).repartitionByRange(*columns[:2]).sortWithinPartitions(*columns[:2])


def copies(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The copies of the tables there are, to be written next to them."""
    return {copy: clustered(tables[table], columns)
            for copy, (table, columns) in COPIES.items() if table in tables}


def write_copies(tables: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    """Write the copies below a folder and return their numbers of rows."""
    return table_io.write_tables(copies(tables), folder)


def _schema(table: str, columns: list[str], schemas: Mapping[str, T.StructType]) -> T.StructType:
    known = schemas[table] if table in schemas else table_io.table_schema(table)
    return T.StructType([known[c] for c in columns])


def lookup_tables(spark: SparkSession, folder: str,
                  schemas: Mapping[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """The arguments of ``publications_of`` that stand for the tables: the copies below a folder, all of one
    version, or the tables themselves where it has no copies. ``schemas`` are for tables whose columns
    have other types than the usual ones."""
    home = table_io.current_folder(spark, folder)
    if not all(table_io.path_exists(spark, f"{home}/{copy}/_SUCCESS") for copy in COPIES):
        return table_io.read_tables(spark, folder, ("person", "author", "publication"))
    found = {copy: spark.read.schema(_schema(table, columns, schemas or {})).parquet(f"{home}/{copy}")
             for copy, (table, columns) in COPIES.items()}
    return {"person": found["person_by_name"], "author": found["author_by_person"],
            "publication": found["publication_by_key"], "person_by_id": found["person_by_id"],
            "author_by_publication": found["author_by_publication"]}
