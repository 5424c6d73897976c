"""Lookups in copies that are sorted by what is looked up."""

import pytest
from pyspark.sql import functions as F

from colophon.operators import authors
from colophon.operators.skew import prune_to
from colophon.plans import ingest, lookup
from colophon.sources import tables as table_io
from tests.test_publish import dump

N = 400_000


def rows_scanned(df):
    """Rows that the file scans of a collected result gave."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        elif node.metrics().contains("numFiles"):
            found += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


@pytest.fixture(scope="module")
def tables(spark):
    """Four authors a publication; publication 5 has a third of all rows."""
    rows = spark.range(N).select(
        (F.xxhash64("id") % 50_000 + 50_000).alias("person_id"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.floor(F.col("id") / 4)).cast("long").alias("publication_key"))
    publication = spark.range(N // 4).select(
        F.col("id").alias("key"), *[F.lit("x").alias(c) for c in authors.PUBLICATION_COLUMNS[1:5]],
        F.lit(2000).alias("year"), F.lit("no part of a lookup").alias("mdate"))
    return {"person": spark.range(100_000).select("id", F.concat(F.lit("N"), F.col("id") % 90_000).alias("full_name")),
            "author": rows.distinct(), "publication": publication}


@pytest.fixture(scope="module")
def found(spark, tables, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("copies"))
    counts = lookup.write_copies(tables, folder)
    assert counts["author_by_person"] == counts["author_by_publication"] == tables["author"].count()
    return lookup.lookup_tables(spark, folder, {name: df.schema for name, df in tables.items()})


def test_copies_give_the_same_rows(spark, tables, found):
    for name in ("N77", "N50001", "nobody"):
        want = sorted(map(repr, authors.author_publications(name, **tables).collect()))
        assert sorted(map(repr, authors.author_publications(name, **found).collect())) == want
    names = spark.createDataFrame([("N60000",), ("N60001",), (None,), ("nobody",)], "requested_name string")
    assert sorted(map(repr, authors.publications_of(names, **found).collect())) == sorted(
        map(repr, authors.publications_of(names, **tables).collect()))


def test_lookups_read_what_they_return(spark, found):
    keys = spark.createDataFrame([(70_000,)], "k long")
    for table, column in (("author", "person_id"), ("author_by_publication", "publication_key"),
                          ("person_by_id", "id"), ("publication", "key")):
        total = found[table].count()
        assert rows_scanned(prune_to(found[table], keys, column, "k", rows=1)) <= total / 3
    assert rows_scanned(found["person"].where("full_name = 'N77'")) <= found["person"].count() / 3


def test_a_key_with_a_third_of_the_rows_is_in_many_files(spark, tables):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid_out = lookup.clustered(tables["author"], ["publication_key", "person_id"])
        parts = laid_out.where("publication_key = 5").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) > 1


def test_publishing_writes_the_copies(spark, tmp_path):
    staging, live = str(tmp_path / "staging"), str(tmp_path / "live")
    ingest.ingest(spark, dump(tmp_path / "a.xml", "b/1", "c/2"), staging)
    # Loaded tables have no copies yet.
    assert set(lookup.lookup_tables(spark, staging)) == {"person", "author", "publication"}
    ingest.publish(spark, staging, live)
    copied = lookup.lookup_tables(spark, live)
    assert set(copied) == {"person", "author", "publication", "person_by_id", "author_by_publication"}
    assert [r.key for r in authors.author_publications("Author c/2", **copied).collect()] == ["c/2"]
    for copy, (table, columns) in lookup.COPIES.items():
        home = table_io.current_folder(spark, live)
        assert sorted(map(repr, spark.read.parquet(f"{home}/{copy}").collect())) == sorted(
            map(repr, table_io.read_table(spark, live, table).select(*columns).collect()))


def test_copies_of_empty_tables(spark, tmp_path, tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    lookup.write_copies(empty, str(tmp_path))
    found = lookup.lookup_tables(spark, str(tmp_path), {name: df.schema for name, df in tables.items()})
    assert authors.author_publications("N1", **found).count() == 0
