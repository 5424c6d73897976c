import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from colophon.operators import authors, skew, stats
from colophon.operators.ordering import dense_ids
from colophon.operators.shred import attach_by_position

PERSON = [(1, "Ann"), (2, "Bob"), (3, "Ann"), (4, "Idle")]
AUTHOR = [(1, "a"), (2, "a"), (2, "b"), (3, "c"), (3, "a")]
PUBLICATION = [("a", "A", 2000), ("b", "B", 2001), ("c", "C", None), ("z", "Z", 1999)]


@pytest.fixture(scope="module")
def tables(spark):
    publication = spark.createDataFrame(PUBLICATION, "key string, title string, year int")
    for c in ("booktitle", "journal", "pages"):
        publication = publication.withColumn(c, F.lit(None).cast("string"))
    return (spark.createDataFrame(PERSON, "id long, full_name string"),
            spark.createDataFrame(AUTHOR, "person_id long, publication_key string"),
            publication)


def lookup(tables, name):
    found = authors.author_publications(name, *tables)
    assert found.columns == ["full_name", "key", "title", "booktitle", "journal", "pages", "year"]
    return sorted((r.full_name, r.key) for r in found.collect())


def test_publications_with_all_authors(tables):
    # Both persons called Ann wrote "a", so its authors are listed for each of them.
    assert lookup(tables, "Ann") == sorted(
        2 * [("Ann", "a"), ("Ann", "a"), ("Bob", "a")] + [("Ann", "c")])
    assert lookup(tables, "Bob") == [("Ann", "a"), ("Ann", "a"), ("Bob", "a"), ("Bob", "b")]


def test_person_without_publications_and_unknown_name(tables):
    found = authors.author_publications("Idle", *tables).collect()
    assert [tuple(r) for r in found] == [(None,) * 7]
    assert authors.author_publications("Nobody", *tables).count() == 0


def test_lookup_of_many_names_by_shuffle(spark, tables, shuffles_only):
    names = spark.createDataFrame([("Ann",), ("Bob",), ("Idle",)], "requested_name string")
    found = authors.publications_of(names, *tables)
    for name in ("Ann", "Bob"):
        got = sorted((r.full_name, r.key)
                     for r in found.where(F.col("requested_name") == name).collect())
        assert got == lookup(tables, name)
    assert found.where("requested_name = 'Idle'").count() == 1


def test_counts(spark, tables):
    person, author, publication = tables
    counts = authors.author_pub_counts(person, author)
    assert {r.id: r.count_publications for r in counts.collect()} == {1: 1, 2: 2, 3: 2, 4: 0}
    assert [r.id for r in authors.top_k_authors(counts, 2).collect()] == [2, 3]
    assert authors.author_count_one(author, 99).first()[0] == 0
    assert {r.name: r.pub_count for r in authors.name_pub_counts(person, author).collect()} == {
        "Ann": 3, "Bob": 2}
    n = {r.key: r.n_authors for r in
         authors.publication_n_authors(publication, author).collect()}
    assert n == {"a": 3, "b": 1, "c": 1, "z": None}
    assert [r.key for r in authors.largest_author_lists(publication, author, 1).collect()] == ["a"]


def test_sample_is_the_same_for_any_partitioning(spark, tables):
    person, author, _ = tables
    counts = authors.author_pub_counts(person, author)
    want = sorted(range(1, 5), key=lambda i: hashlib.md5(f"{i}:s".encode()).hexdigest())[:3]
    for parts in (1, 5):
        got = authors.random_authors(counts.repartition(parts), 3, "s").collect()
        assert [r.id for r in got] == want
    both = authors.benchmark_authors(person, author, 2, 4)
    # Two persons with one name and one count are one row of the union.
    assert sorted(tuple(r) for r in both.collect()) == [
        ("Ann", 1), ("Ann", 2), ("Bob", 2), ("Idle", 0)]


def test_statistics(spark):
    rng = random.Random(5)
    rows = [(run, i, float(rng.randrange(50)))
            for i, run in enumerate(rng.choices("abc", [1, 1, 8], k=400))]
    rows += [("one", 1000, 3.0), ("none", 1001, None)]
    df = spark.createDataFrame(rows, "run string, i long, v double")
    got = {r.run: r for r in stats.summary_stats(df, "run", "v", "i", "i").collect()}
    for run in "abc":
        values = [(v, i) for r, i, v in rows if r == run]
        only = [v for v, _ in values]
        r = got[run]
        assert (r["min"], r["max"], r["count"]) == (min(only), max(only), len(only))
        assert r["median"] == statistics.median(only)
        assert r["mean"] == pytest.approx(statistics.mean(only))
        assert r["std"] == pytest.approx(statistics.stdev(only))
        assert r["arg_max"] == min(i for v, i in values if v == max(only))
        assert r["arg_min"] == min(i for v, i in values if v == min(only))
    assert got["one"]["median"] == 3.0 and got["one"]["std"] is None
    assert got["none"]["median"] is None and got["none"]["arg_max"] is None
    sums = [sum(v for r, _, v in rows if r == run) for run in "abc"] + [3.0]
    runs = stats.summary_of_runs(df, "run", "v").first()
    assert runs["mean"] == pytest.approx(statistics.mean(sums))
    assert runs["std"] == pytest.approx(statistics.stdev(sums))


def test_dense_ids_over_many_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    got = dense_ids(df, ["x"])
    assert got.where("id <> x").count() == 0 and got.count() == 1000


def test_positions(spark):
    left = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "i int, l string")
    right = spark.createDataFrame([(10, "x"), (30, "z"), (20, "y")], "j int, r string")
    got = attach_by_position(left, right, ["i"], ["j"])
    assert sorted((r.l, r.r) for r in got.collect()) == [("a", "x"), ("b", "y"), ("c", "z")]


@pytest.mark.parametrize("limit", [-1, 10**6])
def test_lookup_with_a_hot_key(spark, monkeypatch, limit):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", limit)
    fact = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.col("id") % 500).alias("k"))
    table = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = skew.lookup_join(fact, table, "k", hot_share=0.1)
    assert got.columns == ["id", "k", "v"] or set(got.columns) == {"id", "k", "v"}
    want = fact.join(table, "k", "left").select("id", "k", "v")
    assert sorted(map(tuple, got.select("id", "k", "v").collect()), key=repr) == sorted(
        map(tuple, want.collect()), key=repr)


def test_mean_and_deviation_of_ten_runs(spark):
    # Sums of ten runs and their published mean and sample deviation (fixed values).
    sums = [366792.761, 361896.354, 378547.78, 389248.277, 378146.897, 373707.895, 366623.221,
            369391.925, 362907.109, 361354.039]
    # Each run's sum comes from two measurements.
    rows = [(i, part * s) for i, s in enumerate(sums) for part in (0.25, 0.75)]
    got = stats.summary_of_runs(spark.createDataFrame(rows, "run int, v double"), "run", "v")
    row = got.first()
    assert row["runs"] == 10
    assert row["mean"] == pytest.approx(370861.6258, abs=1e-4)
    assert row["std"] == pytest.approx(9000.2885, abs=1e-3)
