"""Edges and labels that grow by small changes."""

import os
import random

import pytest

from colophon.operators import coauthor, components as comp, edge_store
from colophon.session import Scratch

SCHEMA = "author1_id long, author2_id long, pair_count long, pair_weight double"


def files(folder):
    return {os.path.join(at, f) for at, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def buckets_of(paths):
    return {p.split("bucket=")[1].split("/")[0] for p in paths}


def random_edges(seed, n, m):
    rng = random.Random(seed)
    pairs = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(m)}
    return [(u, v, 1, 0.5) for u, v in sorted(pairs)]


def test_a_change_adds_files_only_where_it_belongs(spark, tmp_path):
    store, edges = str(tmp_path / "store"), random_edges(1, 400, 2000)
    old = spark.createDataFrame(edges, SCHEMA)
    edge_store.write_store(old, store, 64)
    before = files(store)
    assert len(buckets_of(before)) == 64
    # One edge that is there, one with another count, and some new ones: 1 % of all.
    change = spark.createDataFrame(
        [edges[0], (*edges[1][:2], 2, 0.5)] + [(1000 + i, 2000, 1, 0.25) for i in range(18)], SCHEMA)
    want = sorted(map(tuple, coauthor.merge_edges(old, change).collect()))
    added = edge_store.merge_into(store, change, 64)
    assert added.count() == 19
    fresh = files(store) - before
    assert before < files(store) and len(buckets_of(fresh)) <= 19
    got = edge_store.read_store(spark, store)
    assert sorted(map(tuple, got.drop("bucket").collect())) == want
    # Again, as after a failure: nothing is added.
    assert edge_store.merge_into(store, change, 64).count() == 0
    assert edge_store.merge_into(store, change.limit(0), 64).count() == 0
    assert files(store) == before | fresh


@pytest.mark.parametrize("few", [True, False])
def test_labels_are_those_of_a_full_run(spark, few, monkeypatch):
    if not few:
        from colophon.operators import skew
        monkeypatch.setattr(skew, "BROADCAST_ROWS", -1)
    # Sparse enough for many components; new edges join some, bring new vertices, and one is a loop.
    edges = random_edges(2, 200, 110)
    extra = [*random_edges(3, 200, 30), (500, 501, 1, 0.5), (3, 600, 1, 0.5), (700, 700, 1, 0.5)]
    old, new = spark.createDataFrame(edges, SCHEMA), spark.createDataFrame(extra, SCHEMA)
    labels = Scratch(spark, "test").table(comp.connected_components(old, "author1_id", "author2_id"), "labels")
    got = sorted(map(tuple, edge_store.merged_labels(labels, new).collect()))
    assert got == sorted(map(tuple, comp.connected_components(
        old.unionAll(new), "author1_id", "author2_id").collect()))
    assert sorted(map(tuple, edge_store.merged_labels(labels, new.limit(0)).collect())) == sorted(
        map(tuple, labels.collect()))
