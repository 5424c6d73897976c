"""Maximum spanning forests against a plain Kruskal."""

import random

import pytest

from colophon.operators import components as comp, forest
from colophon.plans import graph as graph_plan
from colophon.sources import tables as table_io

SCHEMA = "author1_id long, author2_id long, pair_weight double"


def kruskal(edges):
    """The forest with the same order of equal weights."""
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    kept = set()
    usable = {(round(w, 9), min(u, v), max(u, v)) for u, v, w in edges if None not in (u, v, w) and u != v}
    for w, u, v in sorted(usable, reverse=True):
        if find(u) != find(v):
            parent[find(u)] = find(v)
            kept.add((u, v, w))
    return kept


def random_edges(seed, n, m, weights):
    rng = random.Random(seed)
    return [(rng.randrange(n), rng.randrange(n), rng.choice(weights)) for _ in range(m)]


GRAPHS = {
    # Every pick points to the next vertex, so that pointers are as deep as they can be.
    "rising chain": [(i, i + 1, float(i)) for i in range(300)],
    "equal chain": [(i + 1, i, 0.5) for i in range(150)],
    "star": [(7, i, i / 10) for i in range(200) if i != 7],
    "sparse": random_edges(1, 300, 250, [0.1, 0.2, 0.5]),
    "dense": random_edges(2, 50, 900, [i / 7 for i in range(20)]),
    "odd rows": [(1, 1, 2.0), (2, 1, 0.5), (1, 2, 0.7), (1, 2, 0.7), (3, None, 1.0), (None, 4, 1.0), (1, 3, None),
                 (5, 6, -1.0), (6, 7, 0.1 + 0.2), (5, 7, 0.3)],
    "nothing": [],
}


def forest_of(spark, edges):
    found = forest.spanning_forest(spark.createDataFrame(edges, SCHEMA))
    rows = [tuple(r) for r in found.collect()]
    assert found.columns == ["author1_id", "author2_id", "pair_weight"] and len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("name", GRAPHS)
def test_forest(spark, name):
    assert forest_of(spark, GRAPHS[name]) == kruskal(GRAPHS[name])


def test_forest_of_big_tables(spark, shuffles_only):
    edges = random_edges(3, 60, 120, [0.1, 0.2, 0.3, 0.4])
    assert forest_of(spark, edges) == kruskal(edges)


def test_thresholds_of_the_forest_are_those_of_the_graph(spark):
    edges = spark.createDataFrame(random_edges(4, 150, 400, [0.1, 0.2, 0.3, 0.4, 0.5]), SCHEMA)
    kept, steps = forest.spanning_forest(edges), [0.05, 0.1, 0.3, 0.45]
    both = [sorted(map(tuple, comp.components_above(e, steps).collect())) for e in (edges, kept)]
    assert both[0] == both[1]
    counts = {r.threshold: r.n_edges for r in forest.forest_edges_above(kept, [*steps, 9.0]).collect()}
    assert counts[9.0] == 0
    for t in steps:
        labels = [(i, c) for s, i, c in both[0] if s == t]
        assert counts[t] == len(labels) - len({c for _, c in labels})


def test_written_forest_answers_other_thresholds(spark, tmp_path):
    papers = {"a": [1, 2], "b": [2, 3, 4], "c": [4, 5, 6, 7], "d": [9]}
    author = spark.createDataFrame([(p, k) for k, ps in papers.items() for p in ps],
                                   "person_id long, publication_key string")
    author = author.selectExpr("*", "cast(null as string) bibtex", "cast(null as string) aux")
    person = spark.createDataFrame([(i, f"N{i}") for i in range(1, 11)], "id long, full_name string").selectExpr(
        "*", "cast(null as string) orcid")
    folder = str(tmp_path)
    table_io.write_tables({"author": author, "person": person}, folder)
    graph_plan.build_graph(spark, folder, [0.4])
    assert spark.read.parquet(f"{folder}/spanning_forest").count() == 6

    def reached(start, t):
        return sorted(r.id for r in graph_plan.component_above(spark, folder, start, t).collect())

    assert reached(3, 0.3) == [1, 2, 3, 4]
    assert reached(3, 0.1) == [1, 2, 3, 4, 5, 6, 7]
    assert reached(3, 0.4) == [] and reached(1, 0.4) == [1, 2] and reached(9, 0.0) == []


@pytest.mark.parametrize("big", [False, True])
def test_heaviest_edges_come_first_in_dense_graphs(spark, monkeypatch, big):
    from colophon.operators import skew
    if big:
        monkeypatch.setattr(skew, "BROADCAST_ROWS", -1)
    # Two parts, which only light edges connect, and vertices that only have light edges.
    edges = random_edges(5, 60, 1200, [i / 10 for i in range(3, 40)])
    edges += [(100 + u, 100 + v, w) for u, v, w in random_edges(6, 40, 800, [0.5, 1.5, 2.5])]
    edges += [(3, 104, 0.01), (5, 105, 0.02), (200, 201, 0.05), (201, 7, 0.04), (202, 203, 0.1), (4, 4, 9.0)]
    carried, plain = [], forest._heaviest

    def counted(rows):
        carried.append(rows.count())
        return plain(rows)

    monkeypatch.setattr(forest, "_heaviest", counted)
    assert forest_of(spark, edges) == kruskal(edges)
    assert carried[0] < 1200 and all(n < 100 for n in carried[-2:])
