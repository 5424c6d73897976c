import itertools
import random

import pytest
from pyspark.sql import functions as F

from colophon.session import Scratch
from colophon.operators import authors, coauthor, components as comp, paths, projections, stats
from colophon.plans import graph as graph_plan
from colophon.sources import tables as table_io


def union_find(edges, vertices=()):
    """Smallest member id per vertex, by brute force."""
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in [*parent, *vertices]}


def frame(spark, edges):
    return spark.createDataFrame(edges, "src long, dst long")


def labels(df):
    return {r.id: r.component for r in df.collect()}


def random_edges(seed, n, m):
    rng = random.Random(seed)
    return [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]


GRAPHS = {
    "chain": [(i, i + 1) for i in range(300)],
    "falling chain": [(300 - i, 299 - i) for i in range(300)],
    "star": [(7, i) for i in range(200) if i != 7],
    "two stars joined": [(1000, i) for i in range(100)] + [(2000, i) for i in range(90, 200)],
    "sparse": random_edges(1, 400, 300),
    "dense": random_edges(2, 60, 900),
    "loops and repeats": [(1, 1), (2, 3), (3, 2), (2, 3), (5, 5)],
    "caterpillar": [(i, i + 1) for i in range(40)] + [
        (i, 1000 + 50 * i + j) for i in range(40) for j in range(i)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name):
    edges = GRAPHS[name]
    want = union_find([e for e in edges if e[0] != e[1]])
    assert labels(comp.connected_components(frame(spark, edges))) == want


@pytest.mark.parametrize("name", ["chain", "two stars joined", "sparse"])
def test_components_of_big_tables(spark, name, shuffles_only):
    edges = GRAPHS[name]
    want = union_find([e for e in edges if e[0] != e[1]])
    assert labels(comp.connected_components(frame(spark, edges))) == want


def test_no_edges(spark):
    assert labels(comp.connected_components(frame(spark, []))) == {}
    only_loops = frame(spark, [(4, 4)])
    assert labels(comp.connected_components(only_loops)) == {}
    assert labels(comp.with_isolated(
        comp.connected_components(only_loops), only_loops, "src")) == {4: 4}


def test_component_from_the_larger_end_of_an_edge(spark):
    edges = spark.createDataFrame([(1, 2), (1, 3), (8, 9)], "author1_id long, author2_id long")
    for start in (1, 2, 3):
        assert sorted(r.id for r in comp.component_of(edges, start).collect()) == [1, 2, 3]
    assert comp.component_of(edges, 77).count() == 0


def test_component_deeper_than_the_walk(spark):
    edges = frame(spark, [(i, i + 1) for i in range(36)] + [(500, 501)])
    found = comp.component_of(edges, 0, "src", "dst")
    assert sorted(r.id for r in found.collect()) == list(range(37))
    labels = comp.connected_components(edges)
    assert sorted(r.id for r in comp.labelled_component(labels, 4).collect()) == list(range(37))


def files_read(df):
    """How many files the scans of a query read."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    todo, files = [plan], 0
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        elif node.metrics().contains("numFiles"):
            files += node.metrics().apply("numFiles").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return files


def test_a_step_reads_the_buckets_of_its_frontier(spark):
    scratch = Scratch(spark, "test")
    edges = frame(spark, [(i, i + 1) for i in range(2000)])
    links = comp.adjacency(edges, scratch, "src", "dst", 16)
    for n, most in ((1, 1), (2, 2), (2000, 16)):
        frontier = scratch.table(spark.range(n).select("id"), f"frontier{n}")
        found = comp.links_at(links, frontier, n, 16)
        assert files_read(found.select("v")) <= most + (scratch_files(spark, scratch, n) if n > 200 else 0)
        assert found.count() == 2 * n - 1


def scratch_files(spark, scratch, n):
    return len(spark.read.parquet(f"{scratch.path}/frontier{n}").inputFiles())


def test_reach_of_many_steps_is_one_scan(spark):
    edges = spark.createDataFrame([(f"v{i}", f"v{i + 1}") for i in range(30)] + [("x", "y"), ("v3", "v3"), ("w", "w")],
                                  "src string, dst string")
    found = comp.component_of(edges, "v7", "src", "dst", buckets=4)
    assert sorted(r.id for r in found.collect()) == sorted(f"v{i}" for i in range(31))
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert comp.component_of(edges, "w", "src", "dst").count() == 0
    assert comp.component_of(edges.limit(0), "w", "src", "dst").count() == 0


# publication -> authors; 9 wrote alone, 10 never
PAPERS = {"a": [1, 2], "b": [1, 2, 3], "c": [4, 5, 6, 7, 8], "d": [9], "e": [5, 1]}


@pytest.fixture(scope="module")
def author(spark):
    return spark.createDataFrame(
        [(p, k) for k, ps in PAPERS.items() for p in ps], "person_id long, publication_key string")


@pytest.fixture(scope="module")
def person(spark):
    return spark.createDataFrame(
        [(i, f"name {i % 9}") for i in range(1, 11)], "id long, full_name string")


def big_author(spark, n_people=40, n_papers=60, seed=3):
    rng = random.Random(seed)
    rows = {(rng.randrange(n_people), f"k{i}") for i in range(n_papers)
            for _ in range(rng.randrange(1, 7))}
    rows |= {(p, "everyone") for p in range(n_people)}
    rows |= {(100 + p, "everyone") for p in range(30)}
    return sorted(rows)


def brute_graph(rows):
    papers = {}
    for p, k in rows:
        papers.setdefault(k, set()).add(p)
    edges = {}
    for people in papers.values():
        for a, b in itertools.combinations(sorted(people), 2):
            n, w = edges.get((a, b), (0, 0.0))
            edges[a, b] = (n + 1, w + 1 / len(people))
    return edges


def as_edges(df):
    return {(r.author1_id, r.author2_id): (r.pair_count, pytest.approx(r.pair_weight))
            for r in df.collect()}


def test_small_graph(author):
    edges = as_edges(coauthor.coauthor_graph(author))
    assert edges[1, 2] == (2, pytest.approx(1 / 2 + 1 / 3))
    assert edges[1, 5] == (1, pytest.approx(0.5))
    assert sum(1 for e in edges.values() if e[1] == pytest.approx(0.2)) == 10
    assert not any(9 in e for e in edges)


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_graph_in_blocks(spark, block):
    rows = big_author(spark)
    df = spark.createDataFrame(rows, "person_id long, publication_key string")
    want = brute_graph(rows)
    assert as_edges(coauthor.coauthor_graph(df, block)) == want
    for threshold in (0.014, 0.3, 0.9):
        assert as_edges(coauthor.edges_above(df, threshold, block)) == {
            e: v for e, v in want.items() if round(v[1], 9) > threshold}


def test_invariants(spark):
    df = spark.createDataFrame(big_author(spark), "person_id long, publication_key string")
    graph = coauthor.coauthor_graph(df)
    degree = coauthor.weighted_degree(graph)
    total = graph.agg(F.sum("pair_count"), F.sum("pair_weight")).first()
    ends = degree.agg(F.sum("author_count"), F.sum("author_weight")).first()
    assert ends[0] == 2 * total[0] and ends[1] == pytest.approx(2 * total[1])
    def direct(d):
        return {r.author_id: (r.author_count, pytest.approx(r.author_weight))
                for r in d.collect()}
    assert direct(coauthor.weighted_degree_of_authors(df)) == direct(degree)
    people = df.select(F.col("person_id").alias("id"),
                       F.col("person_id").cast("string").alias("full_name")).distinct()
    shares = authors.fractional_productivity(people, df).agg(F.sum("weight")).first()[0]
    assert shares == pytest.approx(df.select("publication_key").distinct().count())


def test_ranking(author, person):
    degrees = coauthor.weighted_degree_of_authors(author)
    ranked = coauthor.top_authors(degrees, person).collect()
    # weights 5: 0.8 + 0.5, 1: 1/2 + 2/3 + 1/2; nobody for 9 and 10
    assert [r.full_name for r in ranked][0] == "name 1" and len(ranked) == 8
    assert ranked[0].author_count == 4
    assert [r.full_name for r in coauthor.top_authors(degrees, person, 2).collect()] == [
        r.full_name for r in ranked[:2]]
    pairs = coauthor.top_pairs(coauthor.coauthor_graph(author), person, 1).first()
    assert (pairs.name1, pairs.name2) == ("name 1", "name 2")


def test_person_components(spark, author, person):
    want = union_find([(a, b) for a, b in brute_graph(
        [(p, k) for k, ps in PAPERS.items() for p in ps])], [9])
    assert labels(comp.author_components(author)) == want
    connected = labels(comp.author_components(author, include_isolated=False))
    assert connected == {i: c for i, c in want.items() if i != 9}
    # The partition of persons and publications, restricted to persons, is the same one.
    publication = spark.createDataFrame([(k,) for k in [*PAPERS, "none"]], "key string")
    both = labels(comp.bipartite_components(
        author, vertices=comp.tagged_vertices(person, publication)))
    assert both["k:none"] == "k:none" and both["p:10"] == "p:10"
    groups = {}
    for i, c in want.items():
        groups.setdefault(both[f"p:{i}"], set()).add(c)
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))
    for k, people in PAPERS.items():
        assert both[f"k:{k}"] == both[f"p:{people[0]}"]
    assert all(c == min(v for v in both if both[v] == c) for c in set(both.values()))


def test_thresholds(spark, author, person):
    graph = coauthor.coauthor_graph(author)
    found = comp.components_above(graph, [0.5, 0.2, 0.1], person)
    by = {}
    for r in found.collect():
        by.setdefault(r.threshold, {})[r.id] = r.component
    # Strictly above: the edges of weight 0.2 and 0.5 do not count at their own threshold.
    assert by[0.5] == {**{i: i for i in range(1, 11)}, 2: 1}
    assert by[0.2][5] == 1 and by[0.2][4] == 4 and by[0.2][3] == 1
    assert by[0.1] == {**{i: 1 for i in range(1, 9)}, 9: 9, 10: 10}
    # A component of a higher threshold lies within one of a lower threshold.
    for low, high in ((0.1, 0.2), (0.2, 0.5)):
        assert all(by[low][i] == by[low][c] for i, c in by[high].items())
    assert comp.components_above(graph, [9.0]).count() == 0


def test_write_back(spark, author, person):
    found = comp.components_above(coauthor.coauthor_graph(author), [0.5])
    back = comp.write_back(person, found, "id", {"component": "part"}).collect()
    assert {r.id: r.part for r in back if r.part is not None} == {1: 1, 2: 1}
    assert len(back) == 10


def test_paths(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (3, 4)],
                                  "author1_id long, author2_id long")
    found = sorted(tuple(r.path) for r in paths.khop_paths(edges, 1, 3).collect())
    assert found == [(1, 2), (1, 2, 3), (1, 2, 3, 4), (1, 3), (1, 3, 2), (1, 3, 4)]


@pytest.mark.parametrize("few", [True, False])
def test_paths_to_wanted_ends(spark, few, monkeypatch):
    from colophon.operators import skew
    if not few:
        monkeypatch.setattr(skew, "BROADCAST_ROWS", -1)
    pairs = sorted({tuple(sorted(p)) for p in random_edges(5, 12, 25) if p[0] != p[1]} | {(20, 21)})
    edges = spark.createDataFrame(pairs, "author1_id long, author2_id long")
    every = {tuple(r.path) for r in paths.khop_paths(edges, pairs[0][0], 4).collect()}
    start = pairs[0][0]
    layers = paths.walk_layers(edges, start, 4)
    ends = spark.createDataFrame([(3,), (3,), (7,), (start,), (21,), (None,)], "id long")
    got = [(r.id, r.depth, tuple(r.path)) for r in paths.paths_to(layers, ends, start, 4).collect()]
    assert sorted(got) == sorted((p[-1], len(p) - 1, p) for p in every if p[-1] in (3, 7))
    # The shortest walk to a vertex is a path.
    assert {r.id: r.depth for r in paths.reach(layers, start).collect()} == {
        v: min(len(p) - 1 for p in every if p[-1] == v) for v in {p[-1] for p in every}}
    # Walks to one vertex share their links: a layer holds no more than both directions of the graph.
    assert layers.groupBy("hop").count().agg({"count": "max"}).first()[0] <= 2 * len(pairs)


def test_merge(spark):
    schema = "author1_id long, author2_id long, pair_count long, pair_weight double"
    old = spark.createDataFrame([(1, 2, 1, 0.5), (1, 3, 1, 0.5)], schema)
    new = spark.createDataFrame([(1, 2, 1, 0.5), (1, 3, 2, 0.7), (2, 3, 1, 0.5)], schema)
    assert sorted(tuple(r) for r in coauthor.merge_edges(old, new).collect()) == [
        (1, 2, 1, 0.5), (1, 3, 1, 0.5), (1, 3, 2, 0.7), (2, 3, 1, 0.5)]


def test_projection_sizes(spark, author, person):
    edges = comp.tagged_edges(author)
    publication = spark.createDataFrame([(k,) for k in [*PAPERS, "none"]], "key string")
    both = comp.tagged_vertices(person, publication)
    just_person = both.where(F.col("id").startswith("p:"))
    got = {r.name: (r.nodes, r.relationships) for r in projections.projection_sizes({
        "person": (just_person,
                   projections.relationships_within(edges, just_person, "src", "dst")),
        "both": (both, projections.relationships_within(edges, both, "src", "dst")),
        "minimal": (projections.minimal_vertices(edges), edges),
    }).collect()}
    n = sum(map(len, PAPERS.values()))
    assert got == {"person": (10, 0), "both": (16, n), "minimal": (14, n)}
    # Vertices outside the minimal graph are the persons and publications without authorship.
    assert got["both"][0] - got["minimal"][0] == 1 + 1


def test_size_distribution(spark):
    sizes = [1, 1, 1, 2, 2, 3, 5, 8, 13, 21]
    row = stats.size_distribution(
        spark.createDataFrame([(s,) for s in sizes], "size long")).first()
    assert (row.set_count, row.p1, row.p50, row.p75, row.p90, row.p100) == (10, 1, 2, 8, 13, 21)


def test_graph_job(spark, author, person, tmp_path):
    folder = str(tmp_path)
    rows = author.withColumn("bibtex", F.lit(None).cast("string")).withColumn(
        "aux", F.lit(None).cast("string"))
    people = person.withColumn("orcid", F.lit(None).cast("string"))
    table_io.write_tables({"author": rows, "person": people}, folder)
    graph_plan.build_graph(spark, folder, [0.2, 0.5])
    read = spark.read.parquet
    assert read(f"{folder}/coauthor_graph").count() == coauthor.coauthor_graph(author).count()
    assert read(f"{folder}/top_authors").count() == 8
    assert sorted(r.size for r in read(f"{folder}/component_sizes").collect()) == [1, 8]
    assert read(f"{folder}/component_distribution").first().set_count == 2
    assert read(f"{folder}/components_above").count() == 20


def test_bucketed_graph_needs_no_shuffle(spark, author, tmp_path):
    graph_plan.save_coauthor_graph(
        coauthor.coauthor_graph(author), "graph_in_buckets", str(tmp_path / "g"), 4)
    try:
        degree = spark.table("graph_in_buckets").groupBy("author1_id").agg(F.sum("pair_count"))
        plan = degree._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert degree.count() == 6
    finally:
        spark.sql("drop table graph_in_buckets")


def test_tasks_that_pair_authors_grow_with_the_rows(spark, monkeypatch):
    author = spark.createDataFrame([(i % 7, i // 4) for i in range(400)], "person_id long, publication_key long").distinct()

    def edges():
        return sorted((r[0], r[1], r[2], round(r[3], 9)) for r in coauthor.coauthor_graph(author).collect())

    whole = edges()
    monkeypatch.setattr(coauthor, "PAIRED_ROWS", 30)
    assert edges() == whole
    plan = coauthor.coauthor_graph(author)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(publication_key#" in plan and ", 14), REPARTITION_BY_NUM" in plan


def test_distinct_authorships_are_found_in_tasks_that_follow_the_rows(spark, monkeypatch):
    from colophon.operators import skew
    monkeypatch.setattr(skew, "TASK_ROWS", 30)
    rows = spark.createDataFrame([(i % 7, i // 4) for i in range(400)] * 2, "person_id long, publication_key long")
    found = skew.distinct_in_tasks(rows, 800)
    assert sorted(map(tuple, found.collect())) == sorted({(i % 7, i // 4) for i in range(400)})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(person_id#" in plan and ", 27), REPARTITION_BY_NUM" in plan
    assert "ENSURE_REQUIREMENTS" not in plan
    monkeypatch.setattr(skew, "TASK_ROWS", 10**6)
    assert "REPARTITION" not in skew.distinct_in_tasks(rows, 800)._jdf.queryExecution().executedPlan().toString()


def test_authorships_are_made_once_for_all_that_pairs_them(spark, author, shuffles_only):
    plan = coauthor.coauthor_pairs(author.distinct())._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("LeftOuter") == 0


def test_tasks_that_add_up_pairs_grow_with_the_pairs(spark, monkeypatch):
    # 100 publications of 4 of 40 authors, 600 pairs.
    author = spark.createDataFrame([((i * 7 + i // 40) % 40, i // 4) for i in range(400)], "person_id long, publication_key long")
    assert author.distinct().count() == 400

    def planned():
        graph = coauthor.coauthor_graph(author)
        return (sorted((r[0], r[1], r[2], round(r[3], 9)) for r in graph.collect()),
                graph._jdf.queryExecution().executedPlan().toString())

    whole, plan = planned()
    assert "author2_id#" in plan and "REPARTITION_BY_NUM" not in plan
    monkeypatch.setattr(coauthor, "ADDED_PAIRS", 50)
    found, plan = planned()
    assert found == whole and sum(r[2] for r in found) == 600
    to_edges = [line for line in plan.splitlines() if "Exchange hashpartitioning(author1_id#" in line]
    assert to_edges and all(", 13), REPARTITION_BY_NUM" in line for line in to_edges)
    # Five authors have each pair many times, which tasks add up before the shuffle.
    author = author.select((F.col("publication_key") + F.col("person_id")).alias("person_id") % 5, "publication_key").toDF(
        "person_id", "publication_key").distinct()
    assert "REPARTITION_BY_NUM" not in planned()[1]


def test_tasks_that_look_up_sizes_grow_with_the_rows(spark, shuffles_only, monkeypatch):
    from colophon.operators import authors, skew
    rows = spark.createDataFrame([(i, i // 4) for i in range(400)] + [(i, 7) for i in range(1000, 1300)],
                                 "person_id long, publication_key long")
    whole = sorted(map(tuple, authors.with_publication_count(rows).collect()))
    monkeypatch.setattr(skew, "TASK_ROWS", 30)
    found = authors.with_publication_count(rows)
    assert sorted(map(tuple, found.collect())) == whole and (1000, 304) in {(r.person_id, r.n_authors) for r in found.collect()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count(", 24), REPARTITION_BY_NUM") >= 2 and "ENSURE_REQUIREMENTS" not in plan


def test_long_lists_are_paired_in_tasks_that_follow_the_pairs(spark, monkeypatch):
    rows = [(i, "a") for i in range(60)] + [(i, "b") for i in range(40, 70)] + [(1, "c"), (2, "c")]
    author = spark.createDataFrame(rows, "person_id long, publication_key string")
    whole = sorted((r[0], r[1], r[2], round(r[3], 9)) for r in coauthor.coauthor_graph(author).collect())
    monkeypatch.setattr(coauthor, "PAIRED_ROWS", 30)
    monkeypatch.setattr(coauthor, "ADDED_PAIRS", 50)
    for made in (coauthor.coauthor_graph(author, 10), coauthor.edges_above(author, 0.0, 10)):
        assert sorted((r[0], r[1], r[2], round(r[3], 9)) for r in made.collect()) == whole
        # 60 * 59 / 2 + 30 * 29 / 2 = 2205 pairs, a quarter of them in parts of 30.
        assert "hashpartitioning(publication_key#" in (plan := made._jdf.queryExecution().executedPlan().toString())
        assert ", 19), REPARTITION_BY_NUM" in plan
