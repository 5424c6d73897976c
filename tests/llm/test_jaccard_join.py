from collections import defaultdict

import numpy as np
from helpers import documents, odd_documents, shingles

from colophon.llm import jaccard_join
from colophon.llm.jaccard_join import VALUES, needed, one_per_class


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    index = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            index[x].append(i)
    common = defaultdict(int)
    for held in index.values():
        for i in held:
            for j in held:
                if i < j:
                    common[i, j] += 1
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links, texts = [0] * len(sets), [set() for _ in sets]
    for (i, j), n in common.items():
        if n * 10 >= 8 * (len(sets[i][1]) + len(sets[j][1]) - n):
            links[i] += 1
            links[j] += 1
            if sets[i][1] != sets[j][1]:
                texts[i].add(frozenset(sets[j][1]))
                texts[j].add(frozenset(sets[i][1]))
            parent[root(i)] = root(j)
    least = defaultdict(lambda: 10**12)
    for i, (d, _) in enumerate(sets):
        least[root(i)] = min(least[root(i)], d)
    return sorted((d, least[root(i)], links[i], len(texts[i])) for i, (d, _) in enumerate(sets))


def compare(df):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = jaccard_join.jaccard_join(df).filter("doc_id is not null").select(
        "doc_id", "class_id", "n_links", "n_linked_texts").collect()
    assert sorted(map(tuple, got)) == brute(rows)


def near_copies(n, size=60, edits=1):
    base = [f"b{i}" for i in range(size * edits)]
    return [(1000 + k, " ".join(base[:k % len(base)] + [f"new{k}"] + base[k % len(base) + 1:])) for k in range(n)]


def test_documents(spark):
    compare(documents(spark))


def test_odd_cases(spark):
    df = odd_documents(spark)
    compare(df)
    alone = jaccard_join.jaccard_join(df).filter("doc_id is null").collect()
    assert len(alone) == 2 and all(r["kept"] and r["class_id"] is None for r in alone)


def test_groups_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BUCKET_BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "CLUSTER_BLOCK", 16)
    compare(spark.createDataFrame(near_copies(90), "doc_id long, text string"))


def test_chain_of_links_is_one_class(spark):
    words = [f"c{i}" for i in range(300)]
    rows = [(k, " ".join(words[8 * k:8 * k + 120])) for k in range(20)]
    compare(spark.createDataFrame(rows, "doc_id long, text string"))


def test_one_per_class(spark):
    df = odd_documents(spark)
    kept = one_per_class(df)
    assert kept.columns == df.columns
    classes = {r["class_id"] for r in jaccard_join.jaccard_join(df).collect()} - {None}
    assert sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect()) == sorted(classes)
    assert kept.filter("doc_id is null").count() == 2


def test_empty(spark):
    assert jaccard_join.jaccard_join(odd_documents(spark).limit(0)).count() == 0


def test_pruning_limits():
    # 60 agreeing values of 60 never go, and few of many always do.
    assert needed(VALUES) < 0.8 * VALUES and needed(10) >= 1
    rng = np.random.default_rng(0)
    lost = np.mean((rng.random((200_000, VALUES)) < 0.8).sum(axis=1) < needed(VALUES))
    assert lost < 1e-4
