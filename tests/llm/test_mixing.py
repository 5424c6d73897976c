"""Mixing against its definition, and the splitting tree against its margins."""

from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from colophon.llm import mixing
from colophon.session import Scratch
from helpers import documents, odd_documents, words


@pytest.mark.parametrize("sizes, weights", [
    ([10, 10, 10], [1, 2, 3]), ([1, 100, 1000], [3, 2, 1]), ([0, 5, 0], [1, 1, 5]), ([0, 0], [1, 2]), ([7], [2]), ([], []),
    ([1, 2, 4, 1000], [1000, 1000, 1000, 1])])
def test_targets_share_all_and_stop_at_the_cap(sizes, weights):
    found = mixing.targets(sizes, weights)
    assert sum(found) == pytest.approx(sum(sizes))
    level = [t / w for t, n, w in zip(found, sizes, weights) if t < 3 * n]
    assert len({round(x, 9) for x in level}) <= 1  # all sources below their cap stand at one level
    for goal, n, w in zip(found, sizes, weights):
        assert goal <= 3 * n
        assert goal < 3 * n or not level or goal / w <= level[0] + 1e-9
    whole = [Fraction(w * sum(sizes), sum(weights)) for w in weights]
    if all(share <= 3 * n for share, n in zip(whole, sizes)):
        assert found == [float(share) for share in whole]


def test_splitting_tree_keeps_quotas_and_sizes():
    quotas = [0, 1, 17, 1000, 333]
    shards = mixing.splitting_tree(quotas, 7, np.random.default_rng(1))
    assert [sum(column) for column in zip(*shards)] == quotas
    assert max(map(sum, shards)) - min(map(sum, shards)) <= 1
    assert min(min(row) for row in shards) >= 0


def test_splitting_tree_draws_without_replacement():
    """The mean and spread of one cell are the hypergeometric law's."""
    rng = np.random.default_rng(5)
    cells = [mixing.splitting_tree([30, 70], 4, rng)[0][0] for _ in range(4000)]
    assert np.mean(cells) == pytest.approx(7.5, abs=0.15)
    assert np.var(cells) == pytest.approx(25 * 0.3 * 0.7 * 75 / 99, rel=0.15)


def test_huge_quotas_keep_their_sums(monkeypatch):
    quotas = [3 * 10**10, 7 * 10**9, 1]
    shards = mixing.splitting_tree(quotas, 16, np.random.default_rng(1))
    assert [sum(column) for column in zip(*shards)] == quotas
    assert all(abs(row[0] / sum(row) - 30 / 37) < 1e-4 for row in shards)


def _odd(spark):
    long_word_list = "many words in one text " * 3000
    return odd_documents(spark, [(20 + i, f"some words of document {i} " * (i % 5), None, None if i % 7 == 0 else f"s{i % 3}")
                                 for i in range(60)] + [(90, long_word_list, "en", "Z"), (90, long_word_list, "en", "Z")])


def test_taken_words_of_odd_documents(spark):
    docs = _odd(spark)
    found = mixing.words_taken(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in found) == sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, len(words(r["text"]))) for r in docs.collect())
    sizes = Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(words(r["text"]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goals = dict(zip(order, mixing.targets([sizes[s] for s in order], [i % 3 + 1 for i in range(len(order))])))
    assert {(r["source_size"], r["target"]) for r in found} == {(sizes[s], goals[s]) for s in order}
    by_target = defaultdict(int)
    for r in found:
        by_target[r["source_size"], r["target"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    for (_, goal), taken in by_target.items():
        assert abs(taken - goal) <= 0.5
    again = mixing.words_taken(docs.repartition(3)).groupBy("doc_id").agg(F.sum("taken")).collect()
    first = Counter()
    for r in found:
        first[r["doc_id"]] += r["taken"]
    assert dict(first) == {r[0]: r[1] for r in again}


def test_shards_are_disjoint_even_and_mixed(spark):
    scratch = Scratch(spark, "test")
    rows = mixing.staged(documents(spark), scratch)
    placed = mixing.placements(rows, mixing.sources_of(rows), scratch, shards=8).collect()
    assert len({(r["row"], r["block"], r["copy"]) for r in placed}) == len(placed)
    in_shard = Counter(r["shard"] for r in placed)
    assert sorted(in_shard) == list(range(8)) and max(in_shard.values()) - min(in_shard.values()) <= 1
    for shard in range(8):
        keys = [r["order_key"] for r in placed if r["shard"] == shard]
        assert keys == sorted(keys)


def test_texts_of_the_mix(spark):
    docs = _odd(spark)
    mixed = mixing.mix(docs, shards=3).collect()
    taken = {r["doc_id"]: 0 for r in docs.collect()}
    for r in mixed:
        assert len(words(r["text"])) == r["length"]
        taken[r["doc_id"]] += r["length"]
    wanted = Counter()
    for r in mixing.words_taken(docs, shards=3).collect():
        wanted[r["doc_id"]] += r["taken"]
    assert taken == dict(wanted)
    texts = {r["text"] for r in docs.collect()}
    assert all(r["text"] in texts for r in mixed if r["first_word"] == 0 and r["doc_id"] == 7)


def test_no_rows_and_no_words(spark):
    empty = documents(spark).limit(0)
    assert mixing.words_taken(empty).count() == 0 and mixing.mix(empty).count() == 0
    blank = empty.unionByName(spark.createDataFrame([(1, None, "en", "a", 0), (2, " ", None, None, 1)], empty.schema))
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.words_taken(blank).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.mix(blank).count() == 0
