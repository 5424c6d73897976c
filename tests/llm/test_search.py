"""Ranked search against scoring every document, with small blocks, ranges and segments."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from colophon.llm import search
from colophon.session import Scratch
from helpers import documents, odd_documents, SF

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, kept=20):
    """``(item, rank, doc, score)`` by scoring all documents for all items."""
    docs = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    sizes = [sum(c.values()) for _, c in docs]
    n, all_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in docs for t in c)
    found = []
    for item, text in items:
        rows = []
        for (doc_id, have), size in zip(docs, sizes):
            m = 75 + 25 * size * n // max(all_terms, 1)
            score = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * have[t] // (1000 * have[t] + 12 * m))
                        for t, k in Counter(terms(text)).items() if t in have)
            if score > 0:
                rows.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(rows, key=lambda r: r[:3])[:kept], 1)]
    return sorted(found, key=str)


def rows_of(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


@pytest.fixture
def small(monkeypatch):
    """Many segments, ranges and blocks in a small table. Tasks run with the values given here."""
    monkeypatch.setattr(search, "SEGMENT_DOCS", 120)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id long, score string").select("*", F.lit(1).alias("rank"))


def test_packed_numbers_come_back():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**28 - 1, 2**28, 2**35 - 1])
    data, ends = search.packed(values)
    assert search.unpacked(data).tolist() == values.tolist()
    assert search.unpacked(data[ends[2]:ends[5]]).tolist() == values[3:6].tolist()
    assert len(search.packed(np.zeros(0, np.int64))[0]) == 0


def test_segment_lists_hold_all_postings():
    texts = ["a b a " * 3, "b", None, "C-c c"] + ["a"] * 300
    (_, _, hashes, at), = search.term_hashes(pa.array(texts))
    lengths = np.diff(at)
    batch = search._segment(7, list(range(304)), [hashes], lengths)
    rows = batch.to_pylist()
    assert rows[0]["term"] is None and rows[0]["doc_ids"] == list(range(304)) and rows[0]["n"] == 304
    scores = search._Scores(303, int(lengths.sum()))
    (own, *_), = search._query_terms(["a"])
    held = next(search._List(r["postings"], r["directory"], scores) for r in rows if r["term"] == own)
    docs, frequency = held.blocks(np.arange(len(held.last)))
    assert docs.tolist() == [0, *range(4, 304)] and frequency.tolist() == [6] + [1] * 300
    assert len(held.last) == 3 and held.bound == held.most[0]


def test_odd_documents(spark, small):
    same = "words of one rank " * 4
    docs = odd_documents(spark, [(100 + i, same, "en", "a") for i in range(50)] + [(None, same, "en", "a")] * 3)
    items = [(1, "the same words"), (2, None), (3, ""), (4, "nowhere-to-be-found-x"), (5, "one one ONE rank émoji"),
             (5, "one one ONE rank émoji"), (None, "ids w7x w7x"), (7, "İ \U0001f600 7")]
    built = Scratch(spark, "test").table(search.index(docs.repartition(3)), "index")
    found = search.search(built, items_of(spark, [(i, t, 0, "x") for i, t in items]), queries=3)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(found) == ranked([(r["doc_id"], r["text"]) for r in docs.collect()], items)


@pytest.mark.parametrize("kept", [1, 20])
def test_driver_documents(spark, small, kept):
    docs, items = documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    found = search.search_documents(docs.select("doc_id", "text"), items, kept=kept)
    assert rows_of(found) == ranked([(r["doc_id"], r["text"]) for r in docs.collect()],
                                    [tuple(r) for r in items.select("item_id", "text").collect()], kept)


def test_blocks_are_rejected_before_they_are_read():
    """One document has the rare term, every one the common one: only the block beside the rare term is read."""
    texts = ["common filler"] * 4000
    texts[1700] = "common rare"
    parts = list(search.term_hashes(pa.array(texts)))
    lengths = np.concatenate([np.diff(at) for *_, at in parts])
    batch = search._segment(0, list(range(4000)), [h for _, _, h, _ in parts], lengths)
    scores = search._Scores(4000, int(lengths.sum()))
    held = {r["term"]: (r["postings"], r["directory"]) for r in batch.to_pylist() if r["term"] is not None}
    query, = search._query_terms(["common rare"])
    opened = {t: search._List(*held[t], scores) for t in query}
    lists = sorted(((1000 if len(x.last) == 1 else 1, x) for x in opened.values()), key=lambda x: x[0] * x[1].bound)
    best = search._Best(1)
    ids, nulls = np.arange(4000), np.zeros(4000, bool)
    best.add(np.array([lists[0][1].bound + 1]), np.array([-1]), np.array([False]))
    search._search_range(lists, 0, 4000, scores.norm(lengths), best, ids, nulls)
    assert best.ids.tolist() == [1700]
    assert list(lists[0][1].read) == [1700 // search.BLOCK] and len(lists[0][1].last) == 32


def test_no_documents_and_no_items(spark):
    docs, items = documents(spark).select("doc_id", "text"), spark.read.parquet(f"{SF}/benchmark.parquet")
    assert search.search_documents(docs.limit(0), items).count() == 0
    assert search.search_documents(docs, items.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "-")], "doc_id long, text string")
    assert search.search_documents(blank, items).count() == 0
