import hashlib

import numpy as np
from helpers import documents, odd_documents, shingles

from colophon.llm import fingerprints
from colophon.llm.fingerprints import containment, decode, distinct, edited, merge, resemblance, sketch


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def followers(rows):
    """Each text with the next one in the order of the operator."""
    placed = sorted(((d, t or "") for d, t in rows if d is not None))
    out = [(d, t, placed[(i + 1) % len(placed)][1]) for i, (d, t) in enumerate(placed)]
    return out + [(None, t or "", t or "") for d, t in rows if d is None]


def compare(df, parts=None):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = fingerprints.fingerprints(df, parts).collect()
    want = followers(rows)
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited"]) for r in got) == sorted(
        (str(d), len(t), edited(t, after)) for d, t, after in want)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    for d, t, after in want:
        if len(by_id[d]) == 1 and d is not None:
            r = by_id[d][0]
            # Four standard deviations of an estimate from 128 values.
            assert abs(r["near_edited"] - jaccard(t, edited(t, after))) < 0.18
            assert abs(r["near_next"] - jaccard(t, after)) < 0.18
    return got, rows


def test_documents(spark):
    got, rows = compare(documents(spark))
    text = dict(rows)
    seen = {}
    for r in got:
        assert seen.setdefault(text[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        n = len(shingles(text[r["doc_id"]]))
        assert abs(r["n_shingles"] - n) <= (0 if n < 128 else 0.45 * n)


def test_odd_cases_in_any_number_of_parts(spark):
    for parts in (1, 3, 50):
        compare(odd_documents(spark), parts)


def test_lone_document_follows_itself(spark):
    compare(spark.createDataFrame([(4, "a b c d e f g h")], "doc_id long, text string"))


def test_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        compare(documents(spark).limit(150))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_parts_merge_to_the_whole():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, 900).astype(np.uint64), rng.integers(0, 2**63, 400).astype(np.uint64)
    assert (merge(sketch(a), sketch(b)) == sketch(np.r_[a, b, a])).all()
    crowded = np.r_[np.repeat(np.sort(a)[:3], 5000), a]
    assert (sketch(crowded) == np.unique(crowded)[:fingerprints.K]).all()
    assert (decode(fingerprints.encode(sketch(a))) == sketch(a)).all()


def test_estimates():
    rng = np.random.default_rng(2)
    both, one, two = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (6000, 2000, 4000))
    a, b = sketch(np.r_[both, one]), sketch(np.r_[both, two])
    assert abs(resemblance(a, b) - 0.5) < 0.18
    assert abs(containment(a, b) - 0.75) < 0.3
    assert abs(distinct(a) - 8000) < 3000
    empty = sketch(both[:0])
    assert resemblance(empty, empty) == 1 and resemblance(a, empty) == 0 and distinct(empty) == 0


def test_query_digest(spark):
    from colophon.llm import queries
    got = queries.op5_fingerprints(spark, "/root/testdata/sf0.001").collect()
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = {d: hashlib.sha256(edited(t, after).encode()).hexdigest() for d, t, after in followers(map(tuple, rows))}
    assert {r["doc_id"]: r["edited_sha256"] for r in got} == want


def test_empty(spark):
    assert fingerprints.fingerprints(documents(spark).limit(0)).count() == 0
