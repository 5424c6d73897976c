import __spark_entry__ as entry
import corpus_pipeline
import pytest
from helpers import odd_documents
from test_jaccard_join import brute as classes
from test_native import base_spans
from test_packing import check_pieces, check_places
from test_substring_dedup import brute as cut

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage was given, and what it made of it, as rows by id."""
    from colophon.session import Scratch
    scratch = Scratch(spark, "stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        docs = scratch.table(stage(spark, docs, SF), f"s{n}")
        found.append((name, before, docs))
    return found


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_names_order_and_columns(stages):
    assert [name for name, _, _ in stages] == [
        "language ID", "n-gram Jaccard join", "substring dedup", "secret scans", "best-fit packing"]
    assert all(out.columns == COLUMNS for _, _, out in stages[:-1])
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_language_stage_keeps_clean_documents(stages):
    _, before, out = stages[0]
    kept, given = by_id(out.collect()), by_id(before)
    assert all(kept[d] == given[d] for d in kept)
    gone = [r for d, r in given.items() if d not in kept]
    assert len(gone) < 0.01 * len(given)


def test_one_of_each_group_stays(stages):
    _, before, out = stages[1]
    want = {d for d, first, _, _ in classes([(r["doc_id"], r["text"]) for r in before]) if d == first}
    kept = by_id(out.collect())
    assert set(kept) == want
    assert all(kept[d] == r for d, r in by_id(before).items() if d in want)


def test_repeated_passages_go(stages):
    _, before, out = stages[2]
    kept, given = by_id(out.collect()), by_id(before)
    for doc_id, n_words, n_removed, text in cut([(r["doc_id"], r["text"]) for r in before]):
        if n_removed == 0:
            assert kept[doc_id] == given[doc_id]
        elif n_removed == n_words:
            assert doc_id not in kept
        else:
            assert kept[doc_id]["text"] == text and kept[doc_id]["n_chars"] == len(text)


def test_secrets_are_masked(stages):
    _, before, out = stages[3]
    kept, given = by_id(out.collect()), by_id(before)
    assert set(kept) == set(given)
    masked = {d for d in kept if kept[d]["text"] != given[d]["text"]}
    assert masked >= {d for d, r in given.items() if base_spans(r["text"])} and masked
    assert not any(base_spans(r["text"]) for r in kept.values())
    assert all(kept[d]["n_chars"] == len(kept[d]["text"]) for d in masked)


def test_pieces_are_packed(stages):
    _, before, out = stages[4]
    rows = out.collect()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in before])
    assert check_places(rows) <= 1.01 * sum(r["length"] for r in rows) / 2048 + 2


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    want = stages[4][2].select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert sorted(got) == sorted(want)


def test_odd_cases(spark):
    docs = odd_documents(spark).select(*COLUMNS)
    for df in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == COLUMNS and out.count() <= df.count()
