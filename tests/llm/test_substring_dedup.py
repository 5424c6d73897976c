from itertools import compress

from helpers import documents, odd_documents, words

from colophon.llm import substring_dedup
from colophon.llm.substring_dedup import COVER, PERIOD, WINDOW, dedup_substrings


def brute(rows):
    first = {}
    for doc_id, text in rows:
        w = words(text)
        for i in range(len(w) - WINDOW + 1):
            if doc_id is not None:
                key = tuple(w[i:i + WINDOW])
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = words(text)
        keep = [True] * len(w)
        for i in range(len(w) - WINDOW + 1):
            if doc_id is not None and first[tuple(w[i:i + WINDOW])] < doc_id:
                keep[i:i + WINDOW] = [False] * WINDOW
        out.append((doc_id, len(w), len(w) - sum(keep), " ".join(compress(w, keep))))
    return out


def key(row):
    return tuple(str(x) for x in row)


def compare(df):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = dedup_substrings(df, joined=True).select("doc_id", "n_words", "n_removed", "text").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def test_cover_reaches_every_shift():
    differences = {(a - b) % PERIOD for a in COVER for b in COVER}
    assert differences == set(range(PERIOD))


def test_documents(spark):
    compare(documents(spark))


def test_odd_cases(spark):
    compare(odd_documents(spark))


def test_shared_passages_at_any_shift(spark):
    passage = [f"p{i}" for i in range(WINDOW)]
    rows = []
    for shift in range(40):
        rows.append((shift, " ".join([f"d{shift}w{i}" for i in range(shift)] + passage + [f"e{shift}"])))
    rows += [(100 + k, " ".join(passage[:WINDOW - k] + ["x"] + passage)) for k in range(3)]
    compare(spark.createDataFrame(rows, "doc_id long, text string"))


def test_many_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        compare(documents(spark).limit(300))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_untouched_texts_and_columns_stay(spark):
    df = odd_documents(spark)
    got = dedup_substrings(df)
    assert [c for c in df.columns if c != "n_words"] + ["n_words", "n_removed"] == got.columns
    before = {(r["doc_id"], r["text"]) for r in df.collect()}
    assert all((r["doc_id"], r["text"]) in before for r in got.filter("n_removed = 0").collect())


def test_empty(spark):
    assert dedup_substrings(odd_documents(spark).limit(0)).count() == 0


def test_texts_move_once(spark):
    plan = dedup_substrings(documents(spark).select("doc_id", "text"), joined=True)
    assert substring_dedup.WINDOW == 50
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 4
