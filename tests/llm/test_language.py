import zlib

import numpy as np
from helpers import documents, odd_documents

from colophon.llm import language, queries


def test_held_out_accuracy(spark):
    got = queries.op8_language_id(spark, "/root/testdata/sf0.1").join(
        spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang", "text"), "doc_id")
    rows = [r for r in got.collect() if r["held_out"]]
    right = np.mean([r["lang"] == r["lang_pred"] for r in rows])
    rejected = np.mean([r["rejected"] for r in rows])
    assert len(rows) > 2000 and right > 0.97
    assert rejected < 0.01
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) == r["held_out"] for r in got.collect())
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_cases(spark):
    model = language.train(documents(spark))
    df = odd_documents(spark, [(50, "12 + 34 = 46 !!", "en", "a")])
    got = language.classify(df, model).collect()
    assert len(got) == df.count()
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert letters or (r["score"] == 0 and r["rejected"])


def test_nothing_but_text_counts(spark):
    model = language.train(documents(spark))
    df = documents(spark).limit(50)
    plain = {r["doc_id"]: r["lang_pred"] for r in language.classify(df.select("doc_id", "text"), model).collect()}
    assert {r["doc_id"]: r["lang_pred"] for r in language.classify(df, model).collect()} == plain


def test_foreign_strings_are_rejected(spark):
    model = language.train(documents(spark))
    df = spark.createDataFrame([(1, "zqxjk vvkq xqzw jjqx wkzx qqvj kxkz vwqk zzjw qkqx jvxz " * 20), (2, "ゐゑヰヱ ヷヸ ぬねのはひふへほ まみむめも アイウエオ カキクケコ " * 30)], "doc_id long, text string")
    assert all(r["rejected"] for r in language.classify(df, model).collect())


def test_short_texts_are_not_rejected(spark):
    model = language.train(documents(spark))
    df = spark.createDataFrame([(1, "This."), (2, "A.\nAll rights reserved."), (3, "De.")], "doc_id long, text string")
    assert not any(r["rejected"] for r in language.classify(df, model).collect())


def test_several_centroids_per_language():
    rng = np.random.default_rng(0)
    points = np.abs(np.vstack([rng.normal(0, 0.05, (40, 8)) + np.eye(8)[i] for i in range(3)]))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centroids = language.spherical_kmeans(points, 3)
    assert sorted((points @ centroids.T).argmax(axis=1)[::40].tolist()) == [0, 1, 2]


def test_features_do_not_depend_on_blocks(monkeypatch):
    data = np.frombuffer(("Some text with ümläuts, " * 50).encode(), np.uint8)
    at = np.array([0, 100, 100, len(data)])
    whole = language._features(data, at)
    monkeypatch.setattr(language.arrays, "BLOCK", 37)
    assert (language._features(data, at) == whole).all()


def test_no_labels(spark):
    df = documents(spark).limit(5)
    for rows in (df.limit(0), df.withColumn("lang", language.F.lit(None).cast("string"))):
        model = language.train(rows)
        assert {r["lang_pred"] for r in language.classify(df, model).collect()} == {"und"}
    assert language.classify(df.limit(0), model).count() == 0
