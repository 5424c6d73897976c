"""Labels beyond any fixed number are learned, and matched across blocks."""

import random

from colophon.llm import language


def made(spark, labels, each):
    rows = []
    for k in range(labels):
        rng = random.Random(k)
        letters = rng.sample("abcdefghijklmnopqrstuvwxyz", 9)
        words = ["".join(rng.choices(letters, k=5)) for _ in range(25)]
        # Later labels are rarer.
        rows += [(k * 100 + j, " ".join(rng.choices(words, k=60)), f"l{k:03d}") for j in range(each + (k < 256))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_rare_labels_are_learned(spark):
    docs = made(spark, 300, 2)
    got = language.classify(docs, language.train(docs)).collect()
    assert len(got) == docs.count()
    assert {r["lang"] for r in got} == {r["lang_pred"] for r in got}
    assert all(r["lang"] == r["lang_pred"] and not r["rejected"] for r in got)


def test_blocks_do_not_change_results(spark, monkeypatch):
    docs = made(spark, 9, 3)
    want = language.classify(docs, language.train(docs)).collect()
    monkeypatch.setattr(language, "BLOCK_LABELS", 2)
    model = language.train(docs)
    assert len(model.blocks) == 5
    got = language.classify(docs, model).collect()
    assert [(r["doc_id"], r["lang_pred"], round(r["score"], 5), r["rejected"]) for r in sorted(got)] == [
        (r["doc_id"], r["lang_pred"], round(r["score"], 5), r["rejected"]) for r in sorted(want)]


def test_labels_are_learned_without_a_broadcast(spark, shuffles_only):
    docs = made(spark, 12, 3)
    assert all(r["lang"] == r["lang_pred"] for r in language.classify(docs, language.train(docs)).collect())
