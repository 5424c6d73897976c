"""Small tables with the odd cases that every operator must take, and brute-force helpers."""

from __future__ import annotations

import re

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, words int, label double"
WORD = re.compile("[^\x20\x09-\x0d]+")


def odd_documents(spark, extra=()):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns with clashing names."""
    long_text = " ".join(f"w{i % 7919}x" for i in range(400_000))
    same = "the same words again and again " * 30
    rows = [
        (1, None, "en", "a"), (2, "", "en", None), (3, " \t\n\x0b ", None, "a"), (4, same, "en", "a"), (5, same, None, "b"),
        (6, same + " but not here", "de", "b"), (7, "one two three", "en", "b"), (8, long_text, "fr", "c"),
        (9, long_text + " end", "fr", "c"), (4, same, "en", "a"), (None, same, "en", "a"), (None, None, None, None),
        (10, "émoji 😀 naïve x " * 5, "fr", "a"), (-3, "negative ids are ids " * 20, "en", "a"), *extra]
    return spark.createDataFrame(
        [(d, t, lang, s, None if t is None else len(t), "clash", 7, 0.5) for d, t, lang, s in rows], SCHEMA)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return WORD.findall(text or "")


def shingles(text, n=5):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))}
