"""Spelling variants against their definition, and the gram bounds against all edits."""

import itertools
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from colophon.llm import spelling
from colophon.session import Scratch
from helpers import documents, odd_documents

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(docs):
    found = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            found[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: n for w, n in found.items() if n >= 3 and len(w) >= 5}


def near_pairs(words):
    cut = {}
    for w in words:
        for i in range(len(w)):
            cut.setdefault((i, w[:i] + w[i + 1:]), []).append(w)
    pairs = set()
    for (_, rest), same in cut.items():
        pairs.update(itertools.permutations(same, 2))
        if rest in words:
            pairs.update(p for w in same for p in ((w, rest), (rest, w)))
    return pairs


def variants_of(words):
    near = {}
    for a, b in near_pairs(words):
        near.setdefault(a, []).append(b)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o))
        if words[best] >= 2 * words[w]:
            form[w] = best
    rows = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.add((w, form.get(w), root, n, len(near.get(w, [])), words[form[w]] if w in form else None))
    return rows


def rows_of(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def table(spark, words):
    return Scratch(spark, "test").table(
        spark.createDataFrame(list(words.items()), "word string, n long").repartition(3), "words")


def made_words(seed, n=3000):
    """Words over few letters, so that most have neighbours; some long, some of one letter."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(5, 9))) for _ in range(n)}
    long = "".join(rng.choice("abcdefghij") for _ in range(300))
    words |= {long, long[1:], long[:-1], long[:150] + long[151:], "x" + long, long[:7] + "z" + long[8:], "a" * 30, "a" * 31, "a" * 32}
    return {w: i % 11 + 3 for i, w in enumerate(sorted(words))}


@pytest.mark.parametrize("limits", [{}, {"frequent": 1}, {"frequent": 3, "size": 40}, {"frequent": 2, "common": 0},
                                    {"frequent": 10, "size": 30, "common": 20}])
def test_all_near_words_are_found(spark, limits):
    words = made_words(len(limits))
    found = [tuple(r) for r in spelling.near_words(table(spark, words), **limits).collect()]
    assert len(found) == len(set(found))
    assert {(a, b) for a, b, _ in found} == near_pairs(words)
    assert all(n == words[b] for _, b, n in found)


def test_lists_in_any_order_tell_a_pair_once():
    """Two lists that hold the same words, arrived in different orders, as from several executors."""
    rows = [("a", False, "abcde", 4), ("a", False, "abcdf", 3), ("b", False, "abcdf", 3), ("b", False, "abcde", 4),
            ("b", True, "abcdee", 5)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["key", "longer", "word", "n"])
    told = [tuple(r.values()) for b in spelling._merged(iter([batch])) for r in b.to_pylist()]
    assert set(told) == {("abcde", 4, "abcdf", 3), ("abcde", 4, "abcdee", 5)}


@pytest.mark.parametrize("frequent", [set(), {"ab", "ba", "aba"}, {"".join(p) for q in range(2, 6) for p in itertools.product("ab", repeat=q)}])
def test_an_edit_leaves_the_promised_grams(frequent):
    counts = {g: 5 for g in frequent}
    rng = random.Random(3)
    for _ in range(300):
        word = "".join(rng.choice("ab") for _ in range(rng.randint(5, 40)))
        i = rng.randrange(len(word))
        for other, kind in ((word[:i] + "c" + word[i + 1:], len(word)), (word[:i] + rng.choice("abc") + word[i:], len(word))):
            own, affected = spelling.decomposed(word, kind, counts)
            others, other_affected = spelling.decomposed(other, kind, counts)
            shared = len({g[1] for g in own} & {g[1] for g in others})
            assert shared >= max(len(own) - affected, len(others) - other_affected) >= 3


def test_driver_documents(spark):
    docs = documents(spark)
    assert rows_of(spelling.variants(docs)) == variants_of(counted(
        [(r["doc_id"], r["text"]) for r in docs.collect()]))


def test_odd_documents(spark):
    chain = "chains " * 40 + "chainz " * 20 + "chaint " * 9 + "chaing " * 4 + "cchainz " * 10 + "cchaint " * 5
    docs = odd_documents(spark, [(50, chain, "en", "a"), (None, "Größe größe GRößE groß ÷×ÀÿÀÿ ", "de", "a"), (51, "÷×ÀÿÀÿ÷×àÿàÿ" * 4, "de", "a"),
                                 (52, "x" * 2000 + " " + "x" * 1999, "en", "a")] * 3)
    docs = docs.unionByName(docs)
    want = variants_of(counted([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert rows_of(spelling.variants(docs)) == want
    assert any(form not in (None, root) for _, form, root, *_ in want)


def test_every_slip_place(spark):
    """A deleted character can be the first, the last, or leave too short a word."""
    docs = [(i, "abcdef vwxyz " * 3) for i in range(600)]
    assert any(zlib.crc32(f"{i}:abcdef".encode()) % 97 == 0 for i, _ in docs)
    got = {r["word"]: r["n"] for r in spelling.words_of(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == counted(docs)


def test_no_words(spark):
    empty = documents(spark).limit(0)
    assert spelling.variants(empty).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (2, "rare words")], "doc_id long, text string")).count() == 0


def test_very_long_words(spark):
    a = "ab" * 100_000
    words = {a: 3, a[1:]: 4, a + "a": 5, a[:90_000] + "x" + a[90_001:]: 6, "b" + a: 7}
    found = {(r["word"], r["near"]) for r in spelling.near_words(table(spark, words)).collect()}
    assert found >= {(a, a[1:]), (a, a + "a"), (a, a[:90_000] + "x" + a[90_001:]), (a, "b" + a)}
    assert all(abs(len(x) - len(y)) <= 1 for x, y in found)
