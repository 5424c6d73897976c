import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from helpers import documents, odd_documents
from tokenizers import Tokenizer

from colophon.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["don't İ ﬁ Ǆ  ### á \x00 ​ x1y2 rock'select it's 'S 'LL", "a b c ΑΣ ας Σ", "é É ẛ̣ é",
       "<|endoftext|>x<|startoftext|> <|x|>", "日本語テキスト 한국어", "x" * 5000 + " " + "ab12" * 100, "\u0085a\x1fb",
       "½²ªº µ × ÷ ß ẞ ÿ Ÿ", "'" * 40, "''''s't're", "😀👨‍👩", "3'd5'll", " ", ""]


@pytest.fixture(scope="module")
def merges():
    return bpe.Merges(PATH)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def random_words(n):
    rng = random.Random(3)
    alphabet = "abcXYZ'sd12.,-éÀßÿ×<|>́İ日#&"
    return list(dict.fromkeys("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(n)))


def test_words_merge_as_the_library_does(merges, tokenizer):
    words = random_words(4000)
    for word, ids in zip(words, merges.encode_words([w.encode() for w in words])):
        assert ids.tolist() == tokenizer.encode(word, add_special_tokens=False).ids, word


def test_automaton_is_minimal_and_numbers_its_words():
    words = sorted({w.encode() for w in random_words(3000)} | {b"a", b"ab", b"walking", b"talking"})
    made = bpe.minimal_automaton(words)
    for n, word in enumerate(words):
        state, total = len(made["base"]) - 1, 0
        for c in word:
            slot = made["base"][state] + c
            assert made["check"][slot] == state
            state, total = made["target"][slot], total + made["add"][slot]
        assert made["final"][state] and total == n
    # Equal suffixes are one: no two states have the same ends and edges.
    edges = {}
    for slot, state in enumerate(made["check"]):
        if state >= 0:
            edges.setdefault(int(state), []).append((slot - int(made["base"][state]), int(made["target"][slot])))
    kinds = [(int(made["final"][s]), tuple(edges.get(s, []))) for s in range(len(made["base"]))]
    assert len(set(kinds)) == len(kinds)


@pytest.mark.parametrize("words", [0, 5, 20_000])
def test_texts_round_trip(spark, tokenizer, words):
    df = odd_documents(spark, [(500 + i, t, "en", "a") for i, t in enumerate(ODD)]).union(
        odd_documents(spark).limit(0)).select("doc_id", "text", "n_words")
    texts = df.collect()
    got = bpe.encode(df, PATH, words).collect()
    want = []
    for row in texts:
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids
        want.append((str(row["doc_id"]), np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False)))
    assert sorted((str(r["doc_id"]), bytes(r["ids"]), r["decoded"]) for r in got) == sorted(want)


def test_query(spark, tokenizer):
    got = {r["doc_id"]: r for r in queries.op6_bpe_codec(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    for row in docs:
        ids = tokenizer.encode(row["text"], add_special_tokens=False).ids
        own = got[row["doc_id"]]
        assert own["n_tokens"] == len(ids)
        assert own["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert own["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_nothing_is_kept_between_blocks(spark, tokenizer, merges, tmp_path):
    (tmp_path / "lexicon").write_bytes(bpe.compiled([b"the", b"words,"], merges))
    encoder = bpe.Encoder(PATH, str(tmp_path / "lexicon"))
    held = {name: id(value) for name, value in vars(encoder).items()}
    for n in range(3):
        texts = [f"the words, {' '.join(random_words(50 + n))}", None, "", "new" * 20, "the"]
        for row, end, ids, at in encoder.encode(pa.array(texts)):
            for r in range(row, end):
                want = tokenizer.encode(texts[r] or "", add_special_tokens=False).ids
                assert ids[at[r - row]:at[r - row + 1]].tolist() == want
    assert {name: id(value) for name, value in vars(encoder).items()} == held


def test_the_tokenizer_is_opened_only_for_words_that_need_it(merges):
    fresh = bpe.Merges(PATH, merges.parts)
    fresh.encode_words([w.encode() for w in ("Don't", "l'été", "x1y2!?", "''s", "a" * 32)])
    assert fresh._tokenizer is None
    fresh.encode_words(["日本".encode()])
    assert fresh._tokenizer is not None

def test_empty(spark):
    assert bpe.encode(documents(spark).limit(0), PATH).count() == 0
