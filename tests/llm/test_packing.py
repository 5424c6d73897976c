import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import documents, odd_documents
from tokenizers import Tokenizer

from colophon.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_places(rows, capacity=2048):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def check_pieces(rows, texts):
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start:start + 2048], "<u4").tobytes()
            want.append((str(doc_id), piece, start, len(part) // 4, zlib.crc32(part)))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)


def test_documents(spark):
    df = documents(spark)
    rows = packing.pack_documents(df, PATH).collect()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])
    tokens = sum(r["length"] for r in rows)
    assert check_places(rows) <= 1.01 * tokens / 2048 + 2


def test_odd_cases(spark):
    df = odd_documents(spark)
    rows = packing.pack_documents(df, PATH).collect()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])
    check_places(rows)


def test_ids_can_be_had(spark):
    rows = packing.pack_documents(odd_documents(spark).filter("doc_id < 8"), PATH, with_ids=True).collect()
    assert all(len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)


@pytest.mark.parametrize("kind", ["spread", "equal", "pairs", "large", "small", "one", "none", "all lengths"])
def test_plans_place_every_piece_once(kind):
    rng = np.random.default_rng(5)
    counts = np.zeros(2049, np.int64)
    lengths = {
        "spread": rng.lognormal(5.5, 1.1, 20_000).astype(int) % 2048 + 1, "equal": np.full(5000, 700),
        "pairs": np.r_[np.full(999, 1025), np.full(1200, 1023)], "large": rng.integers(1100, 2049, 3000),
        "small": rng.integers(1, 90, 7000), "one": np.array([2048]), "none": np.array([], int),
        "all lengths": np.repeat(np.arange(1, 2049), 3)}[kind]
    np.add.at(counts, lengths, 1)
    runs, sequences = packing.plan(counts)
    held, used = {}, {n: [] for n in range(2049)}
    for length, low, high, sequence, offset in runs:
        used[length].append((low, high))
        for k in range(high - low):
            held.setdefault(sequence + k, []).append((offset, length))
    for n, ranges in used.items():
        at = 0
        for low, high in sorted(ranges):
            assert low == at < high
            at = high
        assert at == counts[n]
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(held) == list(range(sequences))
    least = max(-(-int(lengths.sum()) // 2048), int((lengths > 1024).sum()))
    assert sequences <= least * (1.47 if kind == "equal" else 1.02) + 2
    assert len(runs) < 40_000


def test_configurations_meet_the_demand():
    sizes, demand = np.array([300, 200, 90, 70]), np.array([40.0, 60.0, 100.0, 10.0])
    found = packing.configurations(sizes, demand, 512)
    assert np.allclose(sum(use * pattern for pattern, use in found), demand)
    assert all(pattern @ sizes <= 512 for pattern, _ in found)


def test_empty(spark):
    assert packing.pack_documents(documents(spark).limit(0), PATH).count() == 0
