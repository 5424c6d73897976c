"""Ranked lexical search with Block-Max MaxScore over a segmented inverted index.

The index is a table. A segment holds some thousand documents: a row without a term has their ids and
lengths, and every other row is the posting list of one term in the segment. A list is cut into
blocks of 128 postings, each compressed by itself, and a small directory keeps every block's last
document, end, largest frequency and shortest document.

A query's terms in a segment are sorted by the most they can add. As long as the terms at the low end
together stay below the score that the query's last kept document has, a document that has none of
the others cannot be kept, so only the others' lists (the essential ones) are read for candidates. The
low terms are then taken from the largest down: a block's maximum and the bounds of the terms still to
come reject candidates before the block is decompressed. Every task keeps the best documents of each
query over all its segments, and these short lists are merged.

Terms are told apart by 64-bit hashes. Scores are whole numbers and exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from colophon.llm import arrays
from colophon.llm.columns import narrow
from colophon.session import Scratch

KEPT = 20
BLOCK = 128
# A segment ends after so many terms or documents; one longer document is a segment.
SEGMENT_TERMS, SEGMENT_DOCS = 3_000_000, 20_000
# Documents whose scores are held at a time.
RANGE = 4096
# Queries that one pass over the index answers.
QUERIES = 1024
INDEX = "segment long, term long, n long, postings binary, directory binary, doc_ids array<long>, lengths binary"

# What a byte stands for: letters A-Z lower-cased, other ASCII letters, digits and all beyond ASCII as they
# are, and anything else a space.
_TERMS = np.full(256, 0x20, np.uint8)
for _low, _high, _shift in ((0x30, 0x3A, 0), (0x41, 0x5B, 0x20), (0x61, 0x7B, 0), (0x80, 0x100, 0)):
    _TERMS[_low:_high] = np.arange(_low, _high) + _shift


def term_hashes(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, term hashes, offsets of the rows)``, block by block."""
    data, offsets = arrays.text_buffers(texts)
    return arrays.hashed_words(_TERMS[data], offsets)


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2**35 as bytes of seven bits, the last of each below 128, and every number's end."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28):
        sizes += values >= np.uint64(1 << bits)
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(5):
        has = sizes > k
        digit = (values[has] >> np.uint64(7 * k)) & np.uint64(127)
        out[ends[has] - sizes[has] + k] = digit + np.where(sizes[has] > k + 1, 128, 0).astype(np.uint64)
    return out, ends


def unpacked(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data < 128)
    starts = np.r_[0, last[:-1] + 1]
    place = np.arange(len(data)) - np.repeat(starts, last - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts) if len(data) else np.zeros(0, np.int64)


def _segment(number: int, doc_ids: list, hashes: list[np.ndarray], lengths: np.ndarray) -> pa.RecordBatch:
    """The rows of one segment: its documents, then the lists of its terms in ascending order."""
    terms = np.concatenate([*hashes, np.zeros(0, np.uint64)]).view(np.int64)
    docs = np.repeat(np.arange(len(lengths)), lengths)
    order = np.argsort(terms, kind="stable")
    terms, docs = terms[order], docs[order]
    # Runs of the same term and document are postings, runs of the same term are lists.
    new_term = np.r_[True, terms[1:] != terms[:-1]][:len(terms)]
    starts = np.flatnonzero(new_term | np.r_[True, docs[1:] != docs[:-1]][:len(terms)])
    frequency = np.diff(np.r_[starts, len(terms)])
    docs, first = docs[starts], np.flatnonzero(new_term[starts])
    terms = terms[starts][first]
    sizes = np.diff(np.r_[first, len(docs)])
    place = np.arange(len(docs)) - np.repeat(first, sizes)
    block = np.flatnonzero(place % BLOCK == 0)
    step = np.r_[0, np.diff(docs)][:len(docs)]
    step[block] = docs[block]
    values = np.empty(2 * len(docs), np.int64)
    values[0::2], values[1::2] = step, frequency - 1
    data, ends = packed(values)
    ends = ends[1::2]
    block_end = np.r_[block[1:], len(docs)] - 1
    list_of = np.searchsorted(first, block, side="right") - 1
    from_byte = np.r_[0, ends][first] if len(first) else np.zeros(0, np.int64)
    directory = np.stack([
        docs[block_end], ends[block_end] - from_byte[list_of],
        np.maximum.reduceat(frequency, block), np.minimum.reduceat(lengths[docs], block)], axis=1) if len(block) else np.zeros((0, 4))
    blocks = np.searchsorted(list_of, np.arange(len(first) + 1))

    def binary(content: bytes, bounds: np.ndarray) -> pa.Array:
        """One value per list, after an empty one for the segment's own row."""
        return pa.Array.from_buffers(pa.binary(), len(bounds), [
            None, pa.py_buffer(np.r_[0, bounds].astype(np.int32).tobytes()), pa.py_buffer(content)])

    lists = len(first)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(lists + 1, number)),
        pa.array(np.r_[0, terms], mask=np.arange(lists + 1) == 0),
        pa.array(np.r_[len(lengths), sizes]),
        binary(data.tobytes(), np.r_[from_byte, len(data)]),
        binary(directory.astype("<i4").tobytes(), 16 * blocks),
        pa.array([doc_ids] + [None] * lists, pa.list_(pa.int64())),
        pa.array([lengths.astype("<i8").tobytes()] + [None] * lists, pa.binary()),
    ], names=["segment", "term", "n", "postings", "directory", "doc_ids", "lengths"])


def index(docs: DataFrame) -> DataFrame:
    """The inverted index of all rows, see ``INDEX``; write it before it is searched.

    A null text has no term. Rows without ``doc_id`` and repeated rows are documents as well.
    """
    docs = narrow(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        doc_ids, hashes, lengths = [], [], []
        for batch in arrays.batches_of(batches):
            ids = batch.column("doc_id").to_pylist()
            for row, end, found, at in term_hashes(batch.column("text")):
                if doc_ids and (sum(map(len, hashes)) + len(found) > SEGMENT_TERMS or len(doc_ids) + end - row > SEGMENT_DOCS):
                    yield _segment(number, doc_ids, hashes, np.concatenate(lengths))
                    number, doc_ids, hashes, lengths = number + 1, [], [], []
                doc_ids += ids[row:end]
                hashes.append(found)
                lengths.append(np.diff(at))
        if doc_ids:
            yield _segment(number, doc_ids, hashes, np.concatenate(lengths))

    return docs.mapInArrow(run, INDEX)


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class _Scores:
    """What a term adds to a document's score."""

    def __init__(self, documents: int, terms: int):
        self.documents, self.terms = documents, max(terms, 1)

    def norm(self, length: np.ndarray) -> np.ndarray:
        return 75 + (25 * length * self.documents) // self.terms

    @staticmethod
    def part(frequency: np.ndarray, norm: np.ndarray) -> np.ndarray:
        return (1_000_000_000 * frequency) // (1000 * frequency + 12 * norm)


class _List:
    """A posting list of a segment, read by blocks."""

    def __init__(self, postings: bytes, directory: bytes, scores: _Scores):
        self.data = np.frombuffer(postings, np.uint8)
        table = np.frombuffer(directory, "<i4").reshape(-1, 4).astype(np.int64)
        self.last, self.end = table[:, 0], table[:, 1]
        self.begin = np.r_[0, self.end[:-1]]
        self.most = scores.part(table[:, 2], scores.norm(table[:, 3]))
        self.bound = int(self.most.max())
        self.read: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and frequencies of a block; kept for the other queries of the segment."""
        if number not in self.read:
            values = unpacked(self.data[self.begin[number]:self.end[number]])
            self.read[number] = np.cumsum(values[0::2]), values[1::2] + 1
        return self.read[number]

    def blocks(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [self.block(b) for b in numbers.tolist()]
        if len(found) == 1:
            return found[0]
        return np.concatenate([d for d, _ in found]), np.concatenate([f for _, f in found])


class _Best:
    """The best documents of one query so far: highest score, then smallest id, ids that are null last."""

    def __init__(self, kept: int):
        self.kept = kept
        self.scores, self.ids, self.nulls = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """No document with a lower score can be kept."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.kept else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        self.scores, self.ids, self.nulls = (np.r_[a, b] for a, b in (
            (self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
        order = np.lexsort((self.ids, self.nulls, -self.scores))[:self.kept]
        self.scores, self.ids, self.nulls = self.scores[order], self.ids[order], self.nulls[order]


def _search_range(lists: list[tuple[int, _List]], low: int, high: int, norms: np.ndarray, best: _Best,
                  ids: np.ndarray, nulls: np.ndarray) -> None:
    """Score the documents from ``low`` to ``high``. ``lists`` are (weight, list) by ascending bound."""
    bounds = np.cumsum([w * held.bound for w, held in lists])
    least = best.least
    first = int(np.searchsorted(bounds, least, side="left"))  # the lists before it stay below together
    score = np.zeros(high - low, np.int64)
    for w, held in lists[first:]:
        numbers = np.arange(np.searchsorted(held.last, low), min(np.searchsorted(held.last, high - 1) + 1, len(held.last)))
        if not len(numbers):
            continue
        docs, frequency = held.blocks(numbers)
        if docs[0] < low or docs[-1] >= high:
            inside = slice(*np.searchsorted(docs, (low, high)))
            docs, frequency = docs[inside], frequency[inside]
        score[docs - low] += w * _Scores.part(frequency, norms[docs])
    found = np.flatnonzero(score)
    for k in range(first - 1, -1, -1):
        w, held = lists[k]
        if not len(found):
            return
        below = int(bounds[k - 1]) if k else 0
        number = np.searchsorted(held.last, found + low)
        there = number < len(held.last)
        most = np.where(there, w * held.most[np.minimum(number, len(held.last) - 1)], 0)
        alive = score[found] + most + below >= least
        found, number, there = found[alive], number[alive], there[alive]
        wanted = np.unique(number[there])
        if not len(wanted):
            continue
        docs, frequency = held.blocks(wanted)
        at = np.minimum(np.searchsorted(docs, found + low), len(docs) - 1)
        hit = docs[at] == found + low
        score[found[hit]] += w * _Scores.part(frequency[at[hit]], norms[found[hit] + low])
    found = found[score[found] >= least]
    if len(found):
        best.add(score[found], ids[found + low], nulls[found + low])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, dict[int, tuple[bytes, bytes]]]]:
    """The segments of a task whose rows are ordered by segment, each with its own row first."""
    header, lists = None, {}
    for batch in arrays.batches_of(batches):
        terms, postings, directory = (batch.column(c) for c in ("term", "postings", "directory"))
        for i, term in enumerate(terms.to_pylist()):
            if term is None:
                if header is not None:
                    yield header, lists
                header, lists = batch.slice(i, 1), {}
            else:
                lists[term] = postings[i].as_py(), directory[i].as_py()
    if header is not None:
        yield header, lists


def _query_terms(items: list[str | None]) -> list[Counter]:
    found: list[Counter] = []
    for row, end, hashes, at in term_hashes(pa.array(items, pa.large_string())):
        found += [Counter(hashes[at[r]:at[r + 1]].view(np.int64).tolist()) for r in range(end - row)]
    return found


def _answer(built: DataFrame, items: list[tuple[int, str | None]], stats: tuple[int, int], kept: int) -> DataFrame:
    """The best documents of every task for some queries: ``number, score, doc_id``."""
    queries = _query_terms([text for _, text in items])
    wanted = sorted({t for q in queries for t in q})
    terms = built.sparkSession.createDataFrame(pa.table({"term": pa.array(wanted, pa.int64())}))
    lists = built.filter("term is not null").join(F.broadcast(terms), "term", "left_semi")
    df = {r["term"]: r["df"] for r in lists.groupBy("term").agg(F.sum("n").alias("df")).collect()}
    weights = {t: weight(stats[0], n) for t, n in df.items()}
    numbers = [n for n, _ in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _Scores(*stats)
        best = [_Best(kept) for _ in queries]
        for header, held in _segments(batches):
            ids = header.column("doc_ids")[0].values
            nulls = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            norms = scores.norm(np.frombuffer(header.column("lengths")[0].as_py(), "<i8"))
            opened = {t: _List(*held[t], scores) for t in held}
            for query, own in zip(queries, best):
                lists = [(n * weights[t], opened[t]) for t, n in query.items() if t in opened and weights[t]]
                lists.sort(key=lambda x: x[0] * x[1].bound)
                for low in range(0, len(norms) if lists else 0, RANGE):
                    _search_range(lists, low, min(low + RANGE, len(norms)), norms, own, ids, nulls)
        for number, own in zip(numbers, best):
            if len(own.scores):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(own.scores), number)), pa.array(own.scores),
                    pa.array(own.ids, mask=own.nulls)], names=["number", "score", "doc_id"])

    chosen = lists.select("segment", "term", "postings", "directory", F.lit(None).cast("array<long>").alias("doc_ids"),
                          F.lit(None).cast("binary").alias("lengths")).unionByName(
        built.filter("term is null").select("segment", "term", "postings", "directory", "doc_ids", "lengths"))
    ordered = chosen.repartition("segment").sortWithinPartitions("segment", F.col("term").asc_nulls_first())
    return ordered.mapInArrow(run, "number long, score long, doc_id long")


def search(built: DataFrame, items: DataFrame, kept: int = KEPT, queries: int = QUERIES) -> DataFrame:
    """The ``kept`` best documents of every item: ``item_id, rank, doc_id, score``.

    ``built`` is a written index. Items are a table of queries (``item_id, text``), read by the driver in
    blocks of ``queries``; repeated items are answered each. An item without a term that some document
    has, and one whose text is null, has no rows. Documents of equal score stand by ascending ``doc_id``,
    those without one last; repeated rows of a document take a rank each.
    """
    spark = built.sparkSession
    head = built.filter("term is null")
    totals = head.select(F.col("lengths")).mapInArrow(_counted, "documents long, terms long").agg(
        F.sum("documents").alias("documents"), F.sum("terms").alias("terms")).first()
    stats = (totals["documents"] or 0, totals["terms"] or 0)
    asked = Scratch(spark, "search").table(narrow(items, "item_id", "text"), "items")
    ids, parts, block = [], [], []
    for row in asked.toLocalIterator():
        block.append((len(ids), row["text"]))
        ids.append(row["item_id"])
        if len(block) == queries:
            parts.append(_answer(built, block, stats, kept))
            block = []
    if block or not parts:
        parts.append(_answer(built, block, stats, kept))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    by_item = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(by_item)).filter(F.col("rank") <= kept)
    names = spark.createDataFrame(pa.table({
        "number": pa.array(range(len(ids)), pa.int64()), "item_id": pa.array(ids, pa.int64())}))
    return ranked.join(F.broadcast(names), "number").select("item_id", "rank", "doc_id", "score")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that have a term, and all their terms."""
    for batch in batches:
        lengths = [np.frombuffer(x, "<i8") for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([
            pa.array([int((x > 0).sum()) for x in lengths], pa.int64()),
            pa.array([int(x.sum()) for x in lengths], pa.int64())], names=["documents", "terms"])


def search_documents(docs: DataFrame, items: DataFrame, kept: int = KEPT) -> DataFrame:
    """Index all rows of ``docs`` and rank them for every item."""
    scratch = Scratch(docs.sparkSession, "search")
    return search(scratch.table(index(docs), "index"), items, kept)
