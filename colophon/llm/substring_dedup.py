"""Removal of word sequences that an earlier document already has.

A window is ``n`` consecutive words. Hashing every window of every text would move several rows per
line of text, so shared text is found by difference-cover anchors first: shorter windows that
start at a few residues modulo a period. Of any two equal windows of ``n`` words, some shift within
the period puts both on such a residue, so they share an anchor. Only windows around shared
anchors are hashed and compared ("extended"), each with the smallest ``doc_id`` that has it.

Groups may be large: every task first settles what its own batch decides and passes on one row
per hash and batch, so a hash that all documents share costs as many rows as there are batches.
A verdict depends on ``doc_id`` and the hash alone, so nothing but these travels, and the texts are
shuffled once, by ``doc_id``; both later reads of them reuse that exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from colophon.llm import arrays

WINDOW = 50
PERIOD = 31
# A perfect difference set, every difference modulo 31 is one of two members.
COVER = [0, 1, 3, 8, 12, 18]
HASHES = "h long, doc_id long, known boolean"
_SLICE = 1 << 17


def _anchors(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, item, row and place of every anchor in the rows that hold a window at all."""
    size = WINDOW - PERIOD + 1
    items, rows, places = arrays.window_places(at, size)
    wanted = np.zeros(PERIOD, bool)
    wanted[COVER] = True
    keep = wanted[places % PERIOD] & (np.diff(at)[rows] >= WINDOW)
    items, rows, places = items[keep], rows[keep], places[keep]
    return arrays.window_hashes(hashes, size)[items], items, rows, places


def _windows(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    items, rows, _ = arrays.window_places(at, WINDOW)
    return arrays.window_hashes(hashes, WINDOW)[items], items, rows


def _settled(h: np.ndarray, doc: np.ndarray, first_too: bool) -> Iterator[pa.RecordBatch]:
    """One row ``known = false`` per hash, of its smallest document. The rows that this batch
    settles are ``known = true``: the later documents of a hash, with ``first_too`` all of them."""
    if not len(h):
        return
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    new = np.r_[True, h[1:] != h[:-1]]
    fresh = new | np.r_[True, doc[1:] != doc[:-1]]
    h, doc, new = h[fresh], doc[fresh], new[fresh]
    known = ~new
    if first_too:
        shared = np.r_[known[1:], False] & new
        h, doc = np.r_[h, h[shared]], np.r_[doc, doc[shared]]
        known = np.r_[known, np.ones(shared.sum(), bool)]
    for i in range(0, len(h), _SLICE):
        part = slice(i, i + _SLICE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[part].view(np.int64)), pa.array(doc[part]), pa.array(known[part])],
            names=["h", "doc_id", "known"])


def _flagged(hashes: np.ndarray, rows: np.ndarray, lists: pa.ListArray, row: int, end: int) -> np.ndarray:
    """Which of the hashes are in the list of their own row."""
    lists = lists.slice(row, end - row)
    own = np.repeat(np.arange(end - row), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    listed = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    with np.errstate(over="ignore"):
        def keyed(x, r):
            return x ^ arrays.mix(r.astype(np.uint64) + np.uint64(1))
        return np.isin(keyed(hashes, rows), keyed(listed, own))


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in arrays.batches_of(batches):
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        found = []
        for row, _, hashes, at in arrays.hashed_words(*arrays.text_buffers(batch.column("text"))):
            h, _, rows, _ = _anchors(hashes, at)
            found.append((h, ids[row + rows]))
        if found:
            yield from _settled(*map(np.concatenate, zip(*found)), first_too=True)


def _find_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows around anchors that other documents share."""
    for batch in arrays.batches_of(batches):
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        lists = batch.column("hashes")
        found = []
        for row, end, hashes, at in arrays.hashed_words(*arrays.text_buffers(batch.column("text"))):
            h, items, rows, places = _anchors(hashes, at)
            shared = _flagged(h, rows, lists, row, end)
            items, places = items[shared], places[shared]
            edges = np.zeros(len(hashes) + 2, np.int64)
            np.add.at(edges, items - np.minimum(places, PERIOD - 1), 1)
            np.add.at(edges, items + 1, -1)
            near = np.cumsum(edges) > 0
            h, items, rows = _windows(hashes, at)
            keep = near[items]
            found.append((h[keep], ids[row + rows[keep]]))
        if found:
            yield from _settled(*map(np.concatenate, zip(*found)), first_too=False)


def _remover(names: list[str], joined: bool) -> Callable:
    """Cuts the removed windows out of the texts."""
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.batches_of(batches):
            data, offsets = arrays.text_buffers(batch.column("text"))
            raw, lists = data.tobytes(), batch.column("hashes")
            texts, n_words, n_removed = [], [], []
            nulls = batch.column("text").is_null().to_pylist()
            for row, end, hashes, at in arrays.hashed_words(data, offsets):
                h, items, rows = _windows(hashes, at)
                gone = items[_flagged(h, rows, lists, row, end)]
                edges = np.zeros(len(hashes) + 1, np.int64)
                np.add.at(edges, gone, 1)
                np.add.at(edges, np.minimum(gone + WINDOW, len(hashes)), -1)
                keep = np.cumsum(edges)[:-1] == 0
                for r in range(end - row):
                    own = keep[at[r]:at[r + 1]]
                    text = raw[offsets[row + r]:offsets[row + r + 1]]
                    removed = len(own) - int(own.sum())
                    n_words.append(len(own))
                    n_removed.append(removed)
                    if joined or removed:
                        texts.append(b" ".join(compress(text.split(), own)))
                    else:
                        texts.append(None if nulls[row + r] else text)
            columns = [pa.array(texts, pa.string()) if name == "text" else batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
                names=[*names, "n_words", "n_removed"])

    return remove


def _by_doc(rows: DataFrame) -> DataFrame:
    """The hashes of a document: no more than it has words."""
    return rows.groupBy(F.col("doc_id").alias("own_id")).agg(F.collect_list("h").alias("hashes"))


def dedup_substrings(docs: DataFrame, joined: bool = False) -> DataFrame:
    """``docs`` without the words of any window that also starts in a document with a smaller
    ``doc_id``, and ``n_words``, ``n_removed``.

    Windows are judged on the input. With ``joined`` every text is its kept words with single spaces
    between (a null becomes empty); else texts that lose nothing stay as they are. Rows without a
    ``doc_id`` come neither before nor after another and stay. Rows that repeat a ``doc_id`` do not
    remove each other's words, whatever their texts. Empty tables stay empty. Columns named
    ``n_words``, ``n_removed``, ``own_id`` or ``hashes`` would clash and are dropped.
    """
    clash = [c for c in docs.columns if c.lower() in {"n_words", "n_removed", "own_id", "hashes"}]
    docs = docs.drop(*clash)
    names = docs.columns
    schema = T.StructType([*docs.schema, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    with_id = docs.filter("doc_id is not null")
    narrow = with_id.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # A row that is already settled needs no group; hot hashes are spread that way.
    group = F.when(F.col("known"), F.xxhash64("h", "doc_id")).otherwise(F.col("h"))

    anchors = narrow.mapInArrow(_find_anchors, HASHES).withColumn("g", group)
    extent = "over (partition by g, known)"
    shared = anchors.select("h", "doc_id", "known", F.expr(f"min(doc_id) {extent}").alias("first"),
                            F.expr(f"max(doc_id) {extent}").alias("last")).filter("known or first < last")
    placed = with_id.repartition("doc_id").sortWithinPartitions("doc_id", "text")
    near = placed.join(_by_doc(shared).hint("merge"), F.col("doc_id") == F.col("own_id"))
    windows = near.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "hashes").mapInArrow(
        _find_windows, HASHES).withColumn("g", group)
    repeated = windows.select("h", "doc_id", "known", F.expr(f"min(doc_id) {extent}").alias("first")).filter(
        "known or first < doc_id")
    judged = placed.join(_by_doc(repeated).hint("merge"), F.col("doc_id") == F.col("own_id"), "left").drop("own_id")
    no_hash = F.lit(None).cast("array<bigint>").alias("hashes")
    without_id = docs.filter("doc_id is null").select("*", no_hash)
    mapper = _remover(names, joined)
    return judged.mapInArrow(mapper, schema).unionByName(without_id.mapInArrow(mapper, schema))
