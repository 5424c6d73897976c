"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed byte pairs and triples: case-folded ASCII, everything else that is
no letter read as a space; 1 + ln(count), times the inverse document frequency, of length 1.
Spherical k-means splits each language's training vectors into a few centroids. The language of the
nearest centroid by cosine wins; a text that is much further from it than nearly all training
texts of that language are is rejected, unless it is only a few words long.

Training uses a bounded sample: of each label about ``PER_LANGUAGE`` documents, chosen by a hash. All
labels are learned; their centroids are written and matched in blocks of ``BLOCK_LABELS`` labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from colophon.llm import arrays
from colophon.llm.columns import narrow
from colophon.operators.skew import lookup_join
from colophon.session import Scratch

BITS = 12
SIZE = 1 << BITS
PER_LANGUAGE, CENTROIDS = 600, 4
# The driver holds the centroids of so many labels (16 MB) at a time.
BLOCK_LABELS = 256
# A text is rejected below this share of the similarity that 99 % of its language's samples reach.
# Texts with fewer different features than this are too short for a distance to say anything.
REJECT, FEW = 0.4, 48
UNKNOWN = "und"
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = _FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_ROWS = 256


@dataclass
class Block:
    """Labels by centroid, centroids (one row each, length 1) and the least similarity per centroid
    that is not rejected."""

    labels: np.ndarray
    centroids: np.ndarray
    least: np.ndarray


@dataclass
class Model:
    """Weights of features, and broadcast blocks in the order of their labels."""

    idf: np.ndarray
    blocks: list[Broadcast]


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of the hashed pairs and triples per row."""
    rows = len(offsets) - 1
    counts = np.zeros(rows * SIZE, np.int64)
    for low in range(0, len(data), arrays.BLOCK):
        part = _FOLD[data[low:low + arrays.BLOCK + 2]].astype(np.uint32)
        row = np.searchsorted(offsets, np.arange(low, low + len(part)), side="right") - 1
        for n in (2, 3):
            size = min(len(part) - n + 1, arrays.BLOCK)
            if size <= 0:
                continue
            code = np.full(size, n << 24, np.uint32)
            for k in range(n):
                code |= part[k:k + size] << np.uint32(8 * k)
            fits = (row[:size] == row[n - 1:n - 1 + size]) & (code != (n << 24 | 0x202020 >> 8 * (3 - n)))
            with np.errstate(over="ignore"):
                hashed = (code[fits] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
            counts += np.bincount(row[:size][fits] * SIZE + hashed, minlength=rows * SIZE)
    return counts.reshape(rows, SIZE)


def _counted(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """Feature counts of a bounded number of rows at a time."""
    data, offsets = arrays.text_buffers(texts)
    for first, last in arrays.blocks(offsets):
        for row in range(first, last, _ROWS):
            end = min(last, row + _ROWS)
            yield row, end, _features(data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row])


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = np.log(np.maximum(counts, 1).astype(np.float32)) + 1
    weights *= (counts > 0) * idf
    return weights / np.maximum(np.linalg.norm(weights, axis=1, keepdims=True), 1e-9)


def spherical_kmeans(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Up to ``k`` unit centroids; each starts from the point that the ones before are furthest from."""
    def unit(x):
        return x / max(float(np.linalg.norm(x)), 1e-9)

    centroids = unit(points.mean(axis=0))[None, :]
    while len(centroids) < min(k, len(points)):
        furthest = int((points @ centroids.T).max(axis=1).argmin())
        centroids = np.vstack([centroids, points[furthest]])
    for _ in range(rounds):
        nearest = (points @ centroids.T).argmax(axis=1)
        centroids = np.vstack([unit(points[nearest == c].mean(axis=0)) if (nearest == c).any() else centroids[c]
                               for c in range(len(centroids))])
    return centroids


def train(docs: DataFrame) -> Model:
    """Learn from the rows of ``docs`` (``doc_id``, ``text``, ``lang``) with a text and a label.

    Copies of a row count once. Without any such row the model knows no language.
    """
    labelled = narrow(docs, "doc_id", "text", "lang").filter("text is not null and lang is not null")
    scratch = Scratch(docs.sparkSession, "language")
    shares = scratch.table(labelled.groupBy("lang").agg((F.lit(float(PER_LANGUAGE)) / F.count(F.lit(1))).alias("share")), "shares")
    if not scratch.rows["shares"]:
        return Model(np.ones(SIZE, np.float32), [])
    # A fraction of a hash's range per label.
    draw = F.xxhash64("doc_id", "text")
    sample = (lookup_join(labelled.withColumn("draw", draw), shares, "lang", lookup_rows=scratch.rows["shares"])
              .filter(F.shiftrightunsigned("draw", 1) / F.lit(2.0**63) < F.col("share"))
              .dropDuplicates(["lang", "draw"]).select("text", "lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.batches_of(batches):
            langs = batch.column("lang")
            for row, end, counts in _counted(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [langs.slice(row, end - row), pa.array([c.astype("<u4").tobytes() for c in counts], pa.binary())],
                    names=["lang", "counts"])

    counted = sample.mapInArrow(count, "lang string, counts binary").persist()

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(SIZE, np.int64), 0
        for batch in arrays.batches_of(batches):
            for counts in batch.column("counts").to_pylist():
                held += np.frombuffer(counts, "<u4") > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()]), pa.array([n])], names=["held", "n"])

    try:
        found = counted.coalesce(16).mapInArrow(present, "held binary, n long").collect()
        documents = sum(r["n"] for r in found)
        held = sum(np.frombuffer(bytes(r["held"]), np.int64) for r in found)
        idf = (np.log((documents + 1) / (held + 1)) + 1).astype(np.float32)

        def cluster(rows: pd.DataFrame) -> pd.DataFrame:
            points = vectors(np.vstack([np.frombuffer(c, "<u4") for c in rows["counts"]]), idf)
            centroids = spherical_kmeans(points, CENTROIDS)
            near = float(np.quantile((points @ centroids.T).max(axis=1), 0.01))
            return pd.DataFrame({"lang": rows["lang"].iloc[0], "near": near,
                                 "centroid": [c.astype("<f4").tobytes() for c in centroids]})

        learned = scratch.table(counted.groupBy("lang").applyInPandas(
            cluster, "lang string, near double, centroid binary"), "centroids")
    finally:
        counted.unpersist()
    labels = [r["lang"] for r in learned.select("lang").distinct().orderBy("lang").collect()]
    blocks = []
    for k in range(0, len(labels), BLOCK_LABELS):
        part = labels[k:k + BLOCK_LABELS]
        rows = learned.filter(F.col("lang").between(part[0], part[-1])).orderBy("lang", "centroid").collect()
        blocks.append(docs.sparkSession.sparkContext.broadcast(Block(
            np.array([r["lang"] for r in rows], object),
            np.vstack([np.frombuffer(bytes(r["centroid"]), "<f4") for r in rows]),
            REJECT * np.array([r["near"] for r in rows]))))
    return Model(idf, blocks)


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (cosine to the nearest centroid) and ``rejected``.

    A text that is null or has no letter is ``und`` with score 0, and rejected. Ties go to the
    first label. Columns of these names are replaced; all others stay. Empty tables stay empty.
    """
    added = ["lang_pred", "score", "rejected"]
    docs = docs.drop(*(c for c in docs.columns if c.lower() in [*added, "__letters"]))
    names = docs.columns
    idf, blocks = model.idf, model.blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.batches_of(batches):
            letters = batch.column("__letters").to_numpy(zero_copy_only=False)
            n = batch.num_rows
            label, score = np.full(n, UNKNOWN, object), np.zeros(n)
            rejected = np.ones(n, bool)
            if blocks:
                for row, end, counts in _counted(batch.column("text")):
                    points = vectors(counts, idf)
                    best, least = np.full(end - row, -1, np.float32), np.zeros(end - row)
                    for known in (block.value for block in blocks):
                        near = points @ known.centroids.T
                        nearest = near.argmax(axis=1)
                        near = near[np.arange(end - row), nearest]
                        # Blocks are in the order of labels, so the first label keeps a tie.
                        closer = np.flatnonzero(near > best)
                        best[closer], least[closer] = near[closer], known.least[nearest[closer]]
                        label[row + closer] = known.labels[nearest[closer]]
                    score[row:end] = np.clip(best, 0, 1)
                    rejected[row:end] = (score[row:end] < least) & ((counts > 0).sum(axis=1) >= FEW)
                label[~letters], score[~letters], rejected[~letters] = UNKNOWN, 0.0, True
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(label, pa.string()), pa.array(score), pa.array(rejected)],
                names=[*names, *added])

    schema = docs.schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return docs.withColumn("__letters", F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))).mapInArrow(run, schema)


def held_out() -> F.Column:
    """Whether a document is kept from training: a fourth of the ids by their checksum."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter("doc_id is not null").filter(~held_out())
