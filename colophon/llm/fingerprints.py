"""Bottom-k sketches of word-shingle hashes as document fingerprints.

A sketch keeps the ``k`` smallest distinct 64-bit hashes of a document's shingles. Sketches of parts
merge into the sketch of the whole. Of two sketches, the ``k`` smallest hashes of their union are a
uniform sample of the union of both shingle sets, which estimates resemblance and containment; the
largest kept hash tells how dense hashes are, which estimates the number of distinct shingles.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from colophon.llm import arrays
from colophon.llm.columns import narrow

K = 128
SHINGLE = 5


def shingle_hashes(hashes: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Hashes of all shingles of one text's word hashes, repeats included.

    A text of fewer words than a shingle, but of some, has one shingle of all its words.
    """
    return arrays.window_hashes(hashes, min(n, max(1, len(hashes))))


def sketch(shingles: np.ndarray, k: int = K) -> np.ndarray:
    """The ``k`` smallest distinct hashes, ascending."""
    if len(shingles) > 4 * k:
        # Repeats may crowd the smallest hashes, so the cut is checked and raised where needed.
        cut = 2 * k
        while cut < len(shingles):
            least = np.unique(np.partition(shingles, cut)[:cut])
            if len(least) > k:
                return least[:k]
            cut *= 4
    return np.unique(shingles)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of a text whose shingles are those of two parts."""
    return np.union1d(a, b)[:k]


def distinct(a: np.ndarray, k: int = K) -> float:
    """Number of distinct shingles: exact below ``k``, else estimated."""
    if len(a) < k:
        return float(len(a))
    return (k - 1) / ((float(a[-1]) + 1.0) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity. Two empty texts are alike, an empty and another are not."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)
    shared = len(a) + len(b) - len(union)
    if len(union) > k:
        # A hash of the union's sample is shared if both sketches have it.
        shared = int(np.searchsorted(np.intersect1d(a, b, assume_unique=True), union[k - 1], side="right"))
        union = union[:k]
    return shared / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the first text's shingles that the second has; 1 for an empty text."""
    own = distinct(a, k)
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / own) if own else 1.0


def encode(a: np.ndarray) -> str:
    return base64.b64encode(a.astype("<u8").tobytes()).decode()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype="<u8").astype(np.uint64)


def sketches(texts: pa.Array, k: int = K) -> list[np.ndarray]:
    """One sketch per row; a null text has an empty one."""
    found = []
    for row, end, hashes, at in arrays.hashed_words(*arrays.text_buffers(texts)):
        items, rows, _ = arrays.window_places(at, SHINGLE)
        shingles = arrays.window_hashes(hashes, SHINGLE)[items]
        parts = np.searchsorted(rows, np.arange(end - row + 1))
        for r in range(end - row):
            own = shingles[parts[r]:parts[r + 1]]
            found.append(sketch(own if len(own) else shingle_hashes(hashes[at[r]:at[r + 1]]), k))
    return found


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of code points replaced by the first as many of ``following``."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by part; a part's last row repeats the first document of the next part.

    The last row of a batch waits for the next batch.
    """
    held: list[tuple] = []
    for batch in arrays.batches_of(batches):
        rows = held + list(zip(*(batch.column(c).to_pylist() for c in ("part", "copied", "doc_id", "text"))))
        held = rows[-1:]
        texts = [text or "" for *_, text in rows]
        own = sketches(pa.array(texts, pa.large_string()))
        at = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i + 1][0] == rows[i][0]]
        changed = [edited(texts[i], texts[i + 1]) for i in at]
        other = sketches(pa.array(changed, pa.large_string()))
        yield pa.RecordBatch.from_arrays([
            pa.array([rows[i][2] for i in at], pa.int64()), pa.array([len(texts[i]) for i in at], pa.int64()),
            pa.array(changed, pa.string()), pa.array([encode(own[i]) for i in at], pa.string()),
            pa.array([encode(a) for a in other], pa.string()), pa.array([distinct(own[i]) for i in at], pa.float64()),
            pa.array([resemblance(own[i], a) for i, a in zip(at, other)], pa.float64()),
            pa.array([resemblance(own[i], own[i + 1]) for i in at], pa.float64()),
            pa.array([containment(own[i], a) for i, a in zip(at, other)], pa.float64()),
        ], names=["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "n_shingles",
                  "near_edited", "near_next", "held_by_edited"])


RESULT = ("doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
          "n_shingles double, near_edited double, near_next double, held_by_edited double")


def _parts(ids: DataFrame, parts: int) -> list[int]:
    """The smallest ``doc_id`` of each of at most ``parts`` ranges of about equal size."""
    share = [i / parts for i in range(1, parts)]
    bounds = ids.agg(F.min("doc_id").alias("least"), F.percentile_approx(
        "doc_id", share, 20 * parts).alias("cuts") if share else F.array().alias("cuts")).first()
    if bounds["least"] is None:
        return []
    return sorted({bounds["least"], *(bounds["cuts"] or [])})


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of all rows of ``docs`` and of their edited texts, see ``RESULT``.

    The next document is the one that follows in ascending ``(doc_id, text)``; after the last comes
    the first, and a lone document follows itself. A row without a ``doc_id`` is in no order and
    follows itself. A null text is empty. Extra columns are ignored, an empty table stays empty.

    The ids are cut into ``parts`` ranges (by default four per shuffle partition), of which only the
    bounds reach the driver; each range also gets a copy of the rows that begin the next one.
    """
    spark = docs.sparkSession
    docs = narrow(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    with_id = docs.filter("doc_id is not null")
    bounds = _parts(with_id.select("doc_id"), parts)

    # A bound is an id of the table, so it is its part's first document.
    @F.pandas_udf("array<int>")
    def dealt(ids: pd.Series) -> pd.Series:
        starts = np.array(bounds, np.int64)
        own = np.searchsorted(starts, ids.to_numpy(), side="right") - 1
        first = starts[np.maximum(own, 0)] == ids.to_numpy()
        return pd.Series([[int(p), int((p - 1) % len(starts))] if f else [int(p)] for p, f in zip(own, first)])

    dealt_out = with_id.select("doc_id", "text", F.posexplode(dealt("doc_id")).alias("copied", "part")).select(
        "doc_id", "text", (F.col("copied") == 1).alias("copied"), "part")
    ordered = dealt_out.repartition("part").sortWithinPartitions("part", "copied", "doc_id", "text")
    alone = docs.filter("doc_id is null").select(
        "doc_id", "text", F.explode(F.array(F.lit(False), F.lit(True))).alias("copied"),
        F.lit(0).alias("part"))
    return ordered.mapInArrow(_fingerprint, RESULT).unionByName(alone.mapInArrow(_fingerprint, RESULT))
