"""Similarity join of documents on their sets of word shingles, with Bayesian pruning of candidates.

1. Every document gets a signature of MinHash values; documents with equal shingle sets are one
   class, so copies are never compared. The key of a class is a 64-bit hash of its set.
2. Classes that agree on a band of three values are candidates. The members of a band's bucket meet in
   tiles of bounded size. For every pair of a tile, ten MinHash values at a time are compared; after
   ``n`` values with ``m`` agreeing, the posterior of the similarity (from a uniform prior) is a
   Beta(m + 1, n - m + 1) distribution, and a pair goes as soon as the probability that it reaches
   the threshold is below ``TOLERANCE``. A tile returns what its pairs connect, not the pairs.
3. Connected classes form clusters. Only their texts travel; in tiles of a cluster all shingle sets
   are compared exactly, and per class the number of links is returned.

With 20 bands of 3, a pair at the threshold of 0.8 shares no band with probability 6e-7, and is pruned
with probability of about 6 * ``TOLERANCE``; more similar pairs with less.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from colophon.llm import arrays
from colophon.llm.columns import narrow
from colophon.llm.fingerprints import SHINGLE, shingle_hashes
from colophon.operators.components import connected_components
from colophon.operators.skew import lookup_join
from colophon.session import Scratch

THRESHOLD = 0.8
BANDS, BAND_ROWS, STEP = 20, 3, 10
VALUES = BANDS * BAND_ROWS
TOLERANCE = 1e-6
# Members of one block of a bucket, and of a cluster; a block of long texts has fewer.
BUCKET_BLOCK, CLUSTER_BLOCK, BLOCK_SHINGLES = 512, 256, 1 << 20
_random = np.random.default_rng(20240229)
_FLIP = _random.integers(0, 2**64, VALUES, dtype=np.uint64)
_SPREAD = _random.integers(0, 2**64, VALUES, dtype=np.uint64) | np.uint64(1)
_CHUNK = 1 << 14


def _class_key(shingles: np.ndarray) -> int:
    """A hash of a set of hashes."""
    with np.errstate(over="ignore"):
        parts = np.array([arrays.mix(shingles + np.uint64(1)).sum(dtype=np.uint64), len(shingles)], np.uint64)
        return int(arrays.mix(arrays.mix(parts[:1]) + parts[1:]).view(np.int64)[0])


def _signatures(shingles: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The smallest of each of ``VALUES`` hash functions over every row's shingles; no row is empty."""
    out = np.full((len(at) - 1, VALUES), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for low in range(0, len(shingles), _CHUNK):
            part = shingles[low:low + _CHUNK]
            first = int(np.searchsorted(at, low, side="right")) - 1
            last = int(np.searchsorted(at, low + len(part), side="left"))
            cuts = np.maximum(at[first:last] - low, 0)
            for j in range(VALUES):
                least = np.minimum.reduceat((part ^ _FLIP[j]) * _SPREAD[j], cuts)
                out[first:last, j] = np.minimum(out[first:last, j], least)
    return (out >> np.uint64(32)).astype(np.uint32)


def _shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of every row."""
    for row, end, hashes, at in arrays.hashed_words(*arrays.text_buffers(texts)):
        items, rows, _ = arrays.window_places(at, SHINGLE)
        shingles = arrays.window_hashes(hashes, SHINGLE)[items]
        parts = np.searchsorted(rows, np.arange(end - row + 1))
        for r in range(end - row):
            own = shingles[parts[r]:parts[r + 1]]
            yield np.unique(own if len(own) else shingle_hashes(hashes[at[r]:at[r + 1]]))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in arrays.batches_of(batches):
        if not batch.num_rows:
            continue
        signed, keys, sizes = [], [], []
        block: list[np.ndarray] = []

        def sign():
            at = np.r_[0, np.cumsum([len(s) for s in block])].astype(np.int64)
            full = np.diff(at) > 0
            some = _signatures(np.concatenate(block), at[np.r_[full, True]]) if full.any() else None
            values = np.zeros((len(block), VALUES), np.uint32)
            if some is not None:
                values[full] = some
            signed.extend(values)
            block.clear()

        for shingles in _shingle_sets(batch.column("text")):
            keys.append(_class_key(shingles))
            sizes.append(len(shingles))
            block.append(shingles)
            if len(block) >= 256:
                sign()
        if block:
            sign()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("copy"), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()),
             pa.array([v.tobytes() for v in signed], pa.binary())],
            names=["doc_id", "copy", "node", "n", "signature"])


def needed(n: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """The fewest agreeing of ``n`` values that leave a probability of at least ``tolerance``.

    P(similarity >= t | m of n) = P(Binomial(n + 1, t) <= m), as the posterior is a Beta distribution.
    """
    mass = 0.0
    for m in range(n + 1):
        mass += math.comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
        if mass >= tolerance:
            return m
    return n + 1


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by ``keys`` as tables of whole groups, and where each group begins and the last ends."""
    def starts(table):
        new = np.ones(table.num_rows, bool)
        new[1:] = False
        for key in keys:
            column = table.column(key).to_numpy()
            new[1:] |= column[1:] != column[:-1]
        return np.flatnonzero(new)

    held = None
    for batch in arrays.batches_of(batches):
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]) if held is not None else table
        if held.num_rows:
            at = starts(held)
            if len(at) > 1:
                yield held.slice(0, at[-1]), at
                held = held.slice(at[-1])
    if held is not None and held.num_rows:
        yield held, np.r_[starts(held), held.num_rows]


def _pairs(side: np.ndarray, at: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs within groups: all pairs of a tile of one block, else those between its two blocks."""
    triangles: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    lefts, rights, size = [], [], 0
    for low, high in zip(at[:-1], at[1:]):
        own = side[low:high]
        if own[0] == 0 and not own.any():
            g = high - low
            if g not in triangles:
                triangles[g] = np.triu_indices(g, 1)
            i, j = triangles[g]
            i, j = i + low, j + low
        else:
            i, j = np.flatnonzero(own == 1) + low, np.flatnonzero(own == 2) + low
            i, j = np.repeat(i, len(j)), np.tile(j, len(i))
        lefts.append(i)
        rights.append(j)
        size += len(i)
        if size >= most:
            yield np.concatenate(lefts), np.concatenate(rights)
            lefts, rights, size = [], [], 0
    if size:
        yield np.concatenate(lefts), np.concatenate(rights)


def _joined(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels of rows after joining the pairs: the smallest row of each component."""
    while len(i):
        least = np.minimum(labels[i], labels[j])
        np.minimum.at(labels, labels[i], least)
        np.minimum.at(labels, labels[j], least)
        np.minimum.at(labels, i, least)
        np.minimum.at(labels, j, least)
        labels = labels[labels]
        if (labels[i] == labels[j]).all():
            break
    return labels


def _connected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the pairs that Bayesian pruning leaves connect: one edge for a row at most."""
    limits = {n: needed(n) for n in range(STEP, VALUES + 1, STEP)}
    for table, at in _groups(batches, ["key", "a", "b"]):
        node = table.column("node").to_numpy()
        values = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, VALUES)
        labels = np.arange(len(node))
        for i, j in _pairs(table.column("side").to_numpy(), at):
            agree = np.zeros(len(i), np.int32)
            for n, least in limits.items():
                agree += (values[i, n - STEP:n] == values[j, n - STEP:n]).sum(axis=1, dtype=np.int32)
                keep = agree >= least
                i, j, agree = i[keep], j[keep], agree[keep]
            labels = _joined(labels, i, j)
        moved = labels != np.arange(len(labels))
        yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[labels[moved]])], names=["src", "dst"])


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """The number of shingles that any two of the sets have in common."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    hashes = np.concatenate(sets)
    order = np.argsort(hashes, kind="stable")
    hashes, rows = hashes[order], rows[order]
    new = np.r_[True, hashes[1:] != hashes[:-1]]
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1
    column, rows = column[often], rows[often]
    counts = np.zeros((len(sets), len(sets)), np.float64)
    if len(column):
        column = np.cumsum(np.r_[True, column[1:] != column[:-1]]) - 1
        for low in range(0, int(column[-1]) + 1, 4096):
            first, last = np.searchsorted(column, (low, low + 4096))
            held = np.zeros((len(sets), 4096), np.float32)
            held[rows[first:last], column[first:last] - low] = 1
            counts += held @ held.T
    return counts


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact links of every class within its tile: how many texts, how many documents, and a label."""
    for table, at in _groups(batches, ["cluster", "a", "b"]):
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        side = table.column("side").to_numpy()
        for low, high in zip(at[:-1], at[1:]):
            part = table.column("text").slice(low, high - low).combine_chunks()
            sets: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
            for r, shingles in zip(range(low, high), _shingle_sets(part)):
                # A doc_id may repeat with another text, and a class has one row of each block.
                if _class_key(shingles) == node[r]:
                    sets.setdefault((node[r], side[r]), (r, shingles))
            rows = np.array([r for r, _ in sets.values()], np.int64)
            if len(rows) < 2:
                continue
            sizes = np.array([len(s) for _, s in sets.values()], np.float64)
            common = _shared([s for _, s in sets.values()])
            linked = common >= THRESHOLD * (sizes[:, None] + sizes[None, :] - common) - 1e-9
            np.fill_diagonal(linked, False)
            own = side[rows]
            if own.any():
                linked &= own[:, None] != own[None, :]
            i, j = np.nonzero(np.triu(linked, 1))
            labels = _joined(np.arange(len(rows)), i, j)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[rows]), pa.array(node[rows[labels]]), pa.array(linked.sum(axis=1).astype(np.int64)),
                 pa.array((linked * copies[rows][None, :]).sum(axis=1).astype(np.int64))],
                names=["node", "label", "texts", "documents"])


def _tiled(members: DataFrame, keys: list[str]) -> DataFrame:
    """Deal the members of groups to tiles ``a <= b`` of their ``blocks``; ``side`` says which block of
    the tile a member is of, 0 where both are one."""
    block = F.pmod(F.xxhash64("node", *keys), F.col("blocks")).cast("int")
    tile = F.explode(F.transform(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")), lambda o: F.struct(
        F.least(F.col("block"), o).alias("a"), F.greatest(F.col("block"), o).alias("b"),
        F.when(o == F.col("block"), 0).when(F.col("block") < o, 1).otherwise(2).alias("side")))).alias("tile")
    dealt = members.withColumn("block", block).select("*", tile).select("*", "tile.a", "tile.b", "tile.side")
    return dealt.drop("tile", "block", "blocks").repartition(*keys, "a", "b").sortWithinPartitions(*keys, "a", "b")


def jaccard_join(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``doc_id, copy, class_id, n_links, n_linked_texts, kept``.

    Two documents are linked if their sets of five-word shingles have a Jaccard similarity of 0.8 or
    more; a text of one to four words is one shingle. ``class_id`` is the smallest ``doc_id`` that links
    lead to, ``n_links`` the number of linked documents, ``n_linked_texts`` that of linked sets other
    than the own. ``kept`` marks one document per class, its first. ``copy`` is a hash of the text, as
    rows may repeat a ``doc_id``.

    A text without words has no links and is its own class. Rows without a ``doc_id`` are compared with
    nothing: their class is null and they are kept. Extra columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    docs = narrow(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("copy"))
    with_id = docs.filter("doc_id is not null")
    sketched = scratch.table(with_id.mapInArrow(
        _sketch, "doc_id long, copy long, node long, n long, signature binary"), "sketches")
    nodes = scratch.table(sketched.filter("n > 0").groupBy("node").agg(
        F.min(F.struct("doc_id", "copy")).alias("first"), F.count(F.lit(1)).alias("copies"),
        F.first("n").alias("n"), F.first("signature").alias("signature")), "nodes")

    width = 4 * BAND_ROWS
    keys = F.array(*(F.xxhash64(F.lit(b), F.substring("signature", b * width + 1, width)) for b in range(BANDS)))
    banded = nodes.select("node", F.explode(keys).alias("key"))
    buckets = banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    met = banded.join(buckets, "key").withColumn("blocks", F.ceil(F.col("size") / BUCKET_BLOCK)).drop("size")
    signed = met.join(nodes.select("node", "signature"), "node")
    edges = scratch.table(_tiled(signed, ["key"]).mapInArrow(_connected, "src long, dst long").distinct(), "edges")
    clusters = connected_components(edges).withColumnRenamed("component", "cluster")

    sized = scratch.table(clusters.withColumnRenamed("id", "node").join(nodes.drop("signature"), "node"), "clusters")
    blocks = sized.groupBy("cluster").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / CLUSTER_BLOCK, F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    members = sized.join(blocks, "cluster").select("cluster", "node", "copies", "blocks", F.col("first.doc_id").alias("doc_id"))
    # The members grow with the corpus, so they are never sent whole to every task.
    texts = _tiled(members.hint("merge").join(with_id.select("doc_id", "text"), "doc_id").drop("doc_id"), ["cluster"])
    linked = scratch.table(texts.mapInArrow(
        _verified, "node long, label long, texts long, documents long"), "links")
    counts = linked.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("documents").alias("documents"))
    labels = connected_components(linked.select("node", "label").filter("node <> label").distinct(), "node", "label")
    graded = nodes.drop("signature", "n").join(labels.withColumnRenamed("id", "node"), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    classes = graded.groupBy("component").agg(F.min("first").alias("class"))
    info = graded.join(classes, "component").join(counts, "node", "left").select(
        "node", "class", (F.col("copies") - 1 + F.coalesce("documents", F.lit(0))).alias("links"),
        F.coalesce("texts", F.lit(0)).alias("texts"))
    rows = lookup_join(sketched.select("doc_id", "copy", "node"), scratch.table(info, "classes"), "node",
                       lookup_rows=scratch.rows["classes"])
    result = rows.select(
        "doc_id", "copy", F.coalesce("class.doc_id", "doc_id").alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_linked_texts"),
        F.coalesce(F.struct("doc_id", "copy") == F.col("class"), F.lit(True)).alias("kept"))
    alone = docs.filter("doc_id is null").select(
        "doc_id", "copy", F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(0).cast("long").alias("n_linked_texts"), F.lit(True).alias("kept"))
    return result.unionByName(alone)


def one_per_class(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class of ``jaccard_join``, all columns. Rows that repeat
    a ``doc_id`` and its text count once; rows without a ``doc_id`` all stay."""
    kept = jaccard_join(docs).filter("kept and doc_id is not null").select(
        F.col("doc_id").alias("kept_id"), F.col("copy").alias("kept_copy")).distinct()
    copy = F.xxhash64("text")
    with_id = docs.filter("doc_id is not null").withColumn("__copy", copy)
    found = with_id.join(kept, (F.col("doc_id") == F.col("kept_id")) & (F.col("__copy") == F.col("kept_copy")), "left_semi")
    return found.dropDuplicates(["doc_id", "__copy"]).drop("__copy").unionByName(docs.filter("doc_id is null"))
