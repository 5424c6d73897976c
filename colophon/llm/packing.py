"""Packing of token pieces into sequences of a fixed capacity by linear grouping.

How many pieces there are of each length, at most ``capacity`` numbers, says all that planning needs:

1. Large lengths, in descending order, are cut into groups of equally many pieces, and every
   length of a group is rounded up to the group's largest.
2. For these few sizes, configurations (how many of each size share a sequence) are optimised by
   the linear program of cutting stock: columns come from a knapsack over the dual prices.
3. The whole part of every configuration's use is filled with actual pieces, the longest of each
   group first. The pieces are mostly shorter than their size; what stays free is known by runs of
   sequences, as lengths are sorted.
4. What is left over, and then the small pieces, go to the tightest sequence that has room.

A plan is a table of runs: "the pieces of this length from rank a to b stand at this offset of
sequences s, s + 1, ...". Spark numbers the pieces of each length and looks their runs up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from colophon.llm import arrays, bpe
from colophon.llm.columns import narrow
from colophon.session import Scratch

CAPACITY = 2048
END = 0
GROUPS = 96
# Lengths from here on are planned by configurations, as a share of the capacity.
LARGE = 1 / 3
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False,
                 words: int = bpe.WORDS) -> DataFrame:
    """The documents' ids, each with the end id after it, cut into pieces of at most ``capacity``.

    A null text is empty: its only id is the end id. ``with_ids`` adds the ids themselves as
    little-endian unsigned 32-bit integers. Extra columns are ignored; repeated rows stay apart.
    """
    docs = narrow(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    file = bpe.lexicon(docs, path, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.Encoder.of(path, file)
        tail = np.array([END], "<u4").tobytes()
        for batch in arrays.batches_of(batches):
            doc_ids = batch.column("doc_id").to_pylist()
            for row, end, ids, at in encoder.encode(batch.column("text")):
                raw = ids.astype("<u4").tobytes()
                out = []
                for r in range(end - row):
                    own = raw[4 * at[r]:4 * at[r + 1]] + tail
                    for k, low in enumerate(range(0, len(own), 4 * capacity)):
                        part = own[low:low + 4 * capacity]
                        out.append((doc_ids[row + r], k, low // 4, len(part) // 4, zlib.crc32(part), part))
                columns = list(zip(*out))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:None if with_ids else 5]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(kinds)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.mapInArrow(run, PIECES + ", ids binary" * with_ids)


def _best_pattern(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """The most valuable configuration: an unbounded knapsack."""
    value, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    fits = np.searchsorted(sizes[order], np.arange(capacity + 1), side="right")
    own, worth = sizes[order], prices[order]
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        if fits[room]:
            gain = value[room - own[:fits[room]]] + worth[:fits[room]]
            best = int(gain.argmax())
            if gain[best] > value[room] + 1e-12:
                value[room], pick[room] = gain[best], order[best]
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if pick[room] < 0:
            room -= 1
        else:
            pattern[pick[room]] += 1
            room -= sizes[pick[room]]
    return pattern


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used, by column generation; all demand is met exactly."""
    n = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.linalg.inv(basis)
    use = inverse @ demand
    for turn in range(40 * n):
        prices = inverse.sum(axis=0)
        column = _best_pattern(sizes, prices, capacity).astype(float)
        if prices @ column <= 1 + 1e-6:
            break
        change = inverse @ column
        ratio = np.where(change > 1e-9, use / np.where(change > 1e-9, change, 1), np.inf)
        leaves = int(ratio.argmin())
        use = use - ratio[leaves] * change
        use[leaves] = ratio[leaves]
        basis[:, leaves] = column
        inverse[leaves] /= change[leaves]
        others = np.arange(n) != leaves
        inverse[others] -= np.outer(change[others], inverse[leaves])
        if turn % 50 == 49:
            inverse = np.linalg.inv(basis)
            use = np.maximum(inverse @ demand, 0)
    return [(basis[:, i].astype(np.int64), float(use[i])) for i in range(n) if use[i] > 1e-9]


class _Plan:
    """Runs of pieces placed so far, and free room by runs of sequences."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.left = counts.copy()
        self.next_rank = np.zeros(len(counts), np.int64)
        self.capacity, self.sequences = capacity, 0
        self.free: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.rows: list[tuple[int, int, int, int, int]] = []

    def put(self, length: int, count: int, sequence: int, room: int) -> None:
        """``count`` pieces of a length, one each to ``sequence`` and those after it."""
        rank = int(self.next_rank[length])
        self.rows.append((length, rank, rank + count, sequence, self.capacity - room))
        self.next_rank[length] += count
        self.left[length] -= count

    def open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def fill(self, length: int, sequence: int, count: int, room: int) -> None:
        """As many pieces of a length as fit and are left to a run of sequences."""
        each = room // length
        whole = min(count, int(self.left[length]) // each)
        for k in range(each if whole else 0):
            self.put(length, whole, sequence, room - k * length)
        if whole:
            self.free[room - each * length].append((sequence, whole))
        if whole < count:
            some = min(int(self.left[length]), each) if whole * each <= self.left[length] + whole * each else 0
            for k in range(some):
                self.put(length, 1, sequence + whole, room - k * length)
            if some:
                self.free[room - some * length].append((sequence + whole, 1))
                whole += 1
            if whole < count:
                self.free[room].append((sequence + whole, count - whole))


def plan(counts: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS) -> tuple[list[tuple], int]:
    """Runs ``(length, first rank, end rank, first sequence, offset)`` and the number of sequences.

    ``counts[n]`` is the number of pieces of length ``n``.
    """
    made = _Plan(np.asarray(counts, np.int64), capacity)
    large = [n for n in range(capacity - 1, int(capacity * LARGE), -1) if counts[n]]
    total = int(sum(counts[n] for n in large))
    # Equal shares of the pieces in descending length; a length may belong to two groups.
    members: list[list[list[int]]] = []
    if total:
        share, room = -(-total // groups), 0
        for n in large:
            rest = int(counts[n])
            while rest:
                if not room:
                    members.append([])
                    room = share
                taken = min(room, rest)
                members[-1].append([n, taken])
                rest, room = rest - taken, room - taken
        sizes = np.array([group[0][0] for group in members])
        demand = np.array([sum(c for _, c in group) for group in members], float)
        for pattern, use in configurations(sizes, demand, capacity):
            slots = [g for g in np.flatnonzero(pattern) for _ in range(pattern[g])]
            times = int(use + 1e-6)
            for g in np.flatnonzero(pattern):
                times = min(times, sum(c for _, c in members[g]) // int(pattern[g]))
            sequence = made.open(times)
            while times:
                # The run ends where the length of a slot's next pieces changes.
                step, here = times, []
                for g in np.flatnonzero(pattern):
                    line, need = iter(members[g]), int(pattern[g])
                    length, held = next(line)
                    if held >= need:
                        step = min(step, held // need)
                        here.append((g, [length] * need))
                    else:
                        step, taken = 1, []
                        while len(taken) < need:
                            taken += [length] * min(held, need - len(taken))
                            length, held = next(line, (0, 0))
                        here.append((g, taken))
                room = capacity
                for g, lengths in here:
                    for n in lengths:
                        made.put(n, step, sequence, room)
                        room -= n
                        own = next(x for x in members[g] if x[0] == n)
                        own[1] -= step
                    members[g] = [x for x in members[g] if x[1]]
                made.free[room].append((sequence, step))
                sequence, times = sequence + step, times - step
    for n in range(capacity, 0, -1):
        room = n
        while made.left[n]:
            while room <= capacity and not made.free[room]:
                room += 1
            if room > capacity:
                wanted = -(-int(made.left[n]) // (capacity // n))
                made.fill(n, made.open(wanted), wanted, capacity)
            else:
                made.fill(n, *made.free[room].pop(), room)
                room = n if made.free[n] else room
    return made.rows, made.sequences


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length`` is 1 to ``capacity``.

    ``pieces`` should be a written table, as it is read twice. The pieces of a length are numbered in
    as many separate parts as there are shuffle partitions, so a length that many pieces share is no
    single task's. The plan has a few rows per length, whatever the number of pieces.
    """
    spark = pieces.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn("__part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int"))
    sizes = salted.groupBy("length", "__part").agg(F.count(F.lit(1)).alias("__n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in sizes.groupBy("length").agg(F.sum("__n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    rows, _ = plan(counts, capacity)
    runs = spark.createDataFrame(
        rows, "__length long, __low long, __high long, __sequence long, offset long")
    by_length = Window.partitionBy("length").orderBy("__part")
    before = sizes.withColumn("__before", F.sum("__n").over(by_length) - F.col("__n")).drop("__n")
    within = Window.partitionBy("length", "__part").orderBy("doc_id", "piece")
    ranked = salted.withColumn("__rank", F.row_number().over(within) - 1).join(
        before, ["length", "__part"]).withColumn("__rank", F.col("__rank") + F.col("__before"))
    placed = ranked.join(F.broadcast(runs), (F.col("length") == F.col("__length")) & (
        F.col("__rank") >= F.col("__low")) & (F.col("__rank") < F.col("__high")))
    sequence = (F.col("__sequence") + F.col("__rank") - F.col("__low")).alias("sequence_id")
    return placed.select(*pieces.columns, sequence, "offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every piece of every row of ``docs`` with its place in a sequence. An empty table has none."""
    scratch = Scratch(docs.sparkSession, "packing")
    return pack(scratch.table(token_pieces(docs, path, capacity, with_ids), "pieces"), capacity)
