"""Lexical state of text files that are read by splits.

Whether a line stands in a comment or in quotes depends on all text before it. A task that reads a split
says, for every state that the split may begin in, in which one it ends; put one after the other, these
functions give each split the state it begins in.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# Called with a line, without its line break, and the state before it; returns the state behind it.
Advance = Callable[[str, int], int]
# What a piece of a split is: the end of what began before the split, all of something, or the begin of what
# goes on behind the split.
HEAD, RECORD, TAIL = 0, 1, 2


class SplitStates:
    """The state in which each split begins; 0 unless something was left open before it."""

    def __init__(self, rows: Sequence[tuple[int, int, list[int]]]):
        """``rows`` are ``(file, split start, end state by begin state)``; splits that change nothing may
        be missing."""
        self.changes: dict[int, tuple[list[int], list[int]]] = {}
        file, state = None, 0
        for where, start, ends in sorted(rows, key=lambda r: (r[0], r[1])):
            if where != file:
                file, state = where, 0
            if ends[state] != state:
                state = ends[state]
                starts, states = self.changes.setdefault(file, ([], []))
                starts.append(start)
                states.append(state)

    def at(self, file: int, split_start: int) -> int:
        starts, states = self.changes.get(file, ([], []))
        before = bisect_left(starts, split_start)
        return states[before - 1] if before else 0


def runs_of(files, splits) -> list[int]:
    """Where the rows of another split begin, with both ends."""
    if not len(files):
        return []
    changed = (files[1:] != files[:-1]) | (splits[1:] != splits[:-1])
    return [0, *(changed.nonzero()[0] + 1).tolist(), len(files)]


def split_states(lines: DataFrame, advance: Advance, states: int) -> SplitStates:
    """States of the splits of ``lines`` (``file, split_start, value``), of which lines that change
    nothing may be left out. One narrow row per split reaches the driver, which plans a task for
    each of them anyway."""
    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        current, ends = None, list(range(states))

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([current[0]]), pa.array([current[1]]), pa.array([ends], pa.list_(pa.int32()))],
                names=["file", "split_start", "ends"])

        for batch in batches:
            files, splits = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            values = batch.column(2)
            bounds = runs_of(files, splits)
            for begin, end in zip(bounds, bounds[1:]):
                split = (int(files[begin]), int(splits[begin]))
                if split != current:
                    if current is not None:
                        yield row()
                    current, ends = split, list(range(states))
                for line in values.slice(begin, end - begin).to_pylist():
                    after = {state: advance(line, state) for state in set(ends)}
                    ends = [after[state] for state in ends]
        if current is not None:
            yield row()

    found = lines.mapInArrow(scan, "file long, split_start long, ends array<int>")
    return SplitStates([(r["file"], r["split_start"], r["ends"]) for r in found.collect()])


def lines_of(spark: SparkSession, path: str | Sequence[str], **options: str) -> DataFrame:
    """``file, split_start, value`` of all lines of text files, read by splits."""
    return spark.read.options(**options).text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        "value",
    )


def joined_at_splits(pieces: DataFrame, longest: int) -> DataFrame:
    """Put texts that cross split boundaries together: ``file, split_start, place, body``, placed where
    they begin.

    A text starts as one split's tail and goes on in the heads of the next ones. Which pieces
    belong together is found on their positions and lengths alone, at most two narrow rows per
    split. Pieces that would make more than ``longest`` characters, such as a file without
    any record, stay apart; a record among them is not well-formed then and ends in the rejects.
    """
    at = ["file", "split_start", "part"]
    in_file = Window.partitionBy("file").orderBy("split_start", "part")
    record = F.sum((F.col("part") == TAIL).cast("long")).over(in_file)
    placed = pieces.select(*at, F.length("body").alias("_n")).withColumn("_record", record)
    long = placed.groupBy("file", "_record").agg(F.sum("_n").alias("_all")).where(
        F.col("_all") > longest).select("file", "_record", F.lit(True).alias("_long"))
    marked = pieces.join(placed.drop("_n").join(long, ["file", "_record"], "left"), at)
    ordered = F.array_sort(F.collect_list(F.struct("split_start", "part", "place", "body")))
    columns = ["file", "split_start", "place", "body"]
    whole = (
        marked.where("_long is null").groupBy("file", "_record").agg(ordered.alias("_all"))
        .select("file", F.col("_all")[0]["split_start"].alias("split_start"), F.col("_all")[0]["place"].alias("place"),
                F.array_join(F.transform("_all", lambda p: p["body"]), "").alias("body"))
    )
    return whole.unionByName(marked.where("_long").select(*columns))
