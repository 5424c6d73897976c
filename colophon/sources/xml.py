"""Scan XML dumps of any size by splits, in one pass for all record elements."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from colophon.functions.markup import decode_entities
from colophon.operators.ordering import dense_ids
from colophon.operators.skew import checked_broadcast
from colophon.schemas import PUBLICATION_TAGS, RECORD_SCHEMA, RECORD_TAGS
from colophon.session import Scratch
from colophon.sources.lexical import (
    HEAD as _HEAD, RECORD as _RECORD, TAIL as _TAIL, SplitStates, joined_at_splits, lines_of, runs_of, split_states,
)

_SCAN_SCHEMA = "file long, split_start long, place long, part int, body string"
# Records and gaps of more characters than this are not put together from several splits.
LONGEST_CHUNK = 64 << 20
# States of the text: markup, inside a comment, inside a character data section.
_MARKUP, _COMMENT, _CDATA = 0, 1, 2
_OPENS = re.compile(r"<!--|<!\[CDATA\[")
_CLOSES = {_COMMENT: "-->", _CDATA: "]]>"}
_STATE_MARKS = ("<!--", "-->", "<![CDATA[", "]]>")


def _settled(text: str, state: int) -> tuple[list[str], int]:
    """What a text shows: comments are left out, and character data is escaped, so that tags in it start
    nothing. ``text`` begins in the given state; the one it ends in is returned too. Marks never
    cross the end of a line, so neither of a text of whole lines."""
    shown, at = [], 0
    while at < len(text):
        if state == _MARKUP:
            mark = _OPENS.search(text, at)
            shown.append(text[at:mark.start() if mark else len(text)])
            if not mark:
                break
            state, at = (_COMMENT if mark.group() == "<!--" else _CDATA), mark.end()
        else:
            end = text.find(_CLOSES[state], at)
            if state == _CDATA:
                inside = text[at:] if end < 0 else text[at:end]
                shown.append(inside.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;"))
            if end < 0:
                break
            state, at = _MARKUP, end + len("-->")
    return shown, state


def _state_after(line: str, state: int) -> int:
    return _settled(line, state)[1]


def _text_of(lines, begin: int, end: int) -> str:
    """Some lines of an Arrow column as one text, joined without an object per line."""
    import pyarrow as pa
    import pyarrow.compute as pc

    some = lines.slice(begin, end - begin).cast(pa.large_string())
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some), pa.scalar("\n", pa.large_string()))
    return whole[0].as_py() + "\n"


def _cut_at_records(tags: Sequence[str], states: SplitStates, ends: bool):
    """Task function: lines of one or more splits in, text pieces that begin at records out.

    Of every split, what precedes its first record start is its head, what follows its last
    record start its tail; all pieces between are whole records with the text up to the next.
    With ``ends`` heads and tails come out, and what is between is not cut; else the others do. The place of
    a piece is where it begins in what the split shows, from 1; that of a head is 0.
    A split goes on in the state in which the one before it ended.
    """
    starts_at = re.compile(r"<(?:" + "|".join(tags) + r")(?=[\s/>]|$)")

    def starts_of(text: str, first: bool):
        """Places of record starts; for the ends only the first, if it is the split's, and the last."""
        if not ends:
            yield from (match.start() for match in starts_at.finditer(text))
            return
        match = starts_at.search(text)
        if match:
            if first:
                yield match.start()
            last = text.rfind("<")
            while not starts_at.match(text, last):
                last = text.rfind("<", 0, last)
            if not first or last > match.start():
                yield last

    def cut(batches):
        import pyarrow as pa

        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
        names = ["file", "split_start", "place", "part", "body"]

        def rows(out):
            columns = list(zip(*out)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        current, open_text, place, seen, state = None, [], 0, 0, _MARKUP
        for batch in batches:
            out = []
            files, splits = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            bounds = runs_of(files, splits)
            for begin, end in zip(bounds, bounds[1:]):
                split = (int(files[begin]), int(splits[begin]))
                if split != current:
                    if ends and current is not None:
                        out.append((*current, place, _TAIL if place else _HEAD, "".join(open_text)))
                    current, open_text, place, seen, state = split, [], 0, 0, states.at(*split)
                shown, state = _settled(_text_of(batch.column(2), begin, end), state)
                text, done = "".join(shown), 0
                for start in starts_of(text, not place):
                    if ends != bool(place):
                        open_text.append(text[done:start])
                        out.append((*current, place, _RECORD if place else _HEAD, "".join(open_text)))
                    open_text, place, done = [], seen + start + 1, start
                open_text.append(text[done:])
                seen += len(text)
            yield rows(out)
        if ends and current is not None:
            yield rows([(*current, place, _TAIL if place else _HEAD, "".join(open_text))])

    return cut


def in_file_order(pieces: DataFrame, path: str | Sequence[str]) -> DataFrame:
    """``pieces`` with ``at``, their place among all files in the order of their paths, for the columns
    that tell it. ``at`` orders by file, split and place."""
    spark = pieces.sparkSession
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("_path"))
    numbered = dense_ids(files.distinct(), ["_path"], "_number").select(
        F.xxhash64("_path").alias("file"), "_number")
    numbered = Scratch(spark, "files").table(numbered, "files")
    at = F.struct(F.col("_number").alias("file"), "split_start", "place").alias("at")
    return pieces.join(checked_broadcast(numbered), "file").select(
        at, *(c for c in pieces.columns if c not in ("file", "split_start", "place")))


def scan_chunks(
    spark: SparkSession, path: str | Sequence[str], tags: Sequence[str] = RECORD_TAGS
) -> DataFrame:
    """``at, body``: one row per record, its text followed by whatever stands before the next record, and
    its place in the dump.

    The text in front of a file's first record is a row as well. Files are read in splits. Lines with
    marks of comments or character data are read first, for the state in which each split begins.
    Only the pieces at the ends of splits, which still have to be joined, are written to the shared
    folder; all others go straight on to what reads them. Every step that reads the result cuts the dump
    anew, by tasks as many as its splits: written, it is so much smaller that a few tasks would read it all.
    """
    lines = lines_of(spark, path)
    marked = reduce(lambda a, b: a | b, (F.contains("value", F.lit(mark)) for mark in _STATE_MARKS))
    states = split_states(lines.where(marked), _state_after, 3)
    ends = Scratch(spark, "xml").table(lines.mapInArrow(_cut_at_records(tags, states, True), _SCAN_SCHEMA), "ends")
    inner = lines.mapInArrow(_cut_at_records(tags, states, False), _SCAN_SCHEMA).drop("part")
    return in_file_order(inner.unionByName(joined_at_splits(ends, LONGEST_CHUNK)), path)


def _record_of(body: Column, tags: Sequence[str], tag: Column) -> Column:
    """The record at the start of a chunk, without the text behind it."""
    names = "|".join(tags)
    record = F.regexp_extract(body, rf"(?s)^<({names})\b(?:[^>]*/>|.*?</\1\s*>)", 0)
    # What nearly all records are is found without the expression: the first end tag has no spaces, and
    # the start tag is none of an empty element.
    until_end = F.call_function("substring_index", body, F.concat(F.lit("</"), tag), F.lit(1))
    end = F.concat(F.lit("</"), tag, F.lit(">"))
    plain = ~F.substring_index(body, ">", 1).endswith("/") & F.startswith(
        F.substr(body, F.length(until_end) + 1), end)
    # A record without an end tag is kept whole, so that parsing reports it.
    return F.when(plain, F.concat(until_end, end)).when(record != "", record).otherwise(F.rtrim(body))


def records_of(chunks: DataFrame, tags: Sequence[str] = RECORD_TAGS) -> DataFrame:
    """``tag, xml`` of each record chunk, and its place ``at`` if it is known."""
    tag = F.regexp_extract("body", rf"^<({'|'.join(tags)})(?=[\s/>])", 1)
    return (
        chunks.withColumn("tag", tag)
        .where("tag != ''")
        .select(*(c for c in chunks.columns if c == "at"), "tag",
                _record_of(F.col("body"), tags, F.col("tag")).alias("xml"))
    )


def scan_records(
    spark: SparkSession, path: str | Sequence[str], tags: Sequence[str] = RECORD_TAGS
) -> DataFrame:
    """``at, tag, xml`` of every record in the files, including those of no publication."""
    return records_of(scan_chunks(spark, path, tags), tags)


def parse_records(records: DataFrame, schema: str = RECORD_SCHEMA) -> DataFrame:
    """Parse ``tag, xml`` publication records; others are skipped.

    Entities are decoded first. A record that cannot be parsed has its text in
    ``_corrupt_record``; its other columns hold what was read up to the error.
    """
    parsed = F.from_xml(
        decode_entities(F.col("xml")),
        schema,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    )
    return (
        records.where(F.col("tag").isin(PUBLICATION_TAGS))
        .select(*(c for c in records.columns if c == "at"), F.col("tag").alias("category"), "xml", parsed.alias("r"))
        .select("*", "r.*").drop("r")
    )


def read_tag(spark: SparkSession, path: str | Sequence[str], tag: str,
             schema: str = RECORD_SCHEMA) -> DataFrame:
    """Spark's own XML reader for one record element: for many small files without named
    entities, as every file is one task and every element needs its own pass."""
    parsed = spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
    return parsed.withColumn("category", F.lit(tag))


def _usable() -> Column:
    return F.col("_key").isNotNull() & F.col("_corrupt_record").isNull()


def good_records(parsed: DataFrame, strict: bool = False) -> DataFrame:
    """Well-formed records that have a key. With ``strict`` any other record fails the job."""
    if strict:
        problem = F.concat(F.lit("unusable record: "), "xml")
        return parsed.where(F.when(_usable(), F.lit(True)).otherwise(
            F.raise_error(problem).cast("boolean")))
    return parsed.where(_usable())


def rejected_records(parsed: DataFrame) -> DataFrame:
    """Records that cannot be used, with the reason."""
    reason = F.when(F.col("_corrupt_record").isNotNull(), "not well-formed").otherwise("no key")
    return parsed.where(~_usable()).select("category", reason.alias("reason"), "xml")


def parse_stats(parsed: DataFrame) -> DataFrame:
    """Total, parsed and failed records per record element."""
    return (
        parsed.groupBy("category")
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(_usable()).alias("parsed"))
        .withColumn("failed", F.col("total") - F.col("parsed"))
    )
