"""Counts that describe a dump before it is loaded."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from colophon.functions.markup import child_counts, element_names
from colophon.schemas import RECORD_TAGS


def record_tag_counts(records: DataFrame) -> DataFrame:
    """Records per record element."""
    return records.groupBy("tag").agg(F.count(F.lit(1)).alias("records"))


def child_tag_counts(records: DataFrame) -> DataFrame:
    """How often each direct child element occurs per record element; what children hold is not
    counted."""
    return (
        records.select("tag", F.explode(child_counts(F.col("xml"))).alias("child", "n"))
        .groupBy("tag", "child")
        .agg(F.sum("n").cast("long").alias("occurrences"))
    )


def tag_counts(texts: DataFrame, column: str) -> DataFrame:
    """How often each element occurs in markup texts."""
    return (
        texts.select(F.explode(element_names(F.col(column))).alias("tag"))
        .groupBy("tag")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def unexpected_elements(
    chunks: DataFrame, tags: Sequence[str] = RECORD_TAGS, strict: bool = False
) -> DataFrame:
    """Top-level elements that are no record elements, with their number.

    They stand before a file's first record or between a record's end and the next record. An
    element that holds records begins in one such gap and ends in another; it counts where it
    begins. The root is none of them: it is the first start tag after a file's XML or document type
    declaration, or without these the one that begins, but does not end, before the first record.
    With ``strict`` the job fails if there is one.
    """
    names = "|".join(tags)
    element = r"(?s)<([A-Za-z][\w-]*)\b(?:[^>]*/>|[^>]*>.*?</\1\s*>)"
    starts = F.col("body").rlike(rf"^<(?:{names})\b")
    declared = F.col("body").rlike(r"^\s*<[?!]")
    prolog = r"(?s)^(?:\s*<\?.*?\?>|\s*<!DOCTYPE[^>\[]*(?:\[.*?\])?[^>]*>)+\s*<[A-Za-z][\w-]*\b[^>]*>"
    gap = F.when(starts, F.regexp_replace("body", rf"(?s)^<({names})\b(?:[^>]*/>|.*?</\1\s*>)", "")).otherwise(
        F.regexp_replace("body", prolog, ""))
    whole = F.regexp_extract_all(gap, F.lit(element), F.lit(1))
    begun = F.regexp_extract_all(
        F.regexp_replace(gap, element, ""), F.lit(r"<([A-Za-z][\w-]*)\b[^>]*>"), F.lit(1))
    root = F.when(starts | declared, 0).otherwise(1)
    elements = F.concat(whole, F.slice(begun, root + 1, F.size(begun) + 1))
    found = (
        chunks.select(F.explode(elements).alias("tag"))
        .groupBy("tag")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    if strict:
        found = found.where(
            F.raise_error(F.concat(F.lit("unexpected element: "), "tag")).isNull()
        )
    return found


def values_outside(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values of a column that are not allowed, with their number of rows."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.where(~F.col("value").isin(list(allowed)))


def distinct_attribute_values(
    records: DataFrame, attributes: Mapping[str, str]
) -> DataFrame:
    """Distinct values of one attribute per child element, e.g. ``{"note": "type"}``."""
    found = None
    for element, name in attributes.items():
        rows = records.select(
            F.lit(element).alias("element"),
            F.explode(F.col(element)[f"_{name}"]).alias("value"),
        ).where("value is not null").distinct()
        found = rows if found is None else found.unionByName(rows)
    return found
