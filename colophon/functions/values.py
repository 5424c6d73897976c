"""Column expressions for typed values: casts, blanks, months, page ranges, flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from colophon.schemas import MONTHS


def safe_int(col: Column, kind: str = "smallint") -> Column:
    """Whole number of the given type, or null if the text is none or does not fit."""
    return F.trim(col).try_cast(kind)


def blank_to_null(col: Column) -> Column:
    """Trimmed text; null if nothing is left."""
    return F.nullif(F.trim(col), F.lit(""))


def integral(col: Column, kind: str = "long") -> Column:
    """Whole number from text such as ``1991`` or ``1991.0``; any other text gives null."""
    return F.regexp_replace(F.trim(col), r"\.0+$", "").try_cast(kind)


def month_number(col: Column) -> Column:
    """1..12 from a month name (any case) or number, else null."""
    name = F.lower(F.trim(col))
    by_name = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name).cast("int")
    number = safe_int(col, "int")
    return F.coalesce(F.nullif(by_name, F.lit(0)), F.when(number.between(1, 12), number))


def page_range(col: Column) -> Column:
    """``struct(lo, hi)`` from ``a-b`` or ``a``; null if an end is not a whole number.

    Of more than two parts only the first two count.
    """
    parts = F.split(col, "-")
    first = safe_int(parts[0], "int")
    last = F.when(F.size(parts) == 1, first).otherwise(safe_int(F.get(parts, F.lit(1)), "int"))
    return F.when(
        first.isNotNull() & last.isNotNull(),
        F.struct(F.least(first, last).alias("lo"), F.greatest(first, last).alias("hi")),
    )


def has_flag(types: Column, flag: str) -> Column:
    """Whether the type list of a link contains ``flag``; a missing list has no flags."""
    return F.coalesce(F.contains(types, F.lit(flag)), F.lit(False))


def last_value(values: Column) -> Column:
    """The last of repeated values; null if there is none."""
    return F.try_element_at(values, F.lit(-1))
