"""Column helpers of the operators here: names that may clash, texts that may be null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# The word separators of the contracts: space and the five ASCII white-space controls.
SEPARATORS = " \t\n\x0b\x0c\r"


def narrow(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns. Extra columns of any name are left out, so they cannot clash."""
    return df.select(*names)


def whole(text: str = "text") -> Column:
    """The text, a null read as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def words_of(text: Column) -> Column:
    """The maximal runs of characters that are no separators."""
    return F.array_remove(F.split(text, "[ \\x09-\\x0D]+"), "")


def count_of(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are among ``characters``."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def total(items: Column, zero: str = "long") -> Column:
    """Sum of an array of numbers; 0 of an empty one."""
    return F.aggregate(items, F.lit(0).cast(zero), lambda a, x: a + x.cast(zero))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value made once, however often it is named: lambdas make whatever stands
    outside them anew for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def gathered(items: Column, zero: Column, step, kind: str, block: int = 128) -> Column:
    """What ``step(state, item)`` gives for every item, as one array of type ``kind``: it returns the next
    state and an array to append.

    Appending copies an array, so items are handled in blocks, each with an array of its own; that
    keeps the work of a long array in about the proportion of its length.
    """
    def one(a, x):
        state, out = step(a["state"], x)
        return F.struct(state.alias("state"), F.concat(a["out"], out).alias("out"))

    def whole_block(a, part):
        done = F.aggregate(part, F.struct(a["state"].alias("state"), F.array().cast(kind).alias("out")), one)
        return bound(done, lambda d: F.struct(d["state"].alias("state"), F.array_append(a["all"], d["out"]).alias("all")))

    def in_blocks(all_items):
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_items) - 1) / block).cast("int"))
        blocks = F.transform(numbers, lambda b: F.slice(all_items, b * block + 1, F.lit(block)))
        start = F.struct(zero.alias("state"), F.array().cast(f"array<{kind}>").alias("all"))
        return F.when(F.size(all_items) > 0, F.aggregate(blocks, start, whole_block, lambda a: F.flatten(a["all"]))).otherwise(
            F.array().cast(kind))

    return bound(items, in_blocks)
