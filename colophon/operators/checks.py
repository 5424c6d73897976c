"""Constraint checks that return the violations as rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from colophon import schemas

Tables = Mapping[str, DataFrame]


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def domain_violations(tables: Tables, domains=schemas.DOMAINS) -> DataFrame:
    """Values outside a closed domain, by table and column; nulls are allowed. One pass per
    table for all its columns: only values outside are counted."""
    by_table: dict[str, dict[str, Sequence]] = {}
    for (table, column), allowed in domains.items():
        if table in tables:
            by_table.setdefault(table, {})[column] = allowed

    def check(table, columns):
        outside = F.array_compact(F.array(*[
            F.when(~F.col(c).isin(list(allowed)), F.struct(
                F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
            for c, allowed in columns.items()]))
        return tables[table].select(F.inline(outside)).groupBy("column_name", "value").agg(
            F.count(F.lit(1)).alias("rows")).select(
            F.lit(table).alias("table_name"), "column_name", "value", "rows")

    return _union(check(t, c) for t, c in by_table.items())


def null_violations(tables: Tables, not_null=schemas.NOT_NULL) -> DataFrame:
    """Number of nulls per required column; one pass per table for all its columns."""
    def check(table, columns):
        counted = tables[table].agg(
            *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        return counted.unpivot([], list(columns), "column_name", "nulls").select(
            F.lit(table).alias("table_name"), "column_name", "nulls")

    return _union(check(t, c) for t, c in not_null.items() if t in tables)


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with the number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def unique_violations(df: DataFrame, columns: Sequence[str], covered: str | None = None
                      ) -> DataFrame:
    """Like ``key_violations`` for a unique index: rows with a null never collide, and
    ``covered`` limits the index to some rows."""
    rows = df.where(covered) if covered else df
    return key_violations(rows.dropna(subset=list(columns)), columns)


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign key values without a parent row, with the number of rows that hold them."""
    found = _unmatched([child.select(F.col(foreign_key).alias("value"))], parent.select(F.col(key).alias("value")))
    return found.select(F.col("value").cast(child.schema[foreign_key].dataType), F.col("n0").alias("rows"))


def _unmatched(children: Sequence[DataFrame], parent: DataFrame) -> DataFrame:
    """``value, n0, n1, ...``: values of the children that the parent lacks, with the rows of each child.

    Rows of all sides are counted by value in one aggregate, so nothing is sorted or broadcast, a value that many
    rows hold is no single task's work, and a parent that repeats its values is reduced before it is moved.
    """
    every = _union(
        side.where("value is not null").select("value", *[F.lit(int(i == own)).cast("long").alias(f"n{i}")
                                                          for i in range(len(children))],
                                               F.lit(int(own < 0)).alias("known"))
        for own, side in [*enumerate(children), (-1, parent)])
    return every.groupBy("value").agg(
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(children))], F.max("known").alias("known")
    ).where("known = 0").drop("known")


def all_orphans(tables: Tables, foreign_keys=schemas.FOREIGN_KEYS) -> DataFrame:
    """``reference, value, rows`` of all foreign key values without a parent row. The values of
    all children of a parent are stacked, so each parent is read once."""
    by_parent: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for child, column, parent, key in foreign_keys:
        if child in tables and parent in tables:
            by_parent.setdefault((parent, key), []).append((child, column))

    def check(parent, key, children):
        found = _unmatched([tables[child].select(F.col(column).cast("string").alias("value"))
                            for child, column in children],
                           tables[parent].select(F.col(key).cast("string").alias("value")))
        counts = F.array(*[F.struct(F.lit(f"{child}.{column} -> {parent}.{key}").alias("reference"), "value",
                                    F.col(f"n{i}").alias("rows")) for i, (child, column) in enumerate(children)])
        return found.select(F.inline(counts)).where("rows > 0")

    return _union(check(*parent, children) for parent, children in by_parent.items())


def width_violations(tables: Tables, widths=schemas.WIDTHS) -> DataFrame:
    """Columns with texts longer than allowed: number of such rows and the longest length. One
    pass per table for all its columns."""
    by_table: dict[str, dict[str, int]] = {}
    for (table, column), width in widths.items():
        if table in tables:
            by_table.setdefault(table, {})[column] = width

    def check(table, columns):
        found = F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit(w).alias("width"),
                     F.count_if(F.length(c) > w).alias("too_long"),
                     F.max(F.length(c)).alias("longest"))
            for c, w in columns.items()])
        return tables[table].agg(found.alias("found")).select(
            F.lit(table).alias("table_name"), F.inline("found"))

    return _union(check(t, c) for t, c in by_table.items())


def integrity_report(
    tables: Tables,
    primary_keys=schemas.PRIMARY_KEYS,
    not_null=schemas.NOT_NULL,
    unique=schemas.UNIQUE,
    foreign_keys=schemas.FOREIGN_KEYS,
    domains=schemas.DOMAINS,
    widths=schemas.WIDTHS,
) -> DataFrame:
    """One row per rule with the number of violations, for all rules on the given tables."""
    def count(kind, rule, violations: DataFrame):
        return violations.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(kind).alias("kind"), F.lit(rule).alias("rule"), "violations")

    parts = [count("primary key", f"{t}({', '.join(k)})", key_violations(tables[t], k))
             for t, k in primary_keys.items() if t in tables]
    parts += [count("unique", f"{t}({', '.join(c)})" + (f" where {w}" if w else ""),
                    unique_violations(tables[t], c, w))
              for t, c, w in unique if t in tables]
    def by_rule(kind, rules, found: DataFrame):
        """Violations counted by rule; rules without any have none."""
        listed = F.explode(F.array(*[F.lit(r) for r in rules])).alias("rule")
        every = found.sparkSession.range(1).select(listed, F.lit(0).cast("long").alias("n"))
        return found.select("rule", F.lit(1).cast("long").alias("n")).unionAll(every).groupBy("rule").agg(
            F.sum("n").alias("violations")).select(F.lit(kind).alias("kind"), "rule", "violations")

    references = [f"{c}.{fk} -> {p}.{k}" for c, fk, p, k in foreign_keys if c in tables and p in tables]
    if references:
        parts.append(by_rule("foreign key", references, all_orphans(tables, foreign_keys).select(
            F.col("reference").alias("rule"))))
    if not_null:
        parts.append(null_violations(tables, not_null).select(
            F.lit("not null").alias("kind"),
            F.concat_ws(".", "table_name", "column_name").alias("rule"),
            F.col("nulls").alias("violations")))
    if widths:
        parts.append(width_violations(tables, widths).select(
            F.lit("width").alias("kind"),
            F.concat_ws(".", "table_name", "column_name").alias("rule"),
            F.col("too_long").alias("violations")))
    limited = [f"{t}.{c}" for t, c in domains if t in tables]
    if limited:
        parts.append(by_rule("domain", limited, domain_violations(tables, domains).select(
            F.concat_ws(".", "table_name", "column_name").alias("rule"))))
    return _union(parts)
