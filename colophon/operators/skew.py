"""Joins that stay balanced and never broadcast more than a checked amount."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from colophon.session import Scratch

# A side is broadcast only after its rows were counted, and if they cannot take more than this
# many bytes: half a million narrow rows are some tens of megabytes.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
# So many keys are pushed into a scan as a list (see the session's inFilterThreshold).
LISTED_KEYS = 200
# A key is hot if it holds more than this share of the rows, so there are at most 10,000.
HOT_SHARE = 1e-4
# A key with fewer rows than this is never hot; it keeps the list of candidates short.
HOT_ROWS = 100
# So many narrow rows are held by the hash table of one task.
TASK_ROWS = 400_000


def distinct_in_tasks(df: DataFrame, rows: int) -> DataFrame:
    """The distinct ones of so many narrow rows. The number of tasks follows the rows, as partitions of a size in
    bytes would be joined to few of which each holds millions. Few rows are left to the planner."""
    return in_tasks(df, rows // TASK_ROWS + 1, *df.columns).distinct()


def in_tasks(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """``df`` dealt by the keys over that many tasks, whatever its bytes; one task is left to the planner."""
    return df.repartition(tasks, *keys) if tasks > 1 else df


def is_small(df: DataFrame, rows: int | None = None) -> bool:
    """Whether a written table has at most ``BROADCAST_ROWS`` rows, and texts of at most
    ``BROADCAST_BYTES`` in all. If its number of ``rows`` is not known, it is read from the file
    footers; texts are only measured in tables of few rows."""
    if (df.count() if rows is None else rows) > BROADCAST_ROWS:
        return False
    texts = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in df.dtypes if kind == "string"]
    if not texts:
        return True
    size = df.agg(F.sum(sum(texts, F.lit(0))).alias("bytes")).first()["bytes"]
    return (size or 0) <= BROADCAST_BYTES


def checked_broadcast(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it is small, else ``df`` for a shuffle join.

    ``df`` should be a written table, as it is counted here and read again in the join.
    """
    return F.broadcast(df) if is_small(df, rows) else df


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: str,
    hot_share: float = HOT_SHARE,
    lookup_rows: int | None = None,
    counted: str | None = None,
) -> DataFrame:
    """``fact`` left join ``lookup`` on a key that is unique in ``lookup``.

    A small lookup is broadcast. For a big one, keys that hold more than ``hot_share`` of the
    fact rows (at most ``1 / hot_share`` keys, whatever the data, and whether the lookup has them
    or not) are looked up by broadcast, null keys are not looked up at all, and only the other
    rows go through a shuffle join, so no task gets a hot key's rows. ``lookup`` should be a
    written table; ``fact`` is read three times, or twice if ``counted`` names a column of ``lookup`` that
    holds the number of fact rows of each key. Then both should be narrow, and the number of tasks follows
    the rows, as each task sorts its own.
    """
    if is_small(lookup, lookup_rows):
        return fact.join(F.broadcast(lookup), on, "left")
    rows = Observation()
    if counted is None:
        counts = fact.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("_n"))
    else:
        counts = lookup.select(on, F.col(counted).alias("_n"))
    often = Scratch(fact.sparkSession, "hot").table(
        counts.observe(rows, F.sum("_n").alias("total")).where(F.col("_n") >= HOT_ROWS), "keys")
    total = rows.get["total"] or 0
    hot = F.broadcast(often.where(F.col("_n") > total * hot_share).select(
        F.col(on).alias("_hot_key")))
    columns = fact.columns + [c for c in lookup.columns if c != on]
    marked = fact.join(hot, F.col(on) == F.col("_hot_key"), "left")
    apart = F.col("_hot_key").isNotNull() | F.col(on).isNull()
    hot_rows = lookup.join(hot, F.col(on) == F.col("_hot_key"), "left_semi")
    resolved = marked.where(apart).drop("_hot_key").join(F.broadcast(hot_rows), on, "left")
    # A lookup that counts the rows has no more of its own.
    tasks = 1 if counted is None else total // TASK_ROWS + 1
    rest = in_tasks(marked.where(~apart).drop("_hot_key"), tasks, on).join(in_tasks(lookup, tasks, on), on, "left")
    return resolved.select(*columns).unionByName(rest.select(*columns))


def prune_to(
    big: DataFrame, keys: DataFrame, big_key: str, key: str, rows: int | None = None
) -> DataFrame:
    """Rows of ``big`` whose key is in the written table ``keys`` of that many ``rows``.

    A few keys become a list in the filter, which the scan checks against the statistics and
    bloom filters of its files; more are a broadcast filter; too many for that a shuffle
    semi-join.
    """
    wanted = keys.select(F.col(key).alias(big_key)).where(F.col(big_key).isNotNull())
    rows = wanted.count() if rows is None else rows
    if rows <= min(LISTED_KEYS, BROADCAST_ROWS):
        return big.where(F.col(big_key).isin(list({r[0] for r in wanted.collect()})))
    return big.join(checked_broadcast(wanted, rows), big_key, "left_semi")
