"""Summary statistics of measured values and of component sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from colophon.operators.ordering import dense_ids


def exact_median(df: DataFrame, group: str, value: str, tie: str) -> DataFrame:
    """``group, median`` without bringing a group together in one task.

    All values are ranked by one distributed sort; the middle ranks of each group give the
    median. ``tie`` is a unique column that spreads equal values.
    """
    values = df.select(group, value, tie).where(F.col(value).isNotNull())
    ranked = dense_ids(values, [group, value, tie], "_rank")
    ends = F.min("_rank") + F.max("_rank")
    middle = F.array_distinct(F.array(F.floor(ends / 2), F.ceil(ends / 2)))
    wanted = ranked.groupBy(group).agg(middle.alias("_middle")).select(
        F.explode("_middle").alias("_rank"))
    return ranked.join(wanted, "_rank").groupBy(group).agg(F.avg(value).alias("median"))


def summary_stats(df: DataFrame, run: str, value: str, label: str, order: str) -> DataFrame:
    """Per run: min, max, median, mean, sample deviation, sum, count and the labels of the
    largest and smallest value (of several, the first in ``order``, a unique number)."""
    keyed = F.col(value)
    basic = df.groupBy(run).agg(
        F.min(keyed).alias("min"),
        F.max(keyed).alias("max"),
        F.avg(keyed).alias("mean"),
        F.stddev_samp(keyed).alias("std"),
        F.sum(keyed).alias("sum"),
        F.count(keyed).alias("count"),
        F.max_by(label, F.when(keyed.isNotNull(), F.struct(keyed, -F.col(order)))).alias(
            "arg_max"),
        F.min_by(label, F.when(keyed.isNotNull(), F.struct(keyed, F.col(order)))).alias(
            "arg_min"),
    )
    return basic.join(exact_median(df, run, value, order), run, "left")


def summary_of_runs(df: DataFrame, run: str, value: str) -> DataFrame:
    """Mean and sample deviation of the runs' sums."""
    sums = df.groupBy(run).agg(F.sum(value).alias("s"))
    return sums.agg(
        F.count("s").alias("runs"), F.avg("s").alias("mean"), F.stddev_samp("s").alias("std"))


PERCENTILES = [1, 5, 10, 25, 50, 75, 90, 95, 99, 100]


def size_distribution(sizes: DataFrame, size: str = "size") -> DataFrame:
    """Number of sets and exact percentiles of their sizes.

    The aggregate keeps one counter per distinct size. The sizes of all sets add up to the
    number of vertices, so there are only about its square root of them.
    """
    return sizes.agg(
        F.count(F.lit(1)).alias("set_count"),
        *[
            F.expr(f"percentile_disc({p / 100}) within group (order by `{size}`)")
            .cast("long").alias(f"p{p}")
            for p in PERCENTILES
        ],
    )
