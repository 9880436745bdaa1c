"""Replacing sentinel values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mode_of(df: DataFrame, column: str, exclude: Sequence[object] = ()) -> DataFrame:
    """One row: the most frequent non-NULL value outside ``exclude``
    (ties go to the smallest value)."""
    valid = F.col(column).isNotNull()
    if exclude:
        valid = valid & ~F.col(column).isin(*exclude)
    counts = df.filter(valid).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.col("_n").desc(), F.col(column).asc()).limit(1).select(column)


def recode_to_mode(df: DataFrame, column: str, sentinels: Sequence[object]) -> DataFrame:
    """Replace sentinel values of ``column`` by its most frequent valid value.

    The mode is a scalar subquery (one row by construction); the rewrite
    itself is a projection, so the rows stay where they are.
    """
    mode = mode_of(df, column, sentinels).scalar()
    c = F.col(column)
    return df.withColumn(column, F.when(c.isin(*sentinels), mode).otherwise(c))


def recoded_frequency(df: DataFrame, column: str, sentinels: Sequence[object], count_col: str = "count") -> DataFrame:
    """Rows per value of ``column`` after ``recode_to_mode``, from one pass.

    The rows are counted once; the mode is the top valid value of those
    counts (a scalar subquery that reuses the same exchange), and the
    sentinel groups are relabelled and summed into it -- the recode runs on
    the small table of counts, not on the rows.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    valid = F.col(column).isNotNull() & ~F.col(column).isin(*sentinels)
    # Invalid values are ranked last rather than filtered out: a filter on
    # the grouping key would be pushed below this branch's aggregation and
    # stop it from sharing the exchange with ``counts``.
    top = counts.orderBy(F.when(valid, F.col("_n")).desc_nulls_last(), F.col(column).asc()).limit(1)
    mode = top.select(F.when(valid, F.col(column))).scalar()
    c = F.col(column)
    relabelled = counts.select(F.when(c.isin(*sentinels), mode).otherwise(c).alias(column), "_n")
    return relabelled.groupBy(column).agg(F.sum("_n").alias(count_col))
