"""The most frequent values of a key with very many values.

Counting every value shuffles every value. Where a few of them hold much of
the rows, a sketch finds them: a frequent-items sketch per task, merged in
two levels, names at most ``tracked`` candidates, and a second scan counts
these exactly. The sketch's error bound then proves the answer: a value that
is no candidate occurs less often than that bound allows, so if the n-th
candidate occurs more often, no value is missing. Where it does not prove it,
because the counts are too even, every value is counted after all. Either
way the counts are exact and ties go to the smaller key.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.aggregate import top_n

TRACKED = 8192
FAN_IN = 1024


@dataclass(frozen=True)
class HeavyHitters:
    """The counted candidates, most frequent first; rows in all, and the
    number of rows that any other value stays below."""

    counts: DataFrame
    n_rows: int
    bound: int


def _map_size(tracked: int) -> int:
    """The sketch's table: a power of two that ``tracked`` items fill to
    three quarters at most (the rule of the sketch, a fixed value)."""
    return 1 << math.ceil(math.log2(tracked / 0.75))


def heavy_hitters(df: DataFrame, key: str, tracked: int = TRACKED, count_col: str = "count") -> HeavyHitters:
    """Exact counts of the values that a sketch takes for the most frequent.

    A sketch with a table of m entries is off by at most 3.5 / m of the rows,
    and reports no value that it is not sure of, so a value that is not
    reported occurs in at most twice that share of them."""
    spark = df.sparkSession
    bucket = F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("bucket")
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"))
    level = rows.groupBy(bucket).agg(
        F.call_function("approx_top_k_accumulate", F.col("k"), F.lit(tracked)).alias("s"), F.count(F.lit(1)).alias("n")
    )
    # By a constant: an empty table then has no sketch, which has no estimate.
    merged = level.groupBy(F.lit(0).alias("all")).agg(F.call_function("approx_top_k_combine", F.col("s"), F.lit(tracked)).alias("s"), F.sum("n").alias("n"))
    row = merged.select(F.call_function("approx_top_k_estimate", F.col("s"), F.lit(tracked)).alias("top"), "n").first()
    n = row.n if row else 0
    found = [(x["item"],) for x in row.top] if row else []
    candidates = spark.createDataFrame(found, df.select(F.col(key).alias("k")).schema)
    # At most ``tracked`` values, whatever the size of the table.
    counted = rows.join(F.broadcast(candidates), "k", "left_semi").groupBy(F.col("k").alias(key)).agg(F.count(F.lit(1)).alias(count_col))
    bound = math.ceil(2 * 3.5 / _map_size(tracked) * n)
    return HeavyHitters(counted.orderBy(F.col(count_col).desc(), F.col(key).asc()), n, bound)


def top_n_heavy(df: DataFrame, key: str, n: int, tracked: int = TRACKED, count_col: str = "count") -> DataFrame:
    """The ``n`` most frequent non-null values, as ``aggregate.top_n`` gives
    them. Runs the sketch and the recount at once; what reaches the driver is
    ``n`` rows."""
    heavy = heavy_hitters(df, key, tracked, count_col)
    top = heavy.counts.limit(n).collect()
    if len(top) == n and top[-1][count_col] > heavy.bound:
        return df.sparkSession.createDataFrame(top, heavy.counts.schema)
    return top_n(df.where(F.col(key).isNotNull()), key, n, count_col=count_col)
