"""Counting and descriptive aggregates.

Every aggregation combines map-side before it shuffles, so a hot key costs
one partial row per task, never a whole group in one task. Totals used for
shares are taken from the already-aggregated rows through a scalar
subquery, which reuses the aggregation's exchange instead of scanning the
input again and needs no join. Sketch-based global aggregates (approximate
distinct counts, percentiles) reduce their per-task sketches in two levels
so the final merge has a bounded fan-in.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.bins import Band, band, decode
from tallyframe.functions.numeric import (
    ColumnOrName,
    col_of,
    pct,
    pct_change,
    rate_per_hour,
    round_half_up,
)
from tallyframe.operators.selection import select_ranks


def _named(c: ColumnOrName, name: str | None = None) -> Column:
    col = col_of(c)
    return col.alias(name) if name else col


def row_count(df: DataFrame, alias: str = "count") -> DataFrame:
    """One row: the number of rows."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def frequency(
    df: DataFrame,
    *keys: ColumnOrName,
    where: Column | None = None,
    min_count: int | None = None,
    order: bool = False,
    count_col: str = "count",
) -> DataFrame:
    """Rows per key value(s); optional pre-filter, HAVING and ordering."""
    if where is not None:
        df = df.filter(where)
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    if min_count is not None:
        out = out.filter(F.col(count_col) >= F.lit(min_count))
    if order:
        key_cols = [F.col(c).asc() for c in out.columns if c != count_col]
        out = out.orderBy(F.col(count_col).desc(), *key_cols)
    return out


def top_n(
    df: DataFrame,
    key: str,
    n: int,
    exclude: Sequence[object] | None = None,
    count_col: str = "count",
) -> DataFrame:
    """The ``n`` most frequent values of ``key`` (ties broken by key).

    Sort + limit plans as TakeOrderedAndProject: each task keeps its own
    top ``n`` and only those rows meet in the final merge.
    """
    where = None
    if exclude:
        where = ~F.col(key).isin(*exclude)
    counts = frequency(df, key, where=where, count_col=count_col)
    return counts.orderBy(F.col(count_col).desc(), F.col(key).asc()).limit(n)


def distinct_count(
    df: DataFrame, column: str, alias: str, approx: bool = False, rsd: float = 0.01, fan_in: int = 1024
) -> DataFrame:
    """One row: the number of distinct non-NULL values.

    Exact: values are de-duplicated per task, shuffled once, counted.
    ``approx=True``: a mergeable HLL sketch per task (relative error about
    ``rsd``), folded into ``fan_in`` buckets in parallel and then unioned
    once, so the final task never receives one sketch per input split.
    """
    if not approx:
        return df.agg(F.count_distinct(F.col(column)).alias(alias))
    lg_k = max(4, math.ceil(math.log2((1.04 / rsd) ** 2)))
    if lg_k > 21:
        raise ValueError(f"rsd={rsd} is finer than a sketch can give; count exactly")
    bucket = F.pmod(F.spark_partition_id(), F.lit(fan_in)).alias("_bucket")
    level1 = df.groupBy(bucket).agg(F.hll_sketch_agg(F.col(column), lg_k).alias("_s"))
    level2 = level1.agg(F.hll_union_agg("_s").alias("_s"))
    return level2.select(F.coalesce(F.hll_sketch_estimate("_s"), F.lit(0).cast("bigint")).alias(alias))


def avg_by(
    df: DataFrame, value: str, *keys: ColumnOrName, alias: str | None = None, digits: int = 2
) -> DataFrame:
    """Rounded mean of ``value`` per key."""
    return df.groupBy(*keys).agg(round_half_up(F.avg(value), digits).alias(alias or f"avg_{value}"))


def share_of_total(
    df: DataFrame,
    key: ColumnOrName,
    key_alias: str | None = None,
    digits: int = 2,
    pct_col: str = "Percentage_of_Total",
    labels: dict | None = None,
    label_default: str | None = None,
) -> DataFrame:
    """Percent of all rows per key value: ``round(count(key)/count(*)*100)``.

    ``count(key)`` skips NULL keys, so a NULL group scores 0 while its
    rows still count in the total. With ``labels`` the codes are
    aggregated first and decoded after, so two codes that share a label
    remain separate rows; the code is kept as ``<key>_code``.
    """
    k = _named(key, key_alias)
    # One aggregate, count(*), serves both the shares and the total, so the
    # total's subquery reuses the same exchange; count(key) differs from
    # count(*) only in the NULL group, where it is 0.
    grouped = df.groupBy(k).agg(F.count(F.lit(1)).alias("_rows"))
    name = grouped.columns[0]  # also right for a Column key
    total = grouped.agg(F.sum("_rows")).scalar()
    non_null = F.when(F.col(f"`{name}`").isNull(), F.lit(0)).otherwise(F.col("_rows"))
    if labels is not None:
        out_cols = [decode(F.col(f"`{name}`"), labels, label_default).alias(name), F.col(f"`{name}`").alias(f"{name}_code")]
    else:
        out_cols = [F.col(f"`{name}`")]
    return grouped.select(*out_cols, pct(non_null, total, digits).alias(pct_col))


def band_share(
    df: DataFrame,
    value: str,
    bands: Sequence[Band],
    band_col: str,
    other: str | None = "Other amount",
    digits: int = 2,
    pct_col: str = "Percentage_of_Total",
) -> DataFrame:
    """Percent of rows per value band."""
    banded = df.select(band(value, bands, other).alias(band_col))
    return share_of_total(banded, band_col, digits=digits, pct_col=pct_col)


def _kll(dtype: T.DataType) -> tuple:
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.kll_sketch_agg_bigint, F.kll_merge_agg_bigint, F.kll_sketch_get_quantile_bigint, "bigint"
    if isinstance(dtype, T.FloatType):
        return F.kll_sketch_agg_float, F.kll_merge_agg_float, F.kll_sketch_get_quantile_float, "float"
    return F.kll_sketch_agg_double, F.kll_merge_agg_double, F.kll_sketch_get_quantile_double, "double"


def mean_vs_percentiles(
    df: DataFrame,
    value: str,
    percentiles: Sequence[float] = (0.25, 0.5, 0.75),
    digits: int = 2,
    name: str | None = None,
    method: str = "exact",
    accuracy: int = 4096,
    fan_in: int = 1024,
) -> DataFrame:
    """One row: mean and percentiles of ``value``; a percentile is the
    smallest value whose rank reaches ``p``.

    ``method="exact"`` selects the ranks by narrowing (``operators.selection``):
    two scans of ``df``, run at once, of which the second one keeps only values
    near a wanted rank. The answer does not depend on the partitioning or on
    the sketch that proposes where to look.

    ``method="sketch"`` builds a mergeable KLL sketch (``k = accuracy``, rank
    error about 2/k) per task, folded into ``fan_in`` buckets before the final
    merge; ``method="gk"`` is ``percentile_approx`` (rank error 1/accuracy).
    Both are estimates that depend on the partitioning.
    """
    name = name or value
    mean_col = f"average_{name}"
    names = [f"p{round(p * 100):d}_{name}" for p in percentiles]
    if method == "gk":
        q = F.percentile_approx(value, list(percentiles), accuracy)
        stats = df.agg(round_half_up(F.avg(value), digits).alias(mean_col), q.alias("_q"))
        return stats.select(mean_col, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    if method == "sketch":
        return _sketched_percentiles(df, value, percentiles, accuracy, digits, mean_col, names, fan_in)
    if method != "exact":
        raise ValueError(f"no such method: {method}")
    found = select_ranks(df, value, lambda n: [math.ceil(n * p) for p in percentiles])
    ranks = [min(max(1, math.ceil(found.n * p)), max(1, found.n)) for p in percentiles]
    fields = [T.StructField(n, df.schema[value].dataType) for n in names]
    schema = T.StructType([T.StructField("_sum", T.DoubleType()), T.StructField("_n", T.LongType()), *fields])
    row = df.sparkSession.createDataFrame([(found.total, found.n, *[found.at.get(r) for r in ranks])], schema)
    return row.select(round_half_up(F.try_divide(F.col("_sum"), F.col("_n")), digits).alias(mean_col), *names)


def _sketched_percentiles(df, value, percentiles, accuracy, digits, mean_col, names, fan_in) -> DataFrame:
    sketch_agg, merge_agg, quantile, cast_to = _kll(df.schema[value].dataType)
    v = F.col(value).cast(cast_to)
    bucket = F.pmod(F.spark_partition_id(), F.lit(fan_in)).alias("_bucket")
    level1 = df.groupBy(bucket).agg(
        sketch_agg(v, F.lit(accuracy)).alias("_s"),
        F.sum(F.col(value).cast("double")).alias("_sum"),
        F.count(F.col(value)).alias("_n"),
    )
    level2 = level1.agg(merge_agg("_s").alias("_s"), F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))
    cols = [round_half_up(F.try_divide(F.col("_sum"), F.col("_n")), digits).alias(mean_col)]
    for p, n in zip(percentiles, names, strict=True):
        q = F.when(F.col("_n") > 0, quantile(F.col("_s"), F.lit(float(p))))
        cols.append(q.cast(df.schema[value].dataType).alias(n))
    return level2.select(*cols)


def correlation(df: DataFrame, x: str, y: str, alias: str = "correlation", digits: int | None = 6) -> DataFrame:
    """Pearson r over rows where both values are present.

    ``covar_pop / (stddev_pop * stddev_pop)`` with ``try_divide``: a
    constant column gives NULL rather than a division error.
    """
    xm = F.when(F.col(y).isNotNull(), F.col(x))
    ym = F.when(F.col(x).isNotNull(), F.col(y))
    r = F.try_divide(F.covar_pop(xm, ym), F.stddev_pop(xm) * F.stddev_pop(ym))
    if digits is not None:
        r = round_half_up(r, digits)
    return df.agg(r.alias(alias))


def avg_rate_by(
    df: DataFrame,
    amount: str,
    start: str,
    end: str,
    *keys: ColumnOrName,
    alias: str = "average_mph",
    digits: int = 2,
    where: Column | None = None,
) -> DataFrame:
    """Mean of the per-row hourly rate (each rate rounded first), per key.

    Rows with a zero duration have a NULL rate and do not enter the mean.
    The mean is taken to 12 digits before it is rounded: it is a sum of
    doubles, whose last bits must not decide where a value lies half-way.
    """
    if where is not None:
        df = df.filter(where)
    rate = rate_per_hour(amount, start, end, digits)
    return df.groupBy(*keys).agg(round_half_up(F.round(F.avg(rate), 12), digits).alias(alias))


def rate_vs_overall(
    df: DataFrame,
    amount: str,
    start: str,
    end: str,
    key: str,
    where: Column | None = None,
    alias: str = "pct_vs_overall",
    digits: int = 2,
    key_values: Sequence[Column] | None = None,
) -> DataFrame:
    """Percent by which each key's mean rate is above the overall mean.

    The overall mean (over all rows, rounded as reported) is a scalar
    subquery. With ``key_values`` the rows are aggregated once per key
    (sum and count of the rates): the overall mean is summed from those
    per-key totals, reusing the exchange, and the listed keys are picked
    from the same totals -- one pass. With a row predicate ``where``
    instead, the per-key means are taken over the rows it keeps (the
    predicate can reach the scan, the overall mean is a second pass).
    """
    rate = rate_per_hour(amount, start, end, digits)
    if key_values is None:
        overall = df.agg(round_half_up(F.avg(rate), digits)).scalar()
        subset = df.filter(where) if where is not None else df
        return subset.groupBy(key).agg(pct_change(F.avg(rate), overall, digits).alias(alias))
    per_key = df.groupBy(key).agg(F.sum(rate).alias("_s"), F.count(rate).alias("_n"))
    overall = per_key.agg(round_half_up(F.try_divide(F.sum("_s"), F.sum("_n")), digits)).scalar()
    # Reads the totals too, so the pick stays above the shared aggregation.
    picked = per_key.filter(F.when(F.col("_n") >= 0, F.col(key).isin(*key_values)))
    return picked.select(F.col(key), pct_change(F.try_divide(F.col("_s"), F.col("_n")), overall, digits).alias(alias))
