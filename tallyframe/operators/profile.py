"""Profiling: samples, shape, period coverage, column and NULL statistics.

Statistics over N columns are gathered in one scan and one aggregation,
not N jobs, and nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.distinct import Extent, distinct_by_column, distinct_counts, is_whole

# Text tokens treated as a missing value in string columns
# (compared after trimming and lower-casing).
PLACEHOLDER_TOKENS = ("", "nan", "null", "none", "na", "n/a")


def sample_rows(df: DataFrame, n: int, order_by: Sequence[str] | None = None) -> DataFrame:
    """``n`` rows for inspection, ordered so the pick is repeatable.

    Without ``order_by`` every column is a sort key. Each task keeps its
    own first ``n`` (TakeOrderedAndProject) before the final merge.
    """
    keys = list(order_by) if order_by else df.columns
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in keys]).limit(n)


def period_profile(df: DataFrame, ts: str, value: str, count_col: str = "count") -> DataFrame:
    """Non-NULL ``value`` count per (year, month) of ``ts``."""
    return df.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month")).agg(
        F.count(F.col(value)).alias(count_col)
    )


def describe_shape(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the table's shape."""
    fields = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(F.explode(F.array(*fields)).alias("c"), "n_rows").select(
        "c.position", "c.column_name", "c.data_type", "n_rows", F.lit(len(fields)).alias("n_columns")
    )


def _is_text(dt: T.DataType) -> bool:
    return isinstance(dt, (T.StringType, T.VarcharType, T.CharType))


def _column_stats(df: DataFrame, fields: Sequence[T.StructField], rsd: float | None) -> DataFrame:
    """One row of NULLs, min, max, lengths and (with ``rsd``) estimated
    distinct values.

    Text columns are aggregated apart from the others: a text min or max
    cannot be kept in a hash aggregation's buffer, and next to it the
    statistics of all columns would be gathered by a sort aggregation without
    generated code."""
    parts = []
    for text in (False, True):
        aggs = []
        for i, f in enumerate(fields):
            if _is_text(f.dataType) != text:
                continue
            c = F.col(f"`{f.name}`")
            aggs += [
                F.count_if(c.isNull()).alias(f"n{i}"),
                F.min(c).cast("string").alias(f"lo{i}"),
                F.max(c).cast("string").alias(f"hi{i}"),
            ]
            if rsd is not None:
                aggs.append(F.approx_count_distinct(c, rsd).alias(f"d{i}"))
            if text:
                aggs += [F.avg(F.length(c)).alias(f"al{i}"), F.max(F.length(c)).cast("double").alias(f"ml{i}")]
        if aggs:
            parts.append(df.agg(*aggs))
    return parts[0] if len(parts) == 1 else parts[0].join(parts[1])  # one row each


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, exact_distinct: bool = True, rsd: float = 0.05,
    staged: bool = False,
) -> DataFrame:
    """Per column: NULLs, distinct values, min, max, text length stats.

    One row per column with ``column_name, data_type, num_nulls,
    distinct_count, min_value, max_value, avg_len, max_len`` (min and max
    compared in the column's own type, then shown as text; lengths for
    text columns only, as doubles so that the NULLs of other columns never
    turn the column into a nullable integer).

    NULLs, min, max and lengths come from one aggregation of the columns
    that are text and one of the others. Exact distinct counts are counted
    column by column (``operators.distinct``): no row is expanded to one per
    column, each shuffle carries one column's different values, and the columns
    are counted side by side. ``exact_distinct=False`` puts a HyperLogLog++
    estimate (relative error ``rsd``) into the aggregations instead: no shuffle
    of values. With ``staged`` the aggregations are run at once, estimates
    included, and what they find chooses how each column is counted: by
    bitmaps, by sets or by its values (``distinct.distinct_counts``).
    """
    wanted = set(columns) if columns else None
    fields = [f for f in df.schema.fields if wanted is None or f.name in wanted]
    if staged and exact_distinct:
        return _staged_profile(df, fields, rsd)
    stats = _column_stats(df, fields, None if exact_distinct else rsd)
    rows = []
    for i, f in enumerate(fields):
        text = _is_text(f.dataType)
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"n{i}").alias("num_nulls"),
                (F.lit(None).cast("long") if exact_distinct else F.col(f"d{i}")).alias("distinct_count"),
                F.col(f"lo{i}").alias("min_value"),
                F.col(f"hi{i}").alias("max_value"),
                (F.col(f"al{i}") if text else F.lit(None).cast("double")).alias("avg_len"),
                (F.col(f"ml{i}") if text else F.lit(None).cast("double")).alias("max_len"),
            )
        )
    found = stats.select(F.explode(F.array(*rows)).alias("p")).select("p.*")
    if not exact_distinct:
        return found
    counts = distinct_by_column(df, [f.name for f in fields])
    # One row per column on either side.
    joined = found.join(counts, found["column_name"] == counts["column"])
    return joined.select(*[F.col("n").alias(c) if c == "distinct_count" else F.col(c) for c in found.columns])


PROFILE_SCHEMA = (
    "column_name string, data_type string, num_nulls long, distinct_count long, "
    "min_value string, max_value string, avg_len double, max_len double"
)


def _staged_profile(df: DataFrame, fields: Sequence[T.StructField], rsd: float) -> DataFrame:
    row = _column_stats(df, fields, rsd).first().asDict()  # one row
    extents = {}
    for i, f in enumerate(fields):
        whole = is_whole(f.dataType) and row[f"lo{i}"] is not None
        bounds = (int(row[f"lo{i}"]), int(row[f"hi{i}"])) if whole else ()
        extents[f.name] = Extent(row[f"d{i}"], *bounds)
    counts = distinct_counts(df, extents)
    table = [
        (f.name, f.dataType.simpleString(), row[f"n{i}"], counts[f.name], row[f"lo{i}"], row[f"hi{i}"], row.get(f"al{i}"), row.get(f"ml{i}"))
        for i, f in enumerate(fields)
    ]
    return df.sparkSession.createDataFrame(table, PROFILE_SCHEMA)


def null_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    placeholders: Sequence[str] | None = PLACEHOLDER_TOKENS,
) -> DataFrame:
    """One row: ``Nulls_<col>`` per column, and ``Placeholders_<col>`` for
    text columns counting blank or ``nan``-like tokens that hide a missing
    value."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    columns = list(columns) if columns else df.columns
    aggs = [F.count_if(F.col(c).isNull()).alias(f"Nulls_{c}") for c in columns]
    if placeholders:
        for c in columns:
            if _is_text(types[c]):
                token = F.lower(F.trim(F.col(c)))
                aggs.append(F.count_if(token.isin(*placeholders)).alias(f"Placeholders_{c}"))
    return df.agg(*aggs)
