"""Exact numbers of distinct values of many columns.

One ``count(DISTINCT ...)`` over many columns expands every row to one per
column before anything is combined. Here each column is counted in the way
that moves least of it:

* whole numbers that span at most BITMAP_BITS: one bitmap per task, combined
  with ``bitmap_or_agg``, all such columns in one aggregation;
* columns with few values: one set per task (a dictionary of the column),
  merged in two levels in the same aggregation;
* whole numbers that lie densely in a wider range: one word of bits per 64
  numbers, so that a shuffled bit stands for a value. Words are combined with
  ``bit_or`` in a hash aggregation; Spark's bitmaps would be in a sort
  aggregation, which sorts every row by its bitmap first;
* anything else: the values themselves, combined per task, one shuffle for
  each column, which reads nothing but that column.

Which way a column takes is decided by estimates and bounds, as an ANALYZE
leaves them in the catalog; the counts are exact in each of them. Where nothing is
known of the columns, ``distinct_by_column`` takes the last way for all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The size of one bitmap is fixed by Spark's bitmap functions.
BITMAP_BITS = 32768
# Estimated values up to which a column is counted by sets.
SET_VALUES = 1024
# Estimated values per BITMAP_BITS numbers (two per word of bits) from which the
# words are smaller than the values.
DENSE = 1024
FAN_IN = 1024


@dataclass(frozen=True)
class Extent:
    """What is known of a column before it is counted: about how many
    values, and the smallest and largest of a whole number (None: no value)."""

    estimate: int
    low: int | None = None
    high: int | None = None


def is_whole(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def way_of(dtype: T.DataType, extent: Extent) -> str:
    """bitmap, set, bitmaps or values."""
    if is_whole(dtype) and extent.low is not None:
        span = extent.high - extent.low + 1
        if span <= BITMAP_BITS:
            return "bitmap"
        if extent.estimate > SET_VALUES and extent.estimate * BITMAP_BITS >= span * DENSE:
            return "bitmaps"
    return "set" if extent.estimate <= SET_VALUES else "values"


def _alike(name: str, dtype: T.DataType) -> Column:
    """The column with one form for every value: sets tell -0.0 from 0.0 and
    one NaN from the next, a distinct count does not."""
    column = F.col(f"`{name}`")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(column), column + F.lit(0.0).cast(dtype))
    return column


def _together(df: DataFrame, ways: Mapping[str, str], extents: Mapping[str, Extent]) -> list[int]:
    """Counts of the columns that are counted by one bitmap or set: a row of
    partial results per task, FAN_IN rows, one row."""
    types = {f.name: f.dataType for f in df.schema.fields}
    first, second, last = [], [], []
    for i, (name, way) in enumerate(ways.items()):
        if way == "bitmap":
            place = F.col(f"`{name}`").cast("long") - F.lit(extents[name].low)
            first.append(F.bitmap_construct_agg(place).alias(f"s{i}"))
            second.append(F.bitmap_or_agg(f"s{i}").alias(f"s{i}"))
            last.append(F.bitmap_count(f"s{i}").alias(f"n{i}"))
            continue
        first.append(F.collect_set(_alike(name, types[name])).alias(f"s{i}"))
        second.append(F.array_distinct(F.flatten(F.collect_list(f"s{i}"))).alias(f"s{i}"))
        size = F.size(f"s{i}").cast("long")
        if isinstance(types[name], (T.FloatType, T.DoubleType)):
            first.append(F.max(F.coalesce(F.isnan(f"`{name}`"), F.lit(False))).alias(f"x{i}"))
            second.append(F.max(f"x{i}").alias(f"x{i}"))
            size = size + F.coalesce(F.col(f"x{i}"), F.lit(False)).cast("long")
        last.append(size.alias(f"n{i}"))
    bucket = F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("bucket")
    row = df.groupBy(bucket).agg(*first).agg(*second).select(*last).first()
    return [int(x or 0) for x in row]


def _alone(df: DataFrame, name: str, way: str) -> DataFrame:
    """column, n of a column that is shuffled by itself."""
    column = F.col(f"`{name}`")
    values = df.select(column.alias("v")).where("v is not null")
    if way == "bitmaps":
        place = F.col("v").cast("long")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
        words = values.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
        counted = words.agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("long").alias("n"))
    else:
        counted = values.distinct().agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.lit(name).alias("column"), "n")


def distinct_by_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, n) of the distinct non-null values of each column,
    exactly and lazily. Nothing is known of the columns yet, so each is counted
    by its values: combined per task, shuffled by itself, read by itself."""
    return reduce(DataFrame.unionAll, [_alone(df, c, "values") for c in columns])


def distinct_counts(df: DataFrame, extents: Mapping[str, Extent]) -> dict[str, int]:
    """Distinct non-null values of each column of ``extents``, exactly. Runs
    at most two jobs; one number per column reaches the driver."""
    types = {f.name: f.dataType for f in df.schema.fields}
    ways = {name: way_of(types[name], extent) for name, extent in extents.items()}
    together = {k: w for k, w in ways.items() if w in ("bitmap", "set")}
    alone = [_alone(df, k, w) for k, w in ways.items() if k not in together]
    jobs = []
    if together:
        jobs.append(lambda: dict(zip(together, _together(df, together, extents), strict=True)))
    if alone:
        jobs.append(lambda: {r["column"]: r["n"] for r in reduce(DataFrame.unionAll, alone).collect()})  # one row per column
    if not jobs:
        return {}
    with ThreadPoolExecutor(len(jobs)) as pool:  # they read different columns: side by side
        return {k: n for counts in pool.map(lambda job: job(), jobs) for k, n in counts.items()}
