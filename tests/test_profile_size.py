"""What column profiles shuffle: nothing behind their rows twice, no row by
the bitmap that it belongs to."""

import os

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import Extent, distinct_counts
from tallyframe.operators import distinct as D
from tallyframe.plans import trips
from tallyframe.session import shared_dir


@pytest.fixture()
def counted(spark):
    """50 rows and an accumulator of how often one was made."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 50, 1, 2).select(
        (F.col("id") % 3).cast("int").alias("few"), (F.col("id") * 2000).alias("wide"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("t"), F.col("id") % 4)).alias("text"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("at"), (F.col("id") % 9 / 2.0).alias("real"),
    )
    return rows.mapInArrow(count, rows.schema), made


def _folders(spark):
    path = f"{shared_dir(spark)}/tables"
    return {x for x in os.listdir(path) if x.startswith("trip_profile")} if os.path.isdir(path) else set()


def test_rows_behind_a_profile_are_made_once(spark, counted):
    raw, made = counted
    before = _folders(spark)
    got = {r.column_name: r for r in trips.columns_profile(raw, trips.BOUND_RULES).collect()}
    assert made.value == 50
    assert {k: r.distinct_count for k, r in got.items()} == {"few": 3, "wide": 50, "text": 4, "at": 50, "real": 9}
    assert (got["text"].num_nulls, got["text"].max_len, got["at"].data_type) == (8, 2.0, "timestamp_ntz")
    assert _folders(spark) == before


def test_rows_behind_a_sketched_profile_are_made_once(spark, counted):
    raw, made = counted
    got = trips.columns_profile_sketched(raw, trips.BOUND_RULES).collect()
    assert made.value == 50
    assert len(got) == 5 and all(r.distinct_within_error for r in got)


def test_dense_columns_are_counted_without_a_sort(spark):
    values = [None, -(2**63), -65, -64, -1, 0, 63, 63, 64, 2**63 - 1] + list(range(100_000, 140_000, 3))
    df = spark.createDataFrame([(v,) for v in values], "v long")
    extent = Extent(40_000, -70_000, 140_000)
    assert D.way_of(df.schema["v"].dataType, extent) == "bitmaps"
    assert distinct_counts(df, {"v": extent}) == {"v": len(set(values)) - 1}
    plan = D._alone(df, "v", "bitmaps")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
