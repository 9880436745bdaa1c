"""Exact distinct counts in every way, stored sketches, heavy hitters and
order-free checksums."""

import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import (
    Extent,
    column_profile,
    content_checksums,
    distinct_counts,
    distinct_from_sketches,
    heavy_hitters,
    reconcile_contents,
    stated_error,
    top_n,
    top_n_heavy,
    write_distinct_sketches,
)
from tallyframe.operators import distinct as D
from tallyframe.operators import heavy as H
from tallyframe.sources import table_location


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(2)
    rows = [
        (
            rng.choice([None, -5, 7, 30_000]), i * 3 - 70_000, rng.randrange(10**12), rng.choice("abc"), f"t{i % 3000}",
            rng.choice([0.0, -0.0, float("nan"), 1.5, None]), float(i) if i % 2 else float("nan"), None,
        )
        for i in range(60_000)
    ]
    schema = "narrow int, dense bigint, sparse bigint, few string, many string, real double, reals double, none int"
    return spark.createDataFrame(rows, schema).cache()


def test_distinct_counts_equal_count_distinct(mixed):
    want = mixed.agg(*[F.count_distinct(F.col(c)).alias(c) for c in mixed.columns]).first().asDict()
    for staged in (False, True):
        assert {r.column_name: r.distinct_count for r in column_profile(mixed, staged=staged).collect()} == want
    # The ways are as expected, and a wrong estimate changes no count.
    extents = {
        "narrow": Extent(3, -5, 30_000), "dense": Extent(60_000, -70_000, 109_997), "sparse": Extent(60_000, 0, 10**12),
        "few": Extent(3), "many": Extent(3000), "real": Extent(3), "reals": Extent(30_000), "none": Extent(0),
    }
    types = {f.name: f.dataType for f in mixed.schema.fields}
    ways = {k: D.way_of(types[k], e) for k, e in extents.items()}
    assert ways == {"narrow": "bitmap", "dense": "bitmaps", "sparse": "values", "few": "set", "many": "values", "real": "set", "reals": "values", "none": "set"}
    assert distinct_counts(mixed, extents) == want
    for estimate in (1, 10**9):
        other = {k: Extent(estimate, e.low, e.high) for k, e in extents.items()}
        assert distinct_counts(mixed, other) == want


def test_profile_of_an_empty_table(mixed):
    for staged in (False, True):
        rows = column_profile(mixed.limit(0), staged=staged).collect()
        assert {(r.distinct_count, r.num_nulls) for r in rows} == {(0, 0)} and len(rows) == 8


def test_stored_sketches(spark):
    df = spark.range(0, 30_000).select(
        (F.col("id") % 3).alias("part"), (F.col("id") % 50).alias("few"), F.col("id").alias("many"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("id") % 900)).alias("text"),
    )
    _, path = table_location(spark, "sketches")
    write_distinct_sketches(df, path, ["few", "many", "text"], "part")
    got = {r.column_name: r for r in distinct_from_sketches(spark, path).collect()}
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in ("few", "many", "text")]).first()
    assert got["few"].distinct_estimate == exact.few and got["text"].distinct_estimate == exact.text
    assert 0 < abs(got["many"].distinct_estimate - 30_000) <= stated_error() * 30_000
    assert got["few"].n_partitions == 3 and got["few"].n_rows == 30_000
    one = {r.column_name: r for r in distinct_from_sketches(spark, path, F.col("part") == 1).collect()}
    assert one["few"].n_rows == 10_000 and one["few"].distinct_estimate == 50
    # A partition that is loaded again replaces its own sketches only.
    write_distinct_sketches(df.where("part = 1 and few < 10"), path, ["few", "many", "text"], "part", mode="overwrite")
    again = {r.column_name: r for r in distinct_from_sketches(spark, path).collect()}
    assert again["few"].n_rows == 20_000 + df.where("part = 1 and few < 10").count()


def _plate(spark, hot):
    return spark.range(0, 40_000, numPartitions=6).select(
        F.when(F.col("id") % 10 < hot, F.concat(F.lit("hot"), F.col("id") % 3)).otherwise(F.concat(F.lit("p"), F.col("id"))).alias("k")
    )


def test_heavy_hitters_are_proven_and_counted(spark, monkeypatch):
    df = _plate(spark, 4)
    heavy = heavy_hitters(df, "k", tracked=512)
    assert heavy.n_rows == 40_000 and heavy.bound < 600
    assert heavy.counts.first()["count"] == df.groupBy("k").count().agg(F.max("count")).first()[0]
    # Proven: every value is never counted.
    monkeypatch.setattr(H, "top_n", lambda *a, **k: pytest.fail("counted every value"))
    want = [tuple(r) for r in top_n(df, "k", 3).collect()]
    got = top_n_heavy(df, "k", 3, tracked=512)
    assert [tuple(r) for r in got.collect()] == want and got.columns == ["k", "count"]


def test_even_counts_fall_back_to_counting_all(spark):
    for hot in (0, 4):
        df = _plate(spark, hot)
        n = 5  # only three values are frequent
        assert [tuple(r) for r in top_n_heavy(df, "k", n, tracked=64).collect()] == [tuple(r) for r in top_n(df, "k", n).collect()]
    empty = _plate(spark, 1).limit(0)
    assert top_n_heavy(empty, "k", 3).count() == 0
    nulls = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert [tuple(r) for r in top_n_heavy(nulls, "k", 2).collect()] == [("a", 1)]


def test_a_changed_cell_shows(spark):
    rows = [(m, i, None if i % 5 == 0 else f"s{i}", i / 2) for m in (1, 2, 3) for i in range(50)]
    df = spark.createDataFrame(rows, "month int, id int, s string, v double")

    def result(other):
        return {r.month: (r.expected_rows, r.loaded_rows, r.same_contents) for r in reconcile_contents(df, other, "month").collect()}

    same = {m: (50, 50, True) for m in (1, 2, 3)}
    assert result(df.repartition(7, "id").select("v", "s", "id", "month")) == same
    assert result(df.withColumn("v", F.when((F.col("month") == 2) & (F.col("id") == 7), F.lit(9.9)).otherwise(F.col("v")))) == {**same, 2: (50, 50, False)}
    # A NULL that moves into another column, a row twice instead of another one, a lost and an added month.
    moved = df.where("not (month = 1 and id = 1)").unionByName(spark.createDataFrame([(1, 1, "s1", None)], df.schema))
    assert result(moved)[1] == (50, 50, False)
    twice = df.where("not (month = 3 and id = 2)").unionByName(df.where("month = 3 and id = 3"))
    assert result(twice)[3] == (50, 50, False)
    assert result(df.where("month != 2").unionByName(spark.createDataFrame([(4, 1, "x", 0.0)], df.schema))) == {
        1: (50, 50, True), 2: (50, 0, False), 3: (50, 50, True), 4: (0, 1, False),
    }
    null_key = df.withColumn("month", F.lit(None).cast("int"))
    assert [tuple(r) for r in reconcile_contents(null_key, null_key, "month").collect()] == [(None, 150, 150, True)]
    assert content_checksums(df.limit(0), "month").count() == 0
