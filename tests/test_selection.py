import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import mean_vs_percentiles, select_ranks
from tallyframe.operators import selection as sel


def want(values, ranks):
    ordered = sorted(v for v in values if v is not None)
    return {r: ordered[r - 1] for r in ranks}


def check(spark, values, kind, ranks=None):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    n = sum(v is not None for v in values)
    ranks = ranks or sorted({1, n, max(1, n // 3), max(1, n // 2)})
    got = select_ranks(df, "v", lambda m: ranks)
    assert got.n == n and got.at == want(values, ranks)


@pytest.mark.parametrize("kind", ["int", "bigint", "double", "decimal(20,3)", "date", "timestamp", "timestamp_ntz"])
def test_types(spark, kind):
    rng = random.Random(1)
    make = {
        "date": lambda: dt.date(1990, 1, 1) + dt.timedelta(days=rng.randrange(9000)),
        "timestamp": lambda: dt.datetime(2000, 1, 1) + dt.timedelta(seconds=rng.randrange(10**8)),
        "timestamp_ntz": lambda: dt.datetime(2000, 1, 1) + dt.timedelta(seconds=rng.randrange(10**8)),
        "decimal(20,3)": lambda: Decimal(rng.randrange(-(10**9), 10**9)).scaleb(-3),
        "double": lambda: rng.gauss(0, 1e6),
    }.get(kind, lambda: rng.randrange(-1000, 1000))
    check(spark, [make() if rng.random() > 0.1 else None for _ in range(2000)], kind)


def test_skew_and_ties(spark):
    check(spark, [5] * 5000 + [1] + [9] * 4, "int", [1, 2, 5001, 5002, 5005])
    check(spark, [1.5], "double")
    check(spark, [math.inf, -math.inf, 0.0, 1.0], "double", [1, 2, 3, 4])


def test_nan_is_the_largest_value(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,), (float("nan"),)], "v double")
    got = select_ranks(df, "v", lambda n: [1, 2, 3, 4]).at
    assert (got[1], got[2]) == (1.0, 2.0) and math.isnan(got[3]) and math.isnan(got[4])
    only = spark.createDataFrame([(float("nan"),)], "v double")
    assert math.isnan(select_ranks(only, "v", lambda n: [1]).at[1])


@pytest.mark.parametrize("at_once", [1, 7])
def test_a_sketch_that_misses_and_small_tasks_change_nothing(spark, monkeypatch, at_once):
    """Brackets without width around a coarse sketch: ranks lie outside of
    them; tables of a few values are cut again and again."""
    monkeypatch.setattr(sel, "MARGIN", 1e-9)
    monkeypatch.setattr(sel, "SKETCH_K", 8)
    monkeypatch.setattr(sel, "AT_ONCE", at_once)
    monkeypatch.setattr(sel, "select_ranks", sel.select_ranks)
    rng = random.Random(at_once)
    values = [rng.choice([rng.randrange(10**6), 777]) for _ in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint").withColumn("k", F.col("v"))
    ranks = [1, 10, 1000, 1500, 2999, 3000]
    brackets = [[500_000, 500_010]] * len(ranks)
    assert sel._within(rows, "bigint", ranks, brackets) == want(values, ranks)
    wide = [[min(values), max(values)]]
    assert sel._within(rows, "bigint", [1234], wide) == want(values, [1234])


def test_two_scans(spark):
    """The sketch and the count: what follows reads the small table."""
    seen = spark.sparkContext.accumulator(0)
    df = spark.range(0, 50_000, numPartitions=3).rdd.map(lambda r: seen.add(1) or (float(r[0] % 9973),)).toDF("v double")
    assert mean_vs_percentiles(df, "v").first()[1:] == tuple(want([float(i % 9973) for i in range(50_000)], [12500, 25000, 37500]).values())
    assert seen.value == 2 * 50_000


def test_kept_tables_are_removed(spark, tmp_shared):
    import glob

    before = set(glob.glob(f"{tmp_shared.removeprefix('file:')}/ranks-*"))
    check(spark, list(range(1000)), "int")
    assert set(glob.glob(f"{tmp_shared.removeprefix('file:')}/ranks-*")) == before


def test_text_is_refused(spark):
    with pytest.raises(TypeError, match="string"):
        select_ranks(spark.createDataFrame([("a",)], "v string"), "v", lambda n: [1])
