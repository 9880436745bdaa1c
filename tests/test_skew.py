"""A key holding a third of all rows: results stay whole and every shuffle
carries pre-aggregated rows, never the hot group's raw rows."""

import re

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import frequency, mix_within_top, share_of_total, top_k_per_group
from tools.plan_audit import _final_only


@pytest.fixture(scope="module")
def skewed(spark):
    n = 30_000
    # key 0 holds one third of the rows; the rest spread over 500 keys.
    df = spark.range(0, n, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("k"),
        (F.col("id") % 7).alias("item"),
    )
    return df, n


def _partial_below_every_exchange(df):
    df.collect()
    plan = _final_only(df._jdf.queryExecution().executedPlan().toString())
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "ReusedExchange" not in line and re.search(r"Exchange hashpartitioning", line):
            below = "\n".join(lines[i + 1 : i + 3])
            assert "partial_" in below or "Partial" in below, plan
    return plan


def test_frequency_hot_key(skewed):
    df, n = skewed
    out = frequency(df, "k")
    counts = {r.k: r["count"] for r in out.collect()}
    assert counts[0] == n // 3 and sum(counts.values()) == n
    _partial_below_every_exchange(out)


def test_share_hot_key(skewed):
    df, n = skewed
    out = share_of_total(df, "k")
    shares = {r.k: r.Percentage_of_Total for r in out.collect()}
    assert shares[0] == 33.33
    _partial_below_every_exchange(out)


def test_top_k_hot_group(skewed):
    df, _ = skewed
    out = top_k_per_group(df, "k", "item", 2)
    assert out.filter("k = 0").count() >= 1
    plan = _partial_below_every_exchange(out)
    assert "WindowGroupLimit" in plan


def test_mix_hot_group(skewed):
    df, n = skewed
    out = mix_within_top(df, "k", "item", 1)
    rows = out.collect()
    assert {r.k for r in rows} == {0}
    assert sum(r.ticket_count for r in rows) == n // 3
    plan = _partial_below_every_exchange(out)
    assert "BroadcastExchange" in plan or "BroadcastHashJoin" in plan
