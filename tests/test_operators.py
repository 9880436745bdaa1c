"""Operators on small literal frames: NULLs, ties, empty input, sentinels."""

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import (
    any_negative_by,
    column_profile,
    correlation,
    describe_shape,
    distinct_count,
    frequency,
    mean_vs_percentiles,
    mix_within_top,
    null_profile,
    out_of_domain,
    period_profile,
    reconcile,
    recode_to_mode,
    sample_rows,
    share_of_total,
    top_k_per_group,
    top_n,
    violations_by,
)


def _rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((v is not None, v) for v in t))


def test_frequency_where_having_order(spark):
    df = spark.createDataFrame([(k,) for k in "aaabbc"], "k string")
    assert _rows(frequency(df, "k"), "k", "count") == [("a", 3), ("b", 2), ("c", 1)]
    assert _rows(frequency(df, "k", min_count=2), "k", "count") == [("a", 3), ("b", 2)]
    assert _rows(frequency(df, "k", where=F.col("k") != "a"), "k", "count") == [("b", 2), ("c", 1)]
    ordered = [tuple(r) for r in frequency(df, "k", order=True).collect()]
    assert ordered == [("a", 3), ("b", 2), ("c", 1)]


def test_top_n_tie_break_and_exclude(spark):
    df = spark.createDataFrame([(k,) for k in [3, 3, 1, 1, 2, 2, 0, 0, 0]], "k int")
    got = [tuple(r) for r in top_n(df, "k", 2).collect()]
    assert got == [(0, 3), (1, 2)]
    got = [tuple(r) for r in top_n(df, "k", 2, exclude=[0]).collect()]
    assert got == [(1, 2), (2, 2)]


def test_share_of_total_null_key_single_group_empty(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    got = dict(_rows(share_of_total(df, "k"), "k", "Percentage_of_Total"))
    # count(key) skips NULLs: the NULL group scores 0 but counts in the total.
    assert got == {1: 50.0, 2: 25.0, None: 0.0}
    one = spark.createDataFrame([(7,), (7,)], "k int")
    assert _rows(share_of_total(one, "k"), "k", "Percentage_of_Total") == [(7, 100.0)]
    empty = spark.createDataFrame([], "k int")
    assert share_of_total(empty, "k").count() == 0


def test_share_with_labels_keeps_codes_apart(spark):
    df = spark.createDataFrame([(5,), (9,), (1,), (1,)], "payment_type int")
    out = share_of_total(df, "payment_type", labels={1: "Card", 5: "Unknown"}, label_default="Unknown")
    got = _rows(out, "payment_type", "payment_type_code", "Percentage_of_Total")
    assert got == [("Card", 1, 50.0), ("Unknown", 5, 25.0), ("Unknown", 9, 25.0)]


def test_shares_sum_to_hundred(spark):
    df = spark.range(0, 997).select((F.col("id") % 7).alias("k"))
    total = sum(r[0] for r in share_of_total(df, "k").select("Percentage_of_Total").collect())
    assert abs(total - 100.0) <= 0.01 * 7


@pytest.mark.parametrize(
    "values, expected",
    [
        ([4.0], (4.0, 4.0, 4.0, 4.0)),
        ([2.0, 2.0, 2.0], (2.0, 2.0, 2.0, 2.0)),
        ([1.0, 2.0, 3.0, 4.0, None], (2.5, 1.0, 2.0, 3.0)),
    ],
)
def test_mean_vs_percentiles(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "tip double")
    row = mean_vs_percentiles(df, "tip", name="tip").first()
    assert (row.average_tip, row.p25_tip, row.p50_tip, row.p75_tip) == expected


def test_correlation_edge_cases(spark):
    const = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 3.0)], "x int, y double")
    assert correlation(const, "x", "y").first()[0] is None
    pos = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, 6.0)], "x int, y double")
    assert correlation(pos, "x", "y").first()[0] == 1.0
    neg = spark.createDataFrame([(1, 6.0), (2, 4.0), (3, 2.0), (4, None)], "x int, y double")
    assert correlation(neg, "x", "y").first()[0] == -1.0
    # Row 4 (y NULL) must be left out of both sides.
    mixed = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (100, None)], "x int, y double")
    assert correlation(mixed, "x", "y").first()[0] == 1.0


def test_top_k_per_group_keeps_ties(spark):
    rows = [("g", "a")] * 3 + [("g", "b")] * 2 + [("g", "c")] * 2 + [("g", "d")] * 1 + [("g", "e")] * 1
    rows += [("h", "z")] * 4
    df = spark.createDataFrame(rows, "grp string, item string")
    got = _rows(top_k_per_group(df, "grp", "item", 2), "grp", "item", "TicketCount", "Rank")
    assert got == [("g", "a", 3, 1), ("g", "b", 2, 2), ("g", "c", 2, 2), ("h", "z", 4, 1)]
    got3 = top_k_per_group(df, "grp", "item", 3).filter("grp = 'g'").count()
    assert got3 == 5  # ranks 1, 2, 2, 3, 3


def test_top_k_plan_has_window_group_limit(spark):
    df = spark.range(0, 1000).select((F.col("id") % 5).alias("g"), (F.col("id") % 37).alias("i"))
    plan = top_k_per_group(df, "g", "i", 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_mix_within_top_share_of_whole_group(spark):
    rows = [(1, 46)] * 6 + [(1, 14)] * 4 + [(2, 14)] * 3 + [(2, 7)] * 1 + [(3, 7)] * 2 + [(0, 46)] * 50
    df = spark.createDataFrame(rows, "precinct int, code int")
    mix = mix_within_top(df, "precinct", "code", 2, exclude=[0])
    assert _rows(mix, "code", "precinct", "ticket_count", "perc_ticket_count") == [
        (7, 2, 1, 25.0), (14, 1, 4, 40.0), (14, 2, 3, 75.0), (46, 1, 6, 60.0)
    ]
    only = mix_within_top(df, "precinct", "code", 2, exclude=[0], items=[14])
    assert _rows(only, "code", "precinct", "perc_ticket_count") == [(14, 1, 40.0), (14, 2, 75.0)]
    plan = mix._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


@pytest.mark.parametrize(
    "states, expected",
    [
        (["99", "99", "99", "NY", "NY", "NJ"], {"NY": 5, "NJ": 1}),  # sentinel is the mode
        (["99", "CA", "NJ", "NJ", "CA"], {"CA": 3, "NJ": 2}),  # tie goes to the smaller value
        (["NY", "NJ", "NY"], {"NY": 2, "NJ": 1}),  # no sentinel
    ],
)
def test_recode_to_mode(spark, states, expected):
    df = spark.createDataFrame([(s,) for s in states], "RegistrationState string")
    got = dict(_rows(frequency(recode_to_mode(df, "RegistrationState", ["99"]), "RegistrationState"),
                     "RegistrationState", "count"))
    assert got == expected


def test_distinct_count_exact_and_sketch(spark):
    df = spark.range(0, 5000).select((F.col("id") % 1234).alias("v"))
    assert distinct_count(df, "v", "n").first()[0] == 1234
    approx = distinct_count(df, "v", "n", approx=True, rsd=0.05).first()[0]
    assert abs(approx - 1234) / 1234 < 0.15


def test_quality_counts(spark):
    rows = [(1, 0, -1.0, 2.0), (1, 2, 1.0, 2.0), (2, 0, 1.0, -3.0), (2, 1, None, 1.0)]
    df = spark.createDataFrame(rows, "VendorID int, passenger_count int, fare double, tip double")
    assert _rows(violations_by(df, F.col("passenger_count") <= 0, "VendorID"), "VendorID", "count") == [(1, 1), (2, 1)]
    assert _rows(any_negative_by(df, ["fare", "tip"], "VendorID"), "VendorID", "count") == [(1, 1), (2, 1)]
    assert _rows(out_of_domain(df, "fare", [1.0], "VendorID"), "VendorID", "count") == [(1, 1)]
    rec = reconcile(df, [F.col("passenger_count") > 0, F.col("fare") > 0]).first()
    assert (rec.raw_rows, rec.kept_rows, rec.rejected_rows) == (4, 1, 3)
    assert rec.kept_rows + rec.rejected_rows == rec.raw_rows


def test_profiles(spark):
    rows = [(1, "a", 2.5), (2, None, None), (2, "nan", -0.0), (None, " ", 0.0)]
    df = spark.createDataFrame(rows, "i int, s string, d double")
    prof = {r.column_name: r for r in column_profile(df).collect()}
    assert (prof["i"].num_nulls, prof["i"].distinct_count, prof["i"].min_value, prof["i"].max_value) == (1, 2, "1", "2")
    assert (prof["s"].num_nulls, prof["s"].distinct_count, prof["s"].max_len) == (1, 3, 3)
    assert prof["d"].distinct_count == 2  # -0.0 and 0.0 are one value
    sketch = {r.column_name: r.distinct_count for r in column_profile(df, exact_distinct=False).collect()}
    assert sketch == {"i": 2, "s": 3, "d": 2}
    nulls = null_profile(df).first().asDict()
    assert nulls == {"Nulls_i": 1, "Nulls_s": 1, "Nulls_d": 1, "Placeholders_s": 2}


def test_shape_sample_period(spark):
    import datetime as dt

    rows = [(dt.datetime(2017, m, 1), v) for m, v in [(11, 1), (11, None), (12, 3), (1, 4)]]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v int")
    shape = describe_shape(df).collect()
    assert [(r.position, r.column_name, r.data_type, r.n_rows, r.n_columns) for r in shape] == [
        (1, "ts", "timestamp_ntz", 4, 2),
        (2, "v", "int", 4, 2),
    ]
    assert _rows(period_profile(df, "ts", "v"), "year", "month", "count") == [(2017, 1, 1), (2017, 11, 1), (2017, 12, 1)]
    assert [r.v for r in sample_rows(df, 2, ["v"]).collect()] == [None, 1]


def test_mean_vs_percentiles_empty_and_methods(spark):
    empty = spark.createDataFrame([], "tip double")
    row = mean_vs_percentiles(empty, "tip", name="tip").first()
    assert (row.average_tip, row.p25_tip, row.p50_tip, row.p75_tip) == (None, None, None, None)
    df = spark.range(0, 2001).select((F.col("id") / 10.0).alias("tip")).repartition(7)
    kll = mean_vs_percentiles(df, "tip", name="tip", fan_in=3).first()
    gk = mean_vs_percentiles(df, "tip", name="tip", method="gk").first()
    assert tuple(kll) == tuple(gk) == (100.0, 50.0, 100.0, 150.0)
    ints = spark.range(1, 101).select(F.col("id").cast("int").alias("n"))
    assert tuple(mean_vs_percentiles(ints, "n").first()) == (50.5, 25, 50, 75)


def test_distinct_count_sketch_tree(spark):
    df = spark.range(0, 20000, numPartitions=9).select((F.col("id") % 5000).alias("v"))
    approx = distinct_count(df, "v", "n", approx=True, rsd=0.02, fan_in=4).first()[0]
    assert abs(approx - 5000) / 5000 < 0.06
    empty = spark.createDataFrame([], "v long")
    assert distinct_count(empty, "v", "n", approx=True).first()[0] == 0


@pytest.mark.parametrize(
    "states",
    [
        ["99", "99", "99", "NY", "NY", "NJ"],
        ["99", "CA", "NJ", "NJ", "CA"],
        ["NY", "NJ", "NY", None],
        ["99", "99", None],
    ],
)
def test_recoded_frequency_equals_row_recode(spark, states):
    from tallyframe.operators import recoded_frequency

    df = spark.createDataFrame([(s,) for s in states], "RegistrationState string")
    one_pass = _rows(recoded_frequency(df, "RegistrationState", ["99"]), "RegistrationState", "count")
    rows = _rows(frequency(recode_to_mode(df, "RegistrationState", ["99"]), "RegistrationState"),
                 "RegistrationState", "count")
    assert one_pass == rows


def test_values_of_any_size_keep_their_place_in_a_mean(spark):
    from tallyframe.operators import avg_by

    df = spark.createDataFrame([(1, 1.0), (1, 1e27), (2, 1.005)], "k int, v double")
    got = {r.k: r.avg_v for r in avg_by(df, "v", "k").collect()}
    assert got == {1: (1.0 + 1e27) / 2, 2: 1.01}


def test_share_of_total_takes_a_column_key(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,)], "n int")
    got = share_of_total(df, F.col("n") % 2)
    assert sorted(r[1] for r in got.collect()) == [25.0, 75.0]
    labelled = share_of_total(df, F.col("n"), labels={1: "one"}, label_default="other")
    assert sorted(tuple(r) for r in labelled.collect()) == [("one", 1, 50.0), ("other", 2, 25.0), ("other", 3, 25.0)]


def test_exact_percentiles_do_not_depend_on_the_partitioning(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select("l_extendedprice")
    values = sorted(r[0] for r in df.collect())
    assert len(values) >= 50_000
    want = [values[-(-len(values) * k // 4) - 1] for k in (1, 2, 3)]
    for frame in (df, df.repartition(7), df.coalesce(1)):
        assert list(mean_vs_percentiles(frame, "l_extendedprice").first())[1:] == want


def test_impossible_parameters_raise(spark):
    from tallyframe.operators import any_negative_by

    df = spark.range(3)
    with pytest.raises(ValueError, match="rsd"):
        distinct_count(df, "id", "n", approx=True, rsd=1e-6)
    with pytest.raises(ValueError, match="missing"):
        any_negative_by(df, ["id", "no_such"], "id")
