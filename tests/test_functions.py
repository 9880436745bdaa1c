"""Scalar helpers on literal frames (edge cases from FIXTURES.md section 4)."""

import pytest
import datetime as dt

from pyspark.sql import functions as F

from tallyframe.functions import (
    TIP_BANDS_AS_WRITTEN,
    TIP_BANDS_HALF_OPEN,
    band,
    clock_code,
    clock_hour,
    clock_minute,
    clock_period,
    month_range,
    pct,
    pct_change,
    rate_per_hour,
    round_half_up,
    season,
    time_of_day,
    valid_clock,
)


def test_round_half_up_on_decimal_form(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (0.125,), (None,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert got == [1.01, 2.68, -1.01, 0.13, None]


def test_pct_and_zero_total(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (5, 0)], "n long, t long")
    got = [r[0] for r in df.select(pct("n", "t")).collect()]
    assert got == [33.33, 66.67, None]


def test_rate_per_hour_zero_duration_and_null(spark):
    t0 = dt.datetime(2017, 11, 5, 0, 30)
    rows = [
        (10.0, t0, t0 + dt.timedelta(hours=2)),  # 5 per hour
        (10.0, t0, t0),  # zero duration -> NULL
        (10.0, t0, None),  # missing drop-off -> NULL
        (1.0, t0, t0 + dt.timedelta(seconds=1800)),
    ]
    df = spark.createDataFrame(rows, "d double, a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(rate_per_hour("d", "a", "b")).collect()]
    assert got == [5.0, None, None, 2.0]


def test_rate_across_daylight_saving_is_wall_clock(spark):
    # 00:30 -> 03:00 on 2017-11-05 is 2.5 h of wall-clock time (UTC session).
    a, b = dt.datetime(2017, 11, 5, 0, 30), dt.datetime(2017, 11, 5, 3, 0)
    df = spark.createDataFrame([(25.0, a, b)], "d double, a timestamp_ntz, b timestamp_ntz")
    assert df.select(rate_per_hour("d", "a", "b")).first()[0] == 10.0


def test_pct_change(spark):
    df = spark.createDataFrame([(12.0, 10.0), (9.0, 10.0), (1.0, 0.0)], "x double, o double")
    assert [r[0] for r in df.select(pct_change("x", "o")).collect()] == [20.0, -10.0, None]


def test_bands_half_open_and_as_written(spark):
    values = [0.0, 5.0, 5.005, 5.01, 10.0, 15.0, 20.0, 20.01, -1.0, None]
    df = spark.createDataFrame([(v,) for v in values], "tip double")
    half = [r[0] for r in df.select(band("tip", TIP_BANDS_HALF_OPEN)).collect()]
    assert half == [
        "[0-5)", "[5-10)", "[5-10)", "[5-10)", "[10-15)", "[15-20)", ">=20", ">=20",
        "Other amount", "Other amount",
    ]
    written = [r[0] for r in df.select(band("tip", TIP_BANDS_AS_WRITTEN)).collect()]
    assert written == [
        "Tip between $0.00 - $5.00",
        "Tip between $0.00 - $5.00",
        "Other amount",  # 5.005 falls into the gap between 5.00 and 5.01
        "Tip between $5.01 - $10.00",
        "Tip between $5.01 - $10.00",
        "Tip between $0.00 - $5.00",  # the 10.01-15.00 band carries the 0-5 label
        "Tip between $15.01 - $20.00",
        "Tip greater than $20",
        "Other amount",
        "Other amount",
    ]


def test_clock_parts(spark):
    codes = ["0143A", "1200A", "1200P", "0000P", "12", "nan", "", None]
    df = spark.createDataFrame([(c,) for c in codes], "t string")
    rows = df.select(clock_hour("t"), clock_minute("t"), clock_period("t")).collect()
    assert [tuple(r) for r in rows] == [
        ("01", "43", "AM"),
        ("12", "00", "AM"),
        ("12", "00", "PM"),
        ("00", "00", "PM"),
        ("12", "", "M"),
        ("na", "n", "M"),
        ("", "", "M"),
        (None, None, None),
    ]
    valid = [r[0] for r in df.select(valid_clock(clock_hour("t"), clock_period("t"))).collect()]
    assert valid == [True, True, True, True, False, False, False, None]


def test_clock_code_of_timestamp(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 3),), (dt.datetime(2024, 1, 1, 13, 45),)], "ts timestamp_ntz"
    )
    assert [r[0] for r in df.select(clock_code("ts")).collect()] == ["1203A", "0145P"]


def test_time_of_day_bins_cover_every_hour(spark):
    rows = [(f"{h:02d}", p) for h in range(0, 13) for p in ("AM", "PM")]
    df = spark.createDataFrame(rows, "h string, p string")
    got = {(r.h, r.p): r.b for r in df.select("h", "p", time_of_day("h", "p").alias("b")).collect()}
    assert got[("03", "AM")] == "Dawn" and got[("06", "AM")] == "Dawn"
    assert got[("07", "AM")] == "Morning" and got[("10", "AM")] == "Morning"
    assert got[("11", "AM")] == "Afternoon" and got[("12", "PM")] == "Afternoon" and got[("02", "PM")] == "Afternoon"
    assert got[("03", "PM")] == "Evening" and got[("06", "PM")] == "Evening"
    assert got[("07", "PM")] == "Night" and got[("10", "PM")] == "Night"
    assert got[("11", "PM")] == "Midnight" and got[("12", "AM")] == "Midnight" and got[("02", "AM")] == "Midnight"
    assert got[("00", "PM")] == "Midnight"  # a bad hour falls to the ELSE label
    assert set(got.values()) == {"Dawn", "Morning", "Afternoon", "Evening", "Night", "Midnight"}


def test_season_every_month_and_null(spark):
    df = spark.createDataFrame([(m,) for m in range(1, 13)] + [(None,)], "m int")
    got = [r[0] for r in df.select(season("m")).collect()]
    assert got == [
        "Winter", "Winter", "Spring", "Spring", "Spring", "Summer", "Summer", "Summer",
        "Fall", "Fall", "Fall", "Winter", None,
    ]


def test_month_range_matches_parts_and_pushes_down(spark, tmp_path):
    stamps = [
        dt.datetime(2017, 10, 31, 23, 59, 59),
        dt.datetime(2017, 11, 1, 0, 0),
        dt.datetime(2017, 12, 31, 23, 59, 59),
        dt.datetime(2018, 1, 1, 0, 0),
        dt.datetime(2016, 11, 5),
    ]
    path = str(tmp_path / "ts")
    spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz").write.parquet(path)
    df = spark.read.parquet(path)
    ranged = df.filter(month_range("ts", 2017, [11, 12]))
    parts = df.filter((F.year("ts") == 2017) & F.month("ts").isin(11, 12))
    assert sorted(ranged.collect()) == sorted(parts.collect())
    assert ranged.count() == 2
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    # Other sets of months are ranges too, one per run.
    split = df.filter(month_range("ts", 2017, [10, 12]))
    assert split.count() == 2 and "Or(" in split._jdf.queryExecution().executedPlan().toString()
    assert df.filter(month_range("ts", 2017, [])).count() == 0
    with pytest.raises(ValueError, match="month"):
        month_range("ts", 2017, [13])


def test_on_dates_matches_to_date_and_pushes_down(spark, tmp_path):
    from tallyframe.functions import on_dates

    stamps = [dt.datetime(1997, 12, 24, 23, 59, 59), dt.datetime(1997, 12, 25), dt.datetime(1997, 12, 25, 23, 59),
              dt.datetime(1997, 12, 26), dt.datetime(1997, 12, 31, 12), dt.datetime(1998, 1, 1)]
    path = str(tmp_path / "days")
    spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz").write.parquet(path)
    df = spark.read.parquet(path)
    days = ["1997-12-31", "1997-12-25"]
    got = df.filter(on_dates("ts", days))
    want = df.filter(F.to_date("ts").isin(*[F.lit(d).cast("date") for d in days]))
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 3
    assert "Or(And(GreaterThanOrEqual(ts" in got._jdf.queryExecution().executedPlan().toString()


def test_seconds_over_a_clock_change(spark):
    """Half past midnight to three, on the night that clocks go back in New
    York, and back and forth over a gap and a fold."""
    from tallyframe.functions import elapsed_seconds

    rows = [
        ("2017-11-05 00:30:00", "2017-11-05 03:00:00"), ("2017-03-12 01:30:00", "2017-03-12 03:30:00"),
        ("2017-03-12 01:30:00", "2017-03-12 02:30:00"), ("2017-11-05 00:30:00", "2017-11-05 01:30:00"),
        ("2017-06-01 10:00:00.9", "2017-06-01 10:00:01.1"), (None, "2017-06-01 10:00:01"),
    ]
    df = spark.createDataFrame(rows, "a string, b string").selectExpr("cast(a as timestamp_ntz) a", "cast(b as timestamp_ntz) b")
    seconds = df.select(elapsed_seconds("a", "b").alias("utc"), elapsed_seconds("a", "b", "America/New_York").alias("ny"))
    want = [(9000, 12600), (7200, 3600), (3600, 3600), (3600, 3600), (1, 1), (None, None)]
    before = spark.conf.get("spark.sql.session.timeZone")
    for zone in (before, "Europe/Paris"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert [tuple(r) for r in seconds.collect()] == want
    spark.conf.set("spark.sql.session.timeZone", before)
