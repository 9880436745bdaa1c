"""Trip analysis: quality profile, rule-based clean-up, partitioned load,
and descriptive statistics over the clean rows.

Each analysis is a function of the raw rows (``RAW_ANALYSES``) or of the
clean rows (``CLEAN_ANALYSES``) and the rule parameters. ``trip_report``
runs them all for any raw trip table, ``analyses_over`` runs the clean-row
ones over e.g. the loaded ORC table, and ``QUERIES`` binds them to the
test-data binding as ``(spark, folder)`` callables. All results are lazy
DataFrames, but for column profiles and percentiles, whose later scans depend
on what the first one finds: these run when they are asked for.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.bins import (
    PAYMENT_TYPE_DEFAULT,
    PAYMENT_TYPE_LABELS,
    TIP_BANDS_AS_WRITTEN,
    TIP_BANDS_HALF_OPEN,
)
from tallyframe.functions.clock import elapsed_seconds, month_range, on_dates
from tallyframe.operators import aggregate as agg
from tallyframe.operators import distinct, profile, quality
from tallyframe.plans.bindings import TRIP_KEYS, keyed_trips, trips
from tallyframe.session import remove_folder
from tallyframe.sources import delimited, tables
from tallyframe.sources.schema import TRIP_RAW_SCHEMA

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
AMOUNT_COLUMNS = (
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
)


@dataclass(frozen=True)
class TripRules:
    """Parameters of the clean-up rules and of the date comparisons."""

    year: int
    months: tuple[int, ...]
    extra_allowed: tuple[float, ...]
    surcharge: float
    dates: tuple[str, ...]
    buckets: int = 5
    sample_rows: int = 100
    percentiles: tuple[float, ...] = field(default=(0.25, 0.5, 0.75))


# The rules as the original clean-up states them.
REFERENCE_RULES = TripRules(
    year=2017,
    months=(11, 12),
    extra_allowed=(0.0, 0.5, 1.0),
    surcharge=0.30,
    dates=("2017-12-31", "2017-12-25"),
)

# The same rules on the test-data binding: other amounts, and months and
# extras enough for a few per cent of the rows to pass.
BOUND_RULES = TripRules(
    year=1997,
    months=(5, 6, 7, 8, 9, 11, 12),
    extra_allowed=(0.0, 0.01, 0.02, 0.03, 0.04, 0.05),
    surcharge=0.30,
    dates=("1997-12-31", "1997-12-25"),
)


def trip_rules(rules: TripRules) -> list[Column]:
    """The validity rules, in the order the clean-up lists them."""
    return [
        month_range(PICKUP, rules.year, rules.months),
        F.col("total_amount") > F.lit(0.0),
        F.col("trip_distance") > F.lit(0.0),
        F.col("passenger_count") > F.lit(0),
        F.col("extra").isin(*rules.extra_allowed),
        F.col("improvement_surcharge") == F.lit(rules.surcharge),
    ]


def clean_trips(raw: DataFrame, rules: TripRules) -> DataFrame:
    """Rows passing every rule, with year, date and month of the pickup."""
    kept = quality.apply_rules(raw, trip_rules(rules))
    return kept.withColumns(
        {
            "year": F.year(PICKUP),
            "date": F.to_date(PICKUP),
            "month": F.month(PICKUP),
        }
    )


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_trips(trips(spark, folder), BOUND_RULES)


# ---- data-quality profile over the raw rows ---------------------------------
# Each takes the raw trip rows and the rule parameters.


SKETCH_ERROR = 0.05


def raw_sample(raw: DataFrame, rules: TripRules) -> DataFrame:
    return profile.sample_rows(raw, rules.sample_rows)


def _stored(raw: DataFrame) -> tuple[DataFrame, str]:
    """The raw rows as read back from files in the shared folder, and the
    folder. A profile reads its rows once per pass and column: from files it
    reads that column only, while the join behind the rows, which shuffles
    both tables, would run for each of them."""
    _, path = tables.table_location(raw.sparkSession, "trip_profile")
    raw.write.parquet(path)
    return raw.sparkSession.read.schema(raw.schema).parquet(path), path


def columns_profile_sketched(raw: DataFrame, rules: TripRules) -> DataFrame:
    """The profile in one lazy pass, with estimated distinct counts; each is
    reported as whether it is within three times its stated error of the exact
    count."""
    raw, _ = _stored(raw)  # the result reads the files
    exact = profile.column_profile(raw, staged=True).select("column_name", F.col("distinct_count").alias("exact"))
    found = profile.column_profile(raw, exact_distinct=False, rsd=SKETCH_ERROR)
    off = F.abs(F.col("distinct_count") - F.col("exact"))
    within = off <= F.greatest(F.lit(1.0), 3 * SKETCH_ERROR * F.col("exact"))
    return found.join(exact, "column_name").withColumn("distinct_within_error", within).drop("distinct_count", "exact")


def fare_mean_vs_percentiles(raw: DataFrame, rules: TripRules) -> DataFrame:
    return agg.mean_vs_percentiles(raw, "fare_amount", rules.percentiles, name="fare")


def count_rows(raw: DataFrame, rules: TripRules) -> DataFrame:
    return agg.row_count(raw)


def pickup_periods(raw: DataFrame, rules: TripRules) -> DataFrame:
    return profile.period_profile(raw, PICKUP, "VendorID")


def columns_profile(raw: DataFrame, rules: TripRules) -> DataFrame:
    rows, path = _stored(raw)
    try:
        return profile.column_profile(rows, staged=True)  # runs here
    finally:
        remove_folder(raw.sparkSession, path)


def passenger_frequency(raw: DataFrame, rules: TripRules) -> DataFrame:
    return agg.frequency(raw, "passenger_count")


def payment_frequency(raw: DataFrame, rules: TripRules) -> DataFrame:
    return agg.frequency(raw, "payment_type")


def zero_passengers_by_vendor(raw: DataFrame, rules: TripRules) -> DataFrame:
    return quality.violations_by(raw, F.col("passenger_count") <= 0, "VendorID")


def any_negative_by_vendor(raw: DataFrame, rules: TripRules) -> DataFrame:
    return quality.any_negative_by(raw, AMOUNT_COLUMNS, "VendorID")


def zero_total_by_vendor_payment(raw: DataFrame, rules: TripRules) -> DataFrame:
    return quality.violations_by(raw, F.col("total_amount") == 0.0, "VendorID", "payment_type")


def zero_total_by_vendor_distance(raw: DataFrame, rules: TripRules) -> DataFrame:
    # The HAVING on the distance key is applied as the row filter it means.
    return quality.violations_by(
        raw, F.col("total_amount") == 0.0, "VendorID", "trip_distance", where=F.col("trip_distance") != 0.0
    )


def zero_distance_by_vendor_payment(raw: DataFrame, rules: TripRules) -> DataFrame:
    return quality.violations_by(raw, F.col("trip_distance") == 0.0, "VendorID", "payment_type")


def extra_by_vendor(raw: DataFrame, rules: TripRules) -> DataFrame:
    return agg.frequency(raw, "VendorID", "extra")


def surcharge_by_vendor(raw: DataFrame, rules: TripRules) -> DataFrame:
    return agg.frequency(raw, "VendorID", "improvement_surcharge")


def extra_out_of_domain(raw: DataFrame, rules: TripRules) -> DataFrame:
    return quality.out_of_domain(raw, "extra", rules.extra_allowed, "VendorID")


def valid_count(raw: DataFrame, rules: TripRules) -> DataFrame:
    return agg.row_count(quality.apply_rules(raw, trip_rules(rules)))


RAW_ANALYSES = {
    "t01_raw_sample": raw_sample,
    "t02_row_count": count_rows,
    "t03_period_profile": pickup_periods,
    "t04_column_profile": columns_profile,
    "t04b_column_profile_sketched": columns_profile_sketched,
    "t05a_passenger_frequency": passenger_frequency,
    "t05b_payment_frequency": payment_frequency,
    "t06_zero_passengers_by_vendor": zero_passengers_by_vendor,
    "t07_any_negative_by_vendor": any_negative_by_vendor,
    "t08_zero_total_by_vendor_payment": zero_total_by_vendor_payment,
    "t09_zero_total_by_vendor_distance": zero_total_by_vendor_distance,
    "t10_zero_distance_by_vendor_payment": zero_distance_by_vendor_payment,
    "t11a_extra_by_vendor": extra_by_vendor,
    "t11b_surcharge_by_vendor": surcharge_by_vendor,
    "t12_extra_out_of_domain": extra_out_of_domain,
    "t13_valid_count": valid_count,
    "t19b_fare_mean_vs_percentiles": fare_mean_vs_percentiles,
}


# ---- landing, clean-up and load ---------------------------------------------


def land_and_scan(raw: DataFrame, path: str) -> DataFrame:
    """Land rows as headed CSV at ``path``, then scan the folder back with
    the declared schema (header names checked against it)."""
    delimited.write_delimited(raw, path)
    return delimited.read_delimited(raw.sparkSession, path, TRIP_RAW_SCHEMA)


def load_clean(clean: DataFrame, table: str, path: str, rules: TripRules) -> DataFrame:
    """Clean rows into a month-partitioned ORC table, bucketed on date,
    Snappy-compressed; returns the table as read back."""
    return tables.load_table(clean, table, path, partition_by="month", bucket_by="date", buckets=rules.buckets)


def t01_raw_sample(spark, folder):
    """The first rows in the order of their keys."""
    return profile.sample_rows(keyed_trips(spark, folder), BOUND_RULES.sample_rows, TRIP_KEYS).drop(*TRIP_KEYS)


def t14a_csv_landing_scan(spark, folder):
    _, path = tables.table_location(spark, "trip_landing")
    return land_and_scan(trips(spark, folder), path)


def _loaded(spark, folder) -> DataFrame:
    """The clean rows written as a table and read back from its files. The
    table is dropped from the catalog again, as the original ends; the files
    of an external table stay for the reader."""
    name, path = tables.table_location(spark, "trip_clean")
    columns = load_clean(_clean(spark, folder), name, path, BOUND_RULES).columns
    tables.drop_table(spark, name)
    return spark.read.orc(path).select(*columns)


def t14_clean_load(spark, folder):
    return _loaded(spark, folder)


def t14b_reload_and_drop(spark, folder):
    """Load, load December again from vendor 1 only (no other month may
    change), count per month, drop."""
    name, path = tables.table_location(spark, "trip_reload")
    clean = _clean(spark, folder)
    load_clean(clean, name, path, BOUND_RULES)
    load_clean(clean.where("month = 12 and VendorID = 1"), name, path, BOUND_RULES)
    tables.drop_table(spark, name)
    return agg.frequency(spark.read.orc(path), "month")


def t14c_rejected_lines(spark, folder):
    """Rows and lines by reason of a landing folder in which, by the trip's
    part, a cell is text that is no number, the last cell is missing, or there
    is one too many."""
    given = keyed_trips(spark, folder)
    names = [f.name for f in TRIP_RAW_SCHEMA.fields]
    line = F.to_csv(F.struct(*[F.col(n) for n in names]), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    broken = F.to_csv(
        F.struct(*[F.lit("two").alias(n) if n == "passenger_count" else F.col(n) for n in names]),
        {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"},
    )
    part = F.col("trip_part")
    planted = (
        F.when(part % 101 == 0, broken)
        .when(part % 103 == 0, F.regexp_replace(line, ",[^,]*$", ""))
        .when(part % 107 == 0, F.concat(line, F.lit(",more")))
        .otherwise(line)
    )
    _, path = tables.table_location(spark, "trip_landing_bad")
    given.select(planted.alias("line")).write.text(path)
    rows, rejects = delimited.read_with_rejects(spark, path, TRIP_RAW_SCHEMA, header=False)
    _, sink = tables.table_location(spark, "trip_rejects")
    rejects.write.parquet(sink)
    good = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("passenger_count"), F.lit(0)).alias("passengers")).select(
        F.lit("none").alias("reason"), "n", "passengers"
    )
    found = spark.read.parquet(sink).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return good.unionByName(found.withColumn("passengers", F.lit(0).cast("long")))


def load_reconciliation(raw: DataFrame, loaded: DataFrame, rules: TripRules) -> DataFrame:
    return quality.reconcile_load(raw, loaded, trip_rules(rules))


def t15_load_reconciliation(spark, folder):
    return load_reconciliation(trips(spark, folder), _loaded(spark, folder), BOUND_RULES)


def t15b_content_reconciliation(spark, folder):
    """The clean rows and the loaded table by month, contents included."""
    return quality.reconcile_contents(_clean(spark, folder), _loaded(spark, folder), "month")


HISTOGRAM_BINS = 64


def _whole_bounds(rows: DataFrame, stats) -> tuple:
    """Smallest and largest value of a column of whole numbers, as the catalog has them."""
    if not distinct.is_whole(rows.schema[stats.column_name].dataType) or stats["min"] is None:
        return ()
    return int(stats["min"]), int(stats["max"])


def catalog_profile(raw: DataFrame, table: str, path: str) -> DataFrame:
    """What the catalog says of the 17 columns after an ANALYZE with
    histograms, next to exact counts: whether its distinct count is within
    three times the stated error, and whether the histogram's bins hold all rows
    that are not null."""
    spark = raw.sparkSession
    rows = tables.save_table(raw, table, path)
    tables.gather_statistics(spark, table, HISTOGRAM_BINS)
    stats = tables.column_statistics(spark, table)
    bins = tables.column_histograms(spark, table).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("histogram_bins"), F.sum("height").alias("held")
    )
    extents = {
        r.column_name: distinct.Extent(int(r.distinct_count), *_whole_bounds(rows, r)) for r in stats.collect()
    }  # a row per column
    counts = distinct.distinct_counts(rows, extents)
    exact = spark.createDataFrame(list(counts.items()), "column_name string, exact long")
    total = rows.agg(F.count(F.lit(1))).scalar()
    tables.drop_table(spark, table)
    nulls = F.col("num_nulls").cast("long")
    off = F.abs(F.col("distinct_count").cast("long") - F.col("exact"))
    return stats.join(exact, "column_name").join(bins, "column_name", "left").select(
        "column_name",
        nulls.alias("num_nulls"),
        F.col("min").alias("min_value"),
        F.col("max").alias("max_value"),
        F.col("avg_col_len").cast("long").alias("avg_len"),
        F.col("max_col_len").cast("long").alias("max_len"),
        (off <= F.greatest(F.lit(1.0), 3 * tables.NDV_ERROR * F.col("exact"))).alias("distinct_within_error"),
        F.coalesce("histogram_bins", F.lit(0)).alias("histogram_bins"),
        F.coalesce(F.abs(F.col("held") - (total - nulls)) < 0.001 * total, F.lit(False)).alias("bins_hold_all_rows"),
    )


def t04c_catalog_statistics(spark, folder):
    return catalog_profile(trips(spark, folder), *tables.table_location(spark, "trip_statistics"))


def t23b_speed_by_date_bucketed(spark, folder):
    """Mean speed per date over the loaded table, read through the catalog,
    which knows its buckets: rows of a date are in one bucket, so nothing
    is shuffled. The table stays in the catalog, as its scan needs it."""
    name, path = tables.table_location(spark, "trip_bucketed")
    loaded = load_clean(_clean(spark, folder), name, path, BOUND_RULES)
    return agg.avg_rate_by(loaded, "trip_distance", PICKUP, DROPOFF, "date")


# The months of each quarter.
QUARTERS = [(month, f"Q{(month + 2) // 3}") for month in range(1, 13)]


def t23c_speed_in_listed_months(spark, folder, quarter: str = "Q3"):
    """Mean speed per month of a quarter. The months come from a table, and
    what it lists prunes the partitions of the loaded table at run time."""
    loaded = _loaded(spark, folder)
    _, path = tables.table_location(spark, "quarters")
    tables.literal_table(spark, QUARTERS, "month int, quarter string").write.parquet(path)
    listed = spark.read.parquet(path).where(F.col("quarter") == quarter)
    return agg.avg_rate_by(loaded.join(F.broadcast(listed), "month"), "trip_distance", PICKUP, DROPOFF, "month")  # 12 rows


# The night on which clocks went back, and where.
CLOCK_CHANGE, CLOCK_ZONE = "2017-11-05 00:30:00", "America/New_York"


def t23d_seconds_over_clock_change(spark, folder):
    """Every trip moved into the night of the clock change: it starts at
    half past midnight plus its line number in minutes and takes as long by the
    wall clock as it does by its own, plus two hours. Seconds that
    passed, where clocks go back and where they do not, and trips with these."""
    start = F.lit(CLOCK_CHANGE).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("trip_line").cast("int"))
    wall = F.timestamp_diff("SECOND", F.col(PICKUP), F.col(DROPOFF))
    moved = keyed_trips(spark, folder).select(start.alias("start"), (start + F.make_dt_interval(secs=wall + F.expr("7200 * (trip_line % 2)"))).alias("end"))
    return agg.frequency(
        moved.select(
            F.hour("end").alias("end_hour"),
            elapsed_seconds("start", "end").alias("seconds_utc"),
            elapsed_seconds("start", "end", CLOCK_ZONE).alias("seconds_local"),
        ),
        "end_hour", "seconds_utc", "seconds_local",
    )


# ---- analyses over the clean rows --------------------------------------------
# Each takes the clean rows -- the lazily derived frame, or the loaded ORC
# table read back (``spark.table``), which cuts the lineage at the load --
# and the rule parameters.

# Labels of the extra-charge flag.
EXTRA_FLAG_LABELS = ("No Extra Charged", "Extra Charged")


def fare_by_period(clean: DataFrame, rules: TripRules) -> DataFrame:
    return agg.avg_by(clean, "fare_amount", "year", "month", alias="avg_fare")


def clean_passenger_frequency(clean: DataFrame, rules: TripRules) -> DataFrame:
    return agg.frequency(clean, "passenger_count")


def passenger_share(clean: DataFrame, rules: TripRules) -> DataFrame:
    return agg.share_of_total(clean, "passenger_count")


def extra_share(clean: DataFrame, rules: TripRules) -> DataFrame:
    return agg.share_of_total(clean, "extra")


def payment_share(clean: DataFrame, rules: TripRules) -> DataFrame:
    return agg.share_of_total(clean, "payment_type", labels=PAYMENT_TYPE_LABELS, label_default=PAYMENT_TYPE_DEFAULT)


def tip_mean_vs_percentiles(clean: DataFrame, rules: TripRules) -> DataFrame:
    return agg.mean_vs_percentiles(clean, "tip_amount", rules.percentiles, name="tip")


def extra_flag_share(clean: DataFrame, rules: TripRules) -> DataFrame:
    flag = F.when(F.col("extra") == 0.0, F.lit(EXTRA_FLAG_LABELS[0])).otherwise(F.lit(EXTRA_FLAG_LABELS[1]))
    return agg.share_of_total(clean.select(flag.alias("extra")), "extra")


def passenger_tip_correlation(clean: DataFrame, rules: TripRules) -> DataFrame:
    return agg.correlation(clean, "passenger_count", "tip_amount")


def tip_band_share(clean: DataFrame, rules: TripRules) -> DataFrame:
    return agg.band_share(clean, "tip_amount", TIP_BANDS_HALF_OPEN, "Range_of_tip_amount")


def tip_band_share_as_written(clean: DataFrame, rules: TripRules) -> DataFrame:
    return agg.band_share(clean, "tip_amount", TIP_BANDS_AS_WRITTEN, "Range_of_tip_amount")


def speed_by_month(clean: DataFrame, rules: TripRules) -> DataFrame:
    return agg.avg_rate_by(clean, "trip_distance", PICKUP, DROPOFF, "month")


def speed_overall(clean: DataFrame, rules: TripRules) -> DataFrame:
    return agg.avg_rate_by(clean, "trip_distance", PICKUP, DROPOFF, alias="average_total_mph")


def _on_dates(rules: TripRules) -> Column:
    # to_date(pickup) IN (dates), as day ranges on the pickup so it reaches the scan.
    return on_dates(PICKUP, rules.dates)


def speed_on_dates(clean: DataFrame, rules: TripRules) -> DataFrame:
    return agg.avg_rate_by(
        clean, "trip_distance", PICKUP, DROPOFF, "date", alias="average_daily_mph", where=_on_dates(rules)
    )


def speed_vs_overall(clean: DataFrame, rules: TripRules) -> DataFrame:
    days = [F.lit(d).cast("date") for d in rules.dates]
    return agg.rate_vs_overall(clean, "trip_distance", PICKUP, DROPOFF, "date", key_values=days)


CLEAN_ANALYSES = {
    "t05c_clean_passenger_frequency": clean_passenger_frequency,
    "t16_avg_fare_by_period": fare_by_period,
    "t17a_passenger_share": passenger_share,
    "t17b_extra_share": extra_share,
    "t18_payment_share": payment_share,
    "t19_tip_mean_vs_percentiles": tip_mean_vs_percentiles,
    "t20_extra_flag_share": extra_flag_share,
    "t21_correlation": passenger_tip_correlation,
    "t22a_tip_band_share": tip_band_share,
    "t22b_tip_band_share_as_written": tip_band_share_as_written,
    "t23_speed_by_month": speed_by_month,
    "t24_speed_overall": speed_overall,
    "t25_speed_on_dates": speed_on_dates,
    "t26_speed_vs_overall": speed_vs_overall,
}


def analyses_over(clean: DataFrame, rules: TripRules = BOUND_RULES) -> dict[str, DataFrame]:
    """Every clean-row analysis over ``clean`` (e.g. the loaded table)."""
    return {key: fn(clean, rules) for key, fn in CLEAN_ANALYSES.items()}


def trip_report(raw: DataFrame, rules: TripRules = REFERENCE_RULES) -> dict[str, DataFrame]:
    """Every trip analysis for a raw trip table with the original column
    names (e.g. read with ``read_delimited(spark, path, TRIP_RAW_SCHEMA)``):
    the quality profile over ``raw`` and the statistics over its clean
    rows. Nothing but the profiles and percentiles runs until a result is used;
    the load step (``load_clean``) is left to the caller."""
    report = {key: fn(raw, rules) for key, fn in RAW_ANALYSES.items()}
    report.update(analyses_over(clean_trips(raw, rules), rules))
    return report


def _bound(key: str, analyses: dict, stage):
    def query(spark, folder):
        return analyses[key](stage(spark, folder), BOUND_RULES)

    query.__name__ = key
    return query


def _over_loaded(key: str):
    def query(spark, folder):
        return CLEAN_ANALYSES[key](_loaded(spark, folder), BOUND_RULES)

    query.__name__ = f"{key}_loaded"
    return query


# Analyses that are registered over the loaded table as well, one per kind.
OVER_LOADED = (
    "t16_avg_fare_by_period",
    "t17a_passenger_share",
    "t18_payment_share",
    "t19_tip_mean_vs_percentiles",
    "t21_correlation",
    "t22a_tip_band_share",
    "t23_speed_by_month",
    "t26_speed_vs_overall",
)

QUERIES = {
    **{k: _bound(k, RAW_ANALYSES, trips) for k in RAW_ANALYSES},
    "t01_raw_sample": t01_raw_sample,
    "t14a_csv_landing_scan": t14a_csv_landing_scan,
    "t14_clean_load": t14_clean_load,
    "t14b_reload_and_drop": t14b_reload_and_drop,
    "t14c_rejected_lines": t14c_rejected_lines,
    "t15_load_reconciliation": t15_load_reconciliation,
    "t15b_content_reconciliation": t15b_content_reconciliation,
    "t04c_catalog_statistics": t04c_catalog_statistics,
    "t23b_speed_by_date_bucketed": t23b_speed_by_date_bucketed,
    "t23c_speed_in_listed_months": t23c_speed_in_listed_months,
    "t23d_seconds_over_clock_change": t23d_seconds_over_clock_change,
    **{k: _bound(k, CLEAN_ANALYSES, _clean) for k in CLEAN_ANALYSES},
    **{f"{k}_loaded": _over_loaded(k) for k in OVER_LOADED},
}
