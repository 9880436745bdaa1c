"""Ticket analysis: ingest, time parts, frequencies, top-N lists, ranked
mixes, time-of-day bins, seasons and a revenue estimate.

Each analysis is a function of a ticket DataFrame at one stage -- with
time parts (``TIME_ANALYSES``), valid clock codes with the time of day
(``BIN_ANALYSES``), or with seasons (``SEASON_ANALYSES``).
``ticket_report`` runs them all for any ticket table; ``QUERIES`` binds
them to the test-data bindings as ``(spark, folder)`` callables. All
results are lazy DataFrames; nothing is collected.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.bins import season, time_of_day
from tallyframe.functions.clock import clock_hour, clock_minute, clock_period, valid_clock
from tallyframe.operators import aggregate as agg
from tallyframe.operators import heavy, profile, quality, rank, sketches
from tallyframe.operators.recode import recode_to_mode, recoded_frequency
from tallyframe.plans.bindings import bound_fines, tickets, tickets_by_shipment
from tallyframe.sources import delimited, tables
from tallyframe.sources.schema import TICKET_RAW_SCHEMA


@dataclass(frozen=True)
class TicketRules:
    """Parameters of the ticket questions."""

    followed_codes: tuple[int, ...]
    state_sentinels: tuple[str, ...]
    precinct_sentinels: tuple[int, ...]
    top_five: int = 5
    top_three: int = 3


# The parameters of the original questions.
REFERENCE_TICKET_RULES = TicketRules(followed_codes=(46, 14), state_sentinels=("99",), precinct_sentinels=(0,))
# Bound codes run 0-19, so 46 maps to 46 mod 20 = 6.
BOUND_TICKET_RULES = replace(REFERENCE_TICKET_RULES, followed_codes=(6, 14))


def derive_ticket_time(df: DataFrame) -> DataFrame:
    """Issue year, month and date, and the hour, minute and AM/PM of the
    clock code (cut by position, so bad codes stay visible)."""
    return df.select(
        F.year("IssueDate").alias("IssueYear"),
        F.month("IssueDate").alias("IssueMonth"),
        F.to_date("IssueDate").alias("IssueDt"),
        *df.columns,
        clock_hour("ViolationTime").alias("ViolationHour"),
        clock_minute("ViolationTime").alias("ViolationMinute"),
        clock_period("ViolationTime").alias("ViolationPeriod"),
    )


def valid_time(df: DataFrame) -> DataFrame:
    """Rows whose period is AM/PM and hour 00-12."""
    return df.filter(valid_clock("ViolationHour", "ViolationPeriod"))


def with_time_of_day(df: DataFrame) -> DataFrame:
    return df.withColumn("TimeOfDay", time_of_day("ViolationHour", "ViolationPeriod"))


def with_season(df: DataFrame) -> DataFrame:
    return df.withColumn("Season", season("IssueMonth"))


def _time(spark: SparkSession, folder: str) -> DataFrame:
    return derive_ticket_time(tickets(spark, folder))


def _binned(spark: SparkSession, folder: str) -> DataFrame:
    return with_time_of_day(valid_time(_time(spark, folder)))


def _seasonal(spark: SparkSession, folder: str) -> DataFrame:
    return with_season(with_time_of_day(valid_time(derive_ticket_time(tickets_by_shipment(spark, folder)))))


# ---- ingest and shape --------------------------------------------------------


def ingest_renamed(tickets_spaced: DataFrame, path: str) -> DataFrame:
    """Land tickets (original spaced header) as CSV at ``path``, scan them
    back with the declared schema and strip the spaces from the names."""
    delimited.write_delimited(tickets_spaced, path)
    return delimited.normalise_names(delimited.read_delimited(tickets_spaced.sparkSession, path, TICKET_RAW_SCHEMA))


def k01b_ingest_inferred(spark, folder):
    """Names, inferred types and size of the landed file."""
    spaced = tickets(spark, folder).toDF(*[f.name for f in TICKET_RAW_SCHEMA.fields])
    _, path = tables.table_location(spark, "ticket_inferred")
    delimited.write_delimited(spaced, path)
    return shape(delimited.normalise_names(delimited.read_inferred(spark, path)))


def k01_ingest_renamed(spark, folder):
    spaced = tickets(spark, folder).toDF(*[f.name for f in TICKET_RAW_SCHEMA.fields])
    _, path = tables.table_location(spark, "ticket_landing")
    return ingest_renamed(spaced, path)


def shape(raw: DataFrame) -> DataFrame:
    return profile.describe_shape(raw)


def k02_shape(spark, folder):
    return shape(tickets(spark, folder))


# ---- counts over the timed rows ------------------------------------------------
# Each takes the tickets with their time parts (``derive_ticket_time``).


def time_parts(timed: DataFrame, rules: TicketRules) -> DataFrame:
    return timed.select(
        "SummonsNumber", "IssueYear", "IssueMonth", "IssueDt", "ViolationHour", "ViolationMinute", "ViolationPeriod"
    )


def distinct_summons(timed: DataFrame, rules: TicketRules) -> DataFrame:
    return agg.distinct_count(timed, "SummonsNumber", "CountSummons")


def distinct_states(timed: DataFrame, rules: TicketRules) -> DataFrame:
    return agg.distinct_count(timed, "RegistrationState", "CountStates")


def state_frequency(timed: DataFrame, rules: TicketRules) -> DataFrame:
    return agg.frequency(timed, "RegistrationState", order=True)


def state_frequency_recoded(timed: DataFrame, rules: TicketRules) -> DataFrame:
    counts = recoded_frequency(timed, "RegistrationState", rules.state_sentinels)
    return counts.orderBy(F.col("count").desc(), F.col("RegistrationState").asc())


def distinct_states_recoded(timed: DataFrame, rules: TicketRules) -> DataFrame:
    counts = recoded_frequency(timed, "RegistrationState", rules.state_sentinels)
    # Non-NULL values with rows; reading the counts keeps this branch's
    # aggregation identical to the mode's, so they share one exchange.
    present = F.when(F.col("count") > 0, F.col("RegistrationState"))
    return counts.agg(F.count(present).alias("CountStates"))


def _top(key: str, size: str, valid_only: bool = False):
    def analysis(timed: DataFrame, rules: TicketRules) -> DataFrame:
        exclude = rules.precinct_sentinels if valid_only else None
        return agg.top_n(timed, key, getattr(rules, size), exclude=exclude)

    return analysis


def state_recoded_rows(timed: DataFrame, rules: TicketRules) -> DataFrame:
    """The recode on the rows themselves."""
    return recode_to_mode(timed.select("SummonsNumber", "RegistrationState"), "RegistrationState", rules.state_sentinels)


def code_mix_in_top_precincts(timed: DataFrame, rules: TicketRules) -> DataFrame:
    return rank.mix_within_top(timed, "IssuerPrecinct", "ViolationCode", rules.top_three, exclude=rules.precinct_sentinels)


def code_mix_filtered(timed: DataFrame, rules: TicketRules) -> DataFrame:
    return rank.mix_within_top(
        timed, "IssuerPrecinct", "ViolationCode", rules.top_three, exclude=rules.precinct_sentinels, items=rules.followed_codes
    )


def nulls(timed: DataFrame, rules: TicketRules) -> DataFrame:
    return profile.null_profile(timed)


def period_frequency(timed: DataFrame, rules: TicketRules) -> DataFrame:
    return agg.frequency(timed, "ViolationPeriod")


def hour_frequency(timed: DataFrame, rules: TicketRules) -> DataFrame:
    return agg.frequency(timed, "ViolationHour", where=F.col("ViolationPeriod").isin("AM", "PM"))


def hour_frequency_min10(timed: DataFrame, rules: TicketRules) -> DataFrame:
    return agg.frequency(timed, "ViolationHour", where=F.col("ViolationPeriod").isin("AM", "PM"), min_count=10)


def valid_time_counts(timed: DataFrame, rules: TicketRules) -> DataFrame:
    return quality.reconcile(timed, [valid_clock("ViolationHour", "ViolationPeriod")])


def month_frequency(timed: DataFrame, rules: TicketRules) -> DataFrame:
    return agg.frequency(timed, "IssueMonth")


TIME_ANALYSES = {
    "k03_time_parts": time_parts,
    "k04a_distinct_summons": distinct_summons,
    "k04b_distinct_states": distinct_states,
    "k05_state_frequency": state_frequency,
    "k06_recode_to_mode": state_frequency_recoded,
    "k06b_distinct_after_recode": distinct_states_recoded,
    "k06c_recoded_rows": state_recoded_rows,
    "k07a_top_codes": _top("ViolationCode", "top_five"),
    "k07b_top_body_types": _top("VehicleBodyType", "top_five"),
    "k07c_top_makes": _top("VehicleMake", "top_five"),
    "k07d_top_violation_precincts": _top("ViolationPrecinct", "top_five"),
    "k08a_top_violation_precincts_valid": _top("ViolationPrecinct", "top_five", valid_only=True),
    "k08b_top_issuer_precincts_valid": _top("IssuerPrecinct", "top_five", valid_only=True),
    "k09_top_issuer_precincts": _top("IssuerPrecinct", "top_three", valid_only=True),
    "k10_code_mix_in_top_precincts": code_mix_in_top_precincts,
    "k11_code_mix_filtered": code_mix_filtered,
    "k12_null_profile": nulls,
    "k13_period_frequency": period_frequency,
    "k14a_hour_frequency": hour_frequency,
    "k14b_hour_frequency_min10": hour_frequency_min10,
    "k15_valid_time_filter": valid_time_counts,
    "k20_month_frequency": month_frequency,
}


# ---- time of day (valid clock codes only) ----------------------------------------


def time_of_day_rows(binned: DataFrame, rules: TicketRules) -> DataFrame:
    return binned.select("SummonsNumber", "ViolationHour", "ViolationPeriod", "TimeOfDay")


def top_codes_per_bin(binned: DataFrame, rules: TicketRules) -> DataFrame:
    return rank.top_k_per_group(binned, "TimeOfDay", "ViolationCode", rules.top_three)


def top_codes(binned: DataFrame, rules: TicketRules) -> DataFrame:
    return agg.top_n(binned, "ViolationCode", rules.top_three, count_col="TicketCount")


def top_bins_per_top_code(binned: DataFrame, rules: TicketRules) -> DataFrame:
    """Top bins of the most frequent codes, from one aggregation.

    Code totals and the top codes are summed from the (code, bin) counts.
    The chosen codes (at most 3, a scalar array) select their counts with a
    filter that also reads the count, so it stays above the aggregation and
    both branches share one exchange: the rows are scanned and shuffled
    once. As in the original equality join, a NULL code may take a top slot
    but never matches.
    """
    pairs = binned.groupBy("ViolationCode", "TimeOfDay").agg(F.count(F.lit(1)).alias("TicketCount"))
    totals = pairs.groupBy("ViolationCode").agg(F.sum("TicketCount").alias("_total"))
    top = totals.orderBy(F.col("_total").desc(), F.col("ViolationCode").asc()).limit(rules.top_three)
    chosen_codes = top.agg(F.collect_list("ViolationCode")).scalar()
    keep = F.when(F.col("TicketCount") > 0, F.array_contains(chosen_codes, F.col("ViolationCode")))
    return rank.rank_counted(pairs.filter(keep), "ViolationCode", "TicketCount", rules.top_three)


BIN_ANALYSES = {
    "k16_time_of_day_bin": time_of_day_rows,
    "k17_top_codes_per_bin": top_codes_per_bin,
    "k18_top_codes": top_codes,
    "k19_top_bins_per_top_code": top_bins_per_top_code,
}


# ---- seasons -------------------------------------------------------------------


def season_rows(seasonal: DataFrame, rules: TicketRules) -> DataFrame:
    return seasonal.select("SummonsNumber", "IssueMonth", "Season")


def season_frequency(seasonal: DataFrame, rules: TicketRules) -> DataFrame:
    return agg.frequency(seasonal, "Season")


def top_codes_per_season(seasonal: DataFrame, rules: TicketRules) -> DataFrame:
    return rank.top_k_per_group(seasonal, "Season", "ViolationCode", rules.top_three)


SEASON_ANALYSES = {
    "k21_season_bin": season_rows,
    "k21b_season_frequency": season_frequency,
    "k22_top_codes_per_season": top_codes_per_season,
}


# ---- revenue -------------------------------------------------------------------


def revenue(top: DataFrame, fines: DataFrame) -> DataFrame:
    """Ticket count times fine for each code of ``top``. The planner knows
    the size of a literal or stored fine table and picks the join by it."""
    joined = top.join(fines, "ViolationCode")
    return joined.select(
        "ViolationCode",
        "TicketCount",
        "FineAmount",
        (F.col("TicketCount") * F.col("FineAmount")).alias("TotalRevenue"),
    )


def ticket_report(
    raw: DataFrame, fines: DataFrame | None = None, rules: TicketRules = REFERENCE_TICKET_RULES
) -> dict[str, DataFrame]:
    """Every ticket analysis for a ticket table whose names are free of
    spaces (``normalise_names``): shape, time parts, counts, top lists,
    mixes, time-of-day and season rankings, and -- given a fine table with
    ``ViolationCode, FineAmount`` -- the revenue estimate. Lazy."""
    timed = derive_ticket_time(raw)
    binned = with_time_of_day(valid_time(timed))
    seasonal = with_season(binned)
    report = {"k02_shape": shape(raw)}
    report.update({k: fn(timed, rules) for k, fn in TIME_ANALYSES.items()})
    report.update({k: fn(binned, rules) for k, fn in BIN_ANALYSES.items()})
    report.update({k: fn(seasonal, rules) for k, fn in SEASON_ANALYSES.items()})
    if fines is not None:
        report["k23_revenue_estimate"] = revenue(top_codes(binned, rules), fines)
    return report


def k23_revenue_estimate(spark, folder):
    return revenue(top_codes(_binned(spark, folder), BOUND_TICKET_RULES), bound_fines(spark))


def top_per_group_sql(view: str, group: str, item: str, k: int) -> str:
    """``rank.top_k_per_group`` as SQL text over a registered view: a
    counting step, then a ranking step over what was counted."""
    return f"""
        WITH counted AS (SELECT {group}, {item}, count(*) AS TicketCount FROM {view} GROUP BY ALL),
        placed AS (SELECT *, dense_rank() OVER (PARTITION BY {group} ORDER BY TicketCount DESC) AS Rank FROM counted)
        SELECT * FROM placed WHERE Rank <= {k}
    """


def k17b_top_codes_per_bin_sql(spark, folder):
    view = f"tickets_bin_{uuid.uuid4().hex[:12]}"
    _binned(spark, folder).createOrReplaceTempView(view)
    out = spark.sql(top_per_group_sql(view, "TimeOfDay", "ViolationCode", BOUND_TICKET_RULES.top_three))
    spark.catalog.dropTempView(view)  # the analysed query no longer needs it
    return out


def k07e_top_owners_heavy(spark, folder):
    """The five owners with the most tickets, where three tickets of ten go
    to one of six fleets and any other is its owner's only one."""
    fleet = F.concat(F.lit("fleet "), F.col("ViolationCode") % 6)
    owner = F.when(F.col("SummonsNumber") % 10 < 3, fleet).otherwise(F.concat(F.lit("owner "), F.col("SummonsNumber")))
    return heavy.top_n_heavy(tickets(spark, folder).select(owner.alias("Owner")), "Owner", BOUND_TICKET_RULES.top_five)


SKETCHED_COLUMNS = ("RegistrationState", "ViolationCode", "VehicleMake", "SummonsNumber", "ViolationTime")


def stored_sketches(timed: DataFrame, path: str) -> DataFrame:
    """Distinct values per column, from sketches stored per issue month and
    merged: the estimate where the sketch holds every value and is exact, and
    everywhere whether it is within its stated error of the exact count."""
    sketches.write_distinct_sketches(timed, path, SKETCHED_COLUMNS, "IssueMonth")
    merged = sketches.distinct_from_sketches(timed.sparkSession, path)
    exact = profile.column_profile(timed.select(*SKETCHED_COLUMNS)).select("column_name", F.col("distinct_count").alias("exact"))
    off = F.abs(F.col("distinct_estimate") - F.col("exact"))
    return merged.join(exact, "column_name").select(
        "column_name",
        F.when(F.col("exact") <= 1 << sketches.LG_K, F.col("distinct_estimate").cast("string"))
        .otherwise(f"over {1 << sketches.LG_K}")
        .alias("distinct_estimate"),
        (off <= sketches.stated_error() * F.col("exact")).alias("within_stated_error"),
        "n_partitions",
        "n_rows",
    )


def k04c_stored_distinct_sketches(spark, folder):
    _, path = tables.table_location(spark, "ticket_sketches")
    return stored_sketches(_shipment_time(spark, folder), path)


def _shipment_time(spark: SparkSession, folder: str) -> DataFrame:
    return derive_ticket_time(tickets_by_shipment(spark, folder))


def _bound(key: str, analysis, stage):
    def query(spark, folder):
        return analysis(stage(spark, folder), BOUND_TICKET_RULES)

    query.__name__ = key
    return query


# Months and seasons run on the shipment binding (events cover one month).
QUERIES = {
    "k01_ingest_renamed": k01_ingest_renamed,
    "k01b_ingest_inferred": k01b_ingest_inferred,
    "k02_shape": k02_shape,
    **{k: _bound(k, fn, _time) for k, fn in TIME_ANALYSES.items() if k != "k20_month_frequency"},
    **{k: _bound(k, fn, _binned) for k, fn in BIN_ANALYSES.items()},
    "k04c_stored_distinct_sketches": k04c_stored_distinct_sketches,
    "k07e_top_owners_heavy": k07e_top_owners_heavy,
    "k17b_top_codes_per_bin_sql": k17b_top_codes_per_bin_sql,
    "k20_month_frequency": _bound("k20_month_frequency", month_frequency, _shipment_time),
    **{k: _bound(k, fn, _seasonal) for k, fn in SEASON_ANALYSES.items()},
    "k23_revenue_estimate": k23_revenue_estimate,
}
