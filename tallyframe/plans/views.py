"""Session views of the analysis stages, for SQL text over them.

Each view is a lazy plan (nothing is cached or computed at registration),
so SQL over a view gets the same optimisation as the DataFrame form.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyframe.plans.bindings import tickets, tickets_by_shipment, trips
from tallyframe.plans.tickets import derive_ticket_time, valid_time, with_season, with_time_of_day
from tallyframe.plans.trips import BOUND_RULES, TripRules, clean_trips


def register_trip_views(spark: SparkSession, folder: str, rules: TripRules = BOUND_RULES) -> list[str]:
    """``trips_raw`` and ``trips_clean``."""
    raw = trips(spark, folder)
    raw.createOrReplaceTempView("trips_raw")
    clean_trips(raw, rules).createOrReplaceTempView("trips_clean")
    return ["trips_raw", "trips_clean"]


def register_ticket_views(spark: SparkSession, folder: str) -> list[str]:
    """``tickets_raw``, ``tickets_time`` (date and clock parts),
    ``tickets_bin`` (valid clock codes with the time of day) and
    ``tickets_season`` (the shipment binding, with seasons)."""
    raw = tickets(spark, folder)
    raw.createOrReplaceTempView("tickets_raw")
    timed = derive_ticket_time(raw)
    timed.createOrReplaceTempView("tickets_time")
    with_time_of_day(valid_time(timed)).createOrReplaceTempView("tickets_bin")
    seasonal = with_season(with_time_of_day(valid_time(derive_ticket_time(tickets_by_shipment(spark, folder)))))
    seasonal.createOrReplaceTempView("tickets_season")
    return ["tickets_raw", "tickets_time", "tickets_bin", "tickets_season"]
