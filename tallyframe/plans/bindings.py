"""Role bindings: the trip and ticket tables derived from the test tables.

The original trip and ticket files are not available, so each role is a
projection (and for trips a join) of the generated star-schema tables.
Every binding is lazy and keeps all rows of its tables; what a query does
not need is pruned from its scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.clock import clock_code
from tallyframe.sources.tables import literal_table, read_parquet

# Columns that name a trip row; no analysis reads them but the sample.
TRIP_KEYS = ("trip_order", "trip_line", "trip_part", "trip_supplier", "trip_quantity")


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """The trip table: every lineitem row that has an order, in the 17
    columns of the original file."""
    return keyed_trips(spark, folder).drop(*TRIP_KEYS)


def keyed_trips(spark: SparkSession, folder: str) -> DataFrame:
    """trips = lineitem joined to its order, with the row's keys in front.

    The join is on the order key between two large tables (shuffle join,
    both sides shuffled once). The pickup is the order date; the dropoff is
    up to 90 minutes later, by an amount derived from the row's keys, and
    equal to the pickup for one part in 97, as zero durations occur in the
    original file. Tolls of small trips go below zero.
    """
    li = read_parquet(spark, folder, "lineitem")
    orders = read_parquet(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey)
    moved = 60 + F.pmod(F.col("l_orderkey") * 31 + F.col("l_linenumber") * 977, F.lit(5340))
    seconds = F.when(F.col("l_partkey") % 97 == 0, F.lit(0)).otherwise(moved)
    return joined.select(
        F.col("l_orderkey").alias("trip_order"),
        F.col("l_linenumber").alias("trip_line"),
        F.col("l_partkey").alias("trip_part"),
        F.col("l_suppkey").alias("trip_supplier"),
        F.col("l_quantity").alias("trip_quantity"),
        (F.col("l_suppkey") % 2 + 1).cast("int").alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).alias("tpep_dropoff_datetime"),
        (F.col("l_linenumber") - 1).cast("int").alias("passenger_count"),
        (F.col("l_quantity") - F.lit(1.0)).alias("trip_distance"),
        (F.col("l_suppkey") % 6 + 1).cast("int").alias("RatecodeID"),
        F.when(F.col("l_linestatus") == "O", F.lit("Y")).otherwise(F.lit("N")).alias("store_and_fwd_flag"),
        F.col("l_suppkey").cast("int").alias("PULocationID"),
        F.col("l_partkey").cast("int").alias("DOLocationID"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        (F.col("l_quantity") * F.col("l_discount") * F.lit(10.0)).alias("tip_amount"),
        F.when(F.col("l_orderkey") % 5 == 0, F.col("l_quantity") * F.lit(0.25) - F.lit(1.0))
        .otherwise(F.lit(0.0))
        .alias("tolls_amount"),
        F.when(F.col("l_partkey") % 9 == 0, F.lit(0.35)).otherwise(F.lit(0.30)).alias("improvement_surcharge"),
        F.when(F.col("l_tax") == 0, F.lit(0.0))
        .otherwise(F.col("l_extendedprice") - F.lit(20000.0))
        .alias("total_amount"),
    )


def _ticket_columns(
    summons, plate, state, issued, code, body, make, v_precinct, i_precinct, vtime
) -> list:
    return [
        summons.alias("SummonsNumber"),
        plate.alias("PlateID"),
        state.alias("RegistrationState"),
        issued.alias("IssueDate"),
        code.alias("ViolationCode"),
        body.alias("VehicleBodyType"),
        make.alias("VehicleMake"),
        v_precinct.alias("ViolationPrecinct"),
        i_precinct.alias("IssuerPrecinct"),
        vtime.alias("ViolationTime"),
    ]


def tickets(spark: SparkSession, folder: str) -> DataFrame:
    """tickets = events, with names already free of spaces.

    The clock code is the event time as ``hhmmA``; every 500th event has
    the text ``nan`` and every 1999th an hour of ``27``, so malformed
    periods and hours occur as in the original data.
    """
    ev = read_parquet(spark, folder, "events")
    eid, uid, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    bad_hour = F.concat(F.lit("27"), F.date_format(ts, "mm"), F.substring(F.date_format(ts, "a"), 1, 1))
    vtime = F.when(eid % 500 == 0, F.lit("nan")).when(eid % 1999 == 0, bad_hour).otherwise(clock_code(ts))
    return ev.select(
        *_ticket_columns(
            eid,
            uid.cast("string"),
            F.get_json_object("props", "$.k"),
            ts,
            (uid % 20).cast("int"),
            F.col("event_type"),
            (uid % 7).cast("string"),
            (uid % 31).cast("int"),
            (uid % 13).cast("int"),
            vtime,
        )
    )


def tickets_by_shipment(spark: SparkSession, folder: str) -> DataFrame:
    """A second ticket binding over lineitem, whose ship dates span all
    months (events cover one month only): used for months and seasons. The
    clock hour runs from 00 to 13, so that 13 is rejected as malformed."""
    li = read_parquet(spark, folder, "lineitem")
    hour = F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(14))
    minute = F.pmod(F.col("l_partkey"), F.lit(60))
    half = F.when(F.col("l_suppkey") % 2 == 0, F.lit("A")).otherwise(F.lit("P"))
    code = F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lpad(minute.cast("string"), 2, "0"), half)
    return li.select(
        *_ticket_columns(
            F.col("l_orderkey") * 8 + F.col("l_linenumber"),
            F.col("l_partkey").cast("string"),
            F.col("l_returnflag"),
            F.col("l_shipdate"),
            F.col("l_suppkey").cast("int"),
            F.col("l_linestatus"),
            (F.col("l_partkey") % 7).cast("string"),
            (F.col("l_suppkey") % 31).cast("int"),
            (F.col("l_suppkey") % 13).cast("int"),
            code,
        )
    )


# The average fine per violation code used by the original
# revenue estimate (codes 21, 36 and 38).
REFERENCE_FINES = [(21, 55), (36, 50), (38, 50)]

# The bound ticket codes run 0-19; code c is given the fine 35 + c.
BOUND_FINE_CODES = range(20)


def bound_fines(spark: SparkSession) -> DataFrame:
    rows = [(c, 35 + c) for c in BOUND_FINE_CODES]
    return literal_table(spark, rows, "ViolationCode int, FineAmount int")


def reference_fines(spark: SparkSession) -> DataFrame:
    return literal_table(spark, REFERENCE_FINES, "ViolationCode int, FineAmount int")
