"""DuckDB SQL equivalents of every registered query (the correctness oracle).

Written as plain SQL over the test tables (views ``lineitem``, ``orders``,
``events``), independently of the Spark operators: the role bindings are
CTEs and each query spells out its own CASE, window and rounding logic.

Parity rules between the two engines:
- rounding is half-up on the decimal form: Spark rounds a double by its
  decimal text, here the value goes through ``DECIMAL(38,12)`` (the test
  values are far below its limit);
- integer parts (year, month, rank) are cast to INTEGER;
- division by a zero duration is NULL (``NULLIF``) as ``try_divide`` is;
- ``||`` is used where Spark's ``concat`` propagates NULL.
"""

from __future__ import annotations


def R(expr: str, digits: int = 2) -> str:
    """Half-up rounding on the decimal form."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


TRIPS_CTE = """
keyed_trips AS (
  SELECT l.l_orderkey AS trip_order, l.l_linenumber AS trip_line, l.l_partkey AS trip_part,
         l.l_suppkey AS trip_supplier, l.l_quantity AS trip_quantity,
         CAST(l.l_suppkey % 2 + 1 AS INTEGER) AS VendorID,
         o.o_orderdate AS tpep_pickup_datetime,
         o.o_orderdate + to_seconds(CASE WHEN l.l_partkey % 97 = 0 THEN 0
           ELSE 60 + (l.l_orderkey * 31 + l.l_linenumber * 977) % 5340 END) AS tpep_dropoff_datetime,
         CAST(l.l_linenumber - 1 AS INTEGER) AS passenger_count,
         l.l_quantity - CAST(1 AS DOUBLE) AS trip_distance,
         CAST(l.l_suppkey % 6 + 1 AS INTEGER) AS RatecodeID,
         CASE WHEN l.l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
         CAST(l.l_suppkey AS INTEGER) AS PULocationID,
         CAST(l.l_partkey AS INTEGER) AS DOLocationID,
         CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS payment_type,
         l.l_extendedprice AS fare_amount,
         l.l_discount AS extra,
         l.l_tax AS mta_tax,
         l.l_quantity * l.l_discount * CAST(10 AS DOUBLE) AS tip_amount,
         CASE WHEN l.l_orderkey % 5 = 0 THEN l.l_quantity * CAST(0.25 AS DOUBLE) - CAST(1 AS DOUBLE)
           ELSE CAST(0 AS DOUBLE) END AS tolls_amount,
         CASE WHEN l.l_partkey % 9 = 0 THEN CAST(0.35 AS DOUBLE) ELSE CAST(0.30 AS DOUBLE) END
           AS improvement_surcharge,
         CASE WHEN l.l_tax = 0 THEN CAST(0 AS DOUBLE) ELSE l.l_extendedprice - CAST(20000 AS DOUBLE) END
           AS total_amount
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
trips AS (
  SELECT * EXCLUDE (trip_order, trip_line, trip_part, trip_supplier, trip_quantity) FROM keyed_trips
)"""

TRIP_COLUMNS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
    "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type", "fare_amount", "extra",
    "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
]

DOUBLE_COLUMNS = [
    "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount",
]

VALID_TRIP = """year(tpep_pickup_datetime) = 1997
    AND month(tpep_pickup_datetime) IN (5, 6, 7, 8, 9, 11, 12)
    AND total_amount > 0
    AND trip_distance > 0
    AND passenger_count > 0
    AND extra IN (0.0, 0.01, 0.02, 0.03, 0.04, 0.05)
    AND improvement_surcharge = 0.30"""

CLEAN_CTE = f"""
clean AS (
  SELECT *,
         CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
         CAST(tpep_pickup_datetime AS DATE) AS date,
         CAST(month(tpep_pickup_datetime) AS INTEGER) AS month
  FROM trips
  WHERE {VALID_TRIP}
)"""

SPEED = R(
    "trip_distance / NULLIF((floor(epoch(tpep_dropoff_datetime)) - floor(epoch(tpep_pickup_datetime)))"
    " / CAST(3600 AS DOUBLE), 0)"
)
ON_DATES = "date IN (DATE '1997-12-31', DATE '1997-12-25')"


def _with_trips(body: str) -> str:
    return f"WITH {TRIPS_CTE}\n{body}"


def _with_clean(body: str) -> str:
    return f"WITH {TRIPS_CTE},{CLEAN_CTE}\n{body}"


def _share(key: str, source: str = "clean") -> str:
    return (
        f"SELECT {key}, {R(f'count({key}) / (SELECT count(*) FROM {source}) * 100.0')} AS Percentage_of_Total "
        f"FROM {source} GROUP BY {key}"
    )


def _catalog_statistics() -> str:
    """Text and numbers as the catalog shows them: a double with a decimal
    point, no bounds of text, lengths of fixed-size types by their size."""
    size = {"tpep_pickup_datetime": 8, "tpep_dropoff_datetime": 8, **dict.fromkeys(DOUBLE_COLUMNS, 8)}
    parts = []
    for c in TRIP_COLUMNS:
        text = c == "store_and_fwd_flag"
        shown = "strftime({e}, '%Y-%m-%d %H:%M:%S.%f')" if "datetime" in c else "CAST({e} AS VARCHAR)"
        low, high = ("CAST(NULL AS VARCHAR)" if text else shown.format(e=f"{f}({c})") for f in ("min", "max"))
        lengths = [f"{f}(length({c}))" if text else str(size.get(c, 4)) for f in ("avg", "max")]
        bins = 0 if text else 64
        parts.append(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS num_nulls, {low} AS min_value, {high} AS max_value, "
            f"CAST(ceil({lengths[0]}) AS BIGINT) AS avg_len, CAST({lengths[1]} AS BIGINT) AS max_len, "
            f"true AS distinct_within_error, CAST({bins} AS BIGINT) AS histogram_bins, "
            f"{'false' if text else 'true'} AS bins_hold_all_rows FROM trips"
        )
    return _with_trips("\nUNION ALL\n".join(parts))


def _column_profile(sketched: bool = False) -> str:
    types = {
        "VendorID": "int", "tpep_pickup_datetime": "timestamp_ntz", "tpep_dropoff_datetime": "timestamp_ntz",
        "passenger_count": "int", "trip_distance": "double", "store_and_fwd_flag": "string",
        "RatecodeID": "int", "tolls_amount": "double", "PULocationID": "int", "DOLocationID": "int", "payment_type": "int", "fare_amount": "double",
        "extra": "double", "mta_tax": "double", "tip_amount": "double", "improvement_surcharge": "double",
        "total_amount": "double",
    }
    distinct = "count(DISTINCT {c}) AS distinct_count"
    if sketched:
        distinct = "true AS distinct_within_error"
    parts = []
    for c in TRIP_COLUMNS:
        text = types[c] == "string"
        avg_len = f"avg(length({c}))" if text else "CAST(NULL AS DOUBLE)"
        max_len = f"CAST(max(length({c})) AS DOUBLE)" if text else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, '{types[c]}' AS data_type, "
            f"count(*) - count({c}) AS num_nulls, {distinct.format(c=c)}, "
            f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, "
            f"{avg_len} AS avg_len, {max_len} AS max_len FROM trips"
        )
    return _with_trips("\nUNION ALL\n".join(parts))


# The two sets of tip bands, as asked and as written. In the
# second, 10.01-15.00 carries the label of the first band, and what lies in
# no range is another amount.
TIP_BANDS_HALF_OPEN_SQL = """CASE
            WHEN tip_amount >= 0 AND tip_amount < 5 THEN '[0-5)'
            WHEN tip_amount >= 5 AND tip_amount < 10 THEN '[5-10)'
            WHEN tip_amount >= 10 AND tip_amount < 15 THEN '[10-15)'
            WHEN tip_amount >= 15 AND tip_amount < 20 THEN '[15-20)'
            WHEN tip_amount >= 20 THEN '>=20'
            ELSE 'Other amount' END"""

TIP_BANDS_AS_WRITTEN_SQL = """CASE
            WHEN tip_amount BETWEEN 0.00 AND 5.00 THEN 'Tip between $0.00 - $5.00'
            WHEN tip_amount BETWEEN 5.01 AND 10.00 THEN 'Tip between $5.01 - $10.00'
            WHEN tip_amount BETWEEN 10.01 AND 15.00 THEN 'Tip between $0.00 - $5.00'
            WHEN tip_amount BETWEEN 15.01 AND 20.00 THEN 'Tip between $15.01 - $20.00'
            WHEN tip_amount > 20.00 THEN 'Tip greater than $20'
            ELSE 'Other amount' END"""


def _band_share(case_sql: str) -> str:
    return _with_clean(
        f"SELECT Range_of_tip_amount, "
        f"{R('count(Range_of_tip_amount) / (SELECT count(*) FROM clean) * 100.0')} AS Percentage_of_Total "
        f"FROM (SELECT {case_sql} AS Range_of_tip_amount FROM clean) b GROUP BY Range_of_tip_amount"
    )


TRIP_ORACLE = {
    "t01_raw_sample": _with_trips(
        "SELECT * EXCLUDE (trip_order, trip_line, trip_part, trip_supplier, trip_quantity) FROM keyed_trips "
        "ORDER BY trip_order, trip_line, trip_part, trip_supplier, trip_quantity LIMIT 100"
    ),
    "t02_row_count": _with_trips('SELECT count(*) AS "count" FROM trips'),
    "t03_period_profile": _with_trips(
        "SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS year, "
        "CAST(month(tpep_pickup_datetime) AS INTEGER) AS month, count(VendorID) AS \"count\" "
        "FROM trips GROUP BY 1, 2"
    ),
    "t04_column_profile": _column_profile(),
    "t04b_column_profile_sketched": _column_profile(sketched=True),
    "t05a_passenger_frequency": _with_trips(
        'SELECT passenger_count, count(*) AS "count" FROM trips GROUP BY passenger_count'
    ),
    "t05b_payment_frequency": _with_trips(
        'SELECT payment_type, count(*) AS "count" FROM trips GROUP BY payment_type'
    ),
    "t05c_clean_passenger_frequency": _with_clean(
        'SELECT passenger_count, count(*) AS "count" FROM clean GROUP BY passenger_count'
    ),
    "t06_zero_passengers_by_vendor": _with_trips(
        'SELECT VendorID, count(*) AS "count" FROM trips WHERE passenger_count <= 0 GROUP BY VendorID'
    ),
    "t07_any_negative_by_vendor": _with_trips(
        'SELECT VendorID, count(*) AS "count" FROM trips '
        "WHERE least(fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount) < 0 "
        "GROUP BY VendorID"
    ),
    "t08_zero_total_by_vendor_payment": _with_trips(
        'SELECT VendorID, payment_type, count(*) AS "count" FROM trips '
        "WHERE total_amount = 0.00 GROUP BY VendorID, payment_type"
    ),
    "t09_zero_total_by_vendor_distance": _with_trips(
        'SELECT VendorID, trip_distance, count(*) AS "count" FROM trips '
        "WHERE total_amount = 0.00 GROUP BY VendorID, trip_distance HAVING trip_distance <> 0.00"
    ),
    "t10_zero_distance_by_vendor_payment": _with_trips(
        'SELECT VendorID, payment_type, count(*) AS "count" FROM trips '
        "WHERE trip_distance = 0.00 GROUP BY VendorID, payment_type"
    ),
    "t11a_extra_by_vendor": _with_trips(
        'SELECT VendorID, extra, count(*) AS "count" FROM trips GROUP BY VendorID, extra'
    ),
    "t11b_surcharge_by_vendor": _with_trips(
        'SELECT VendorID, improvement_surcharge, count(*) AS "count" FROM trips '
        "GROUP BY VendorID, improvement_surcharge"
    ),
    "t12_extra_out_of_domain": _with_trips(
        'SELECT VendorID, count(*) AS "count" FROM trips '
        "WHERE extra NOT IN (0.0, 0.01, 0.02, 0.03, 0.04, 0.05) GROUP BY VendorID"
    ),
    "t13_valid_count": _with_clean('SELECT count(*) AS "count" FROM clean'),
    "t14a_csv_landing_scan": _with_trips("SELECT * FROM trips"),
    "t14_clean_load": _with_clean("SELECT * FROM clean"),
    "t14b_reload_and_drop": _with_clean(
        'SELECT month, count(*) AS "count" FROM clean WHERE month <> 12 OR VendorID = 1 GROUP BY month'
    ),
    "t14c_rejected_lines": _with_trips(
        "SELECT CASE WHEN trip_part % 101 = 0 THEN 'passenger_count' "
        "WHEN trip_part % 103 = 0 OR trip_part % 107 = 0 THEN 'cells' ELSE 'none' END AS reason, "
        "count(*) AS n, CAST(CASE WHEN reason = 'none' THEN sum(passenger_count) ELSE 0 END AS BIGINT) AS passengers "
        "FROM keyed_trips GROUP BY 1"
    ),
    "t15b_content_reconciliation": _with_clean(
        "SELECT month, count(*) AS expected_rows, count(*) AS loaded_rows, true AS same_contents FROM clean GROUP BY month"
    ),
    "t04c_catalog_statistics": _catalog_statistics(),
    "t23b_speed_by_date_bucketed": _with_clean(
        f"SELECT date, {R(f'avg({SPEED})')} AS average_mph FROM clean GROUP BY date"
    ),
    "t23c_speed_in_listed_months": _with_clean(
        f"SELECT month, {R(f'avg({SPEED})')} AS average_mph FROM clean WHERE month IN (7, 8, 9) GROUP BY month"
    ),
    # An hour more passes where a trip starts before the clocks go back, at two, and ends after.
    "t23d_seconds_over_clock_change": _with_trips(
        "SELECT CAST(hour(ended) AS INTEGER) AS end_hour, s AS seconds_utc, "
        "CASE WHEN ended >= TIMESTAMP '2017-11-05 02:00:00' THEN s + 3600 ELSE s END AS seconds_local, "
        'count(*) AS "count" FROM (SELECT s, TIMESTAMP \'2017-11-05 00:30:00\' + to_minutes(trip_line) + to_seconds(s) AS ended '
        "FROM (SELECT trip_line, CAST(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) "
        "+ 7200 * (trip_line % 2) AS BIGINT) AS s FROM keyed_trips)) GROUP BY 1, 2, 3"
    ),
    "t15_load_reconciliation": _with_clean(
        "SELECT r.raw_rows, c.loaded_rows, r.raw_rows - c.loaded_rows AS rejected_rows, "
        "CAST(0 AS BIGINT) AS lost_rows FROM (SELECT count(*) AS raw_rows FROM trips) r, "
        "(SELECT count(*) AS loaded_rows FROM clean) c"
    ),
    "t16_avg_fare_by_period": _with_clean(
        f"SELECT year, month, {R('avg(fare_amount)')} AS avg_fare FROM clean GROUP BY year, month"
    ),
    "t17a_passenger_share": _with_clean(_share("passenger_count")),
    "t17b_extra_share": _with_clean(_share("extra")),
    "t18_payment_share": _with_clean(
        "SELECT coalesce(l.label, 'Unknown') AS payment_type, "
        f"g.code AS payment_type_code, {R('n / total * 100.0')} AS Percentage_of_Total "
        "FROM (SELECT payment_type AS code, count(payment_type) AS n, "
        "(SELECT count(*) FROM clean) AS total FROM clean GROUP BY payment_type) g "
        "LEFT JOIN (VALUES (1, 'Credit Card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'), "
        "(5, 'Unknown'), (6, 'Voided trip')) l(code, label) ON g.code = l.code"
    ),
    "t19_tip_mean_vs_percentiles": _with_clean(
        f"SELECT {R('avg(tip_amount)')} AS average_tip, "
        "quantile_disc(tip_amount, 0.25) AS p25_tip, quantile_disc(tip_amount, 0.50) AS p50_tip, "
        "quantile_disc(tip_amount, 0.75) AS p75_tip FROM clean"
    ),
    "t19b_fare_mean_vs_percentiles": _with_trips(
        f"SELECT {R('avg(fare_amount)')} AS average_fare, "
        "quantile_disc(fare_amount, 0.25) AS p25_fare, quantile_disc(fare_amount, 0.50) AS p50_fare, "
        "quantile_disc(fare_amount, 0.75) AS p75_fare FROM trips"
    ),
    "t20_extra_flag_share": _with_clean(
        f"SELECT extra, {R('count(extra) / (SELECT count(*) FROM clean) * 100.0')} AS Percentage_of_Total "
        "FROM (SELECT CASE WHEN extra <> 0 OR extra IS NULL THEN 'Extra Charged' ELSE 'No Extra Charged' END AS extra "
        "FROM clean) f GROUP BY extra"
    ),
    "t21_correlation": _with_clean(f"SELECT {R('corr(passenger_count, tip_amount)', 6)} AS correlation FROM clean"),
    "t22a_tip_band_share": _band_share(TIP_BANDS_HALF_OPEN_SQL),
    "t22b_tip_band_share_as_written": _band_share(TIP_BANDS_AS_WRITTEN_SQL),
    "t23_speed_by_month": _with_clean(f"SELECT month, {R(f'avg({SPEED})')} AS average_mph FROM clean GROUP BY month"),
    "t24_speed_overall": _with_clean(f"SELECT {R(f'avg({SPEED})')} AS average_total_mph FROM clean"),
    "t25_speed_on_dates": _with_clean(
        f"SELECT date, {R(f'avg({SPEED})')} AS average_daily_mph FROM clean WHERE {ON_DATES} GROUP BY date"
    ),
    "t26_speed_vs_overall": _with_clean(
        "SELECT date, "
        + R(f"((avg({SPEED}) / NULLIF((SELECT {R(f'avg({SPEED})')} FROM clean), 0)) - 1) * 100.0")
        + f" AS pct_vs_overall FROM clean WHERE {ON_DATES} GROUP BY date"
    ),
}
# The forms over the loaded table have the same answers.
for _key in (
    "t16_avg_fare_by_period", "t17a_passenger_share", "t18_payment_share", "t19_tip_mean_vs_percentiles",
    "t21_correlation", "t22a_tip_band_share", "t23_speed_by_month", "t26_speed_vs_overall",
):
    TRIP_ORACLE[f"{_key}_loaded"] = TRIP_ORACLE[_key]


# ---- tickets -------------------------------------------------------------------

TICKETS_CTE = """
tickets AS (
  SELECT event_id AS SummonsNumber,
         CAST(user_id AS VARCHAR) AS PlateID,
         json_extract_string(props, '$.k') AS RegistrationState,
         ts AS IssueDate,
         CAST(user_id % 20 AS INTEGER) AS ViolationCode,
         event_type AS VehicleBodyType,
         CAST(user_id % 7 AS VARCHAR) AS VehicleMake,
         CAST(user_id % 31 AS INTEGER) AS ViolationPrecinct,
         CAST(user_id % 13 AS INTEGER) AS IssuerPrecinct,
         CASE WHEN event_id % 500 = 0 THEN 'nan'
              WHEN event_id % 1999 = 0 THEN '27' || strftime(ts, '%M') || substr(strftime(ts, '%p'), 1, 1)
              ELSE strftime(ts, '%I%M') || substr(strftime(ts, '%p'), 1, 1) END AS ViolationTime
  FROM events
)"""

SHIPMENTS_CTE = """
tickets AS (
  SELECT l_orderkey * 8 + l_linenumber AS SummonsNumber,
         CAST(l_partkey AS VARCHAR) AS PlateID,
         l_returnflag AS RegistrationState,
         l_shipdate AS IssueDate,
         CAST(l_suppkey AS INTEGER) AS ViolationCode,
         l_linestatus AS VehicleBodyType,
         CAST(l_partkey % 7 AS VARCHAR) AS VehicleMake,
         CAST(l_suppkey % 31 AS INTEGER) AS ViolationPrecinct,
         CAST(l_suppkey % 13 AS INTEGER) AS IssuerPrecinct,
         lpad(CAST((l_orderkey * 7 + l_linenumber) % 14 AS VARCHAR), 2, '0')
           || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0')
           || CASE WHEN l_suppkey % 2 = 0 THEN 'A' ELSE 'P' END AS ViolationTime
  FROM lineitem
)"""

TIME_CTE = """
ticket_time AS (
  SELECT CAST(year(IssueDate) AS INTEGER) AS IssueYear,
         CAST(month(IssueDate) AS INTEGER) AS IssueMonth,
         CAST(IssueDate AS DATE) AS IssueDt,
         *,
         substr(ViolationTime, 1, 2) AS ViolationHour,
         substr(ViolationTime, 3, 2) AS ViolationMinute,
         substr(ViolationTime, 5, 1) || 'M' AS ViolationPeriod
  FROM tickets
)"""

VALID_TIME = (
    "ViolationPeriod IN ('AM', 'PM') AND ViolationHour IN "
    "('00', '01', '02', '03', '04', '05', '06', '07', '08', '09', '10', '11', '12')"
)

# The times of day by clock period and hour.
BIN_CTE = f"""
ticket_bin AS (
  SELECT *,
         CASE
           WHEN ViolationPeriod = 'AM' AND ViolationHour IN ('03', '04', '05', '06') THEN 'Dawn'
           WHEN ViolationPeriod = 'AM' AND ViolationHour IN ('07', '08', '09', '10') THEN 'Morning'
           WHEN ViolationPeriod = 'AM' AND ViolationHour = '11' THEN 'Afternoon'
           WHEN ViolationPeriod = 'PM' AND ViolationHour IN ('12', '01', '02') THEN 'Afternoon'
           WHEN ViolationPeriod = 'PM' AND ViolationHour IN ('03', '04', '05', '06') THEN 'Evening'
           WHEN ViolationPeriod = 'PM' AND ViolationHour IN ('07', '08', '09', '10') THEN 'Night'
           ELSE 'Midnight'
         END AS TimeOfDay
  FROM ticket_time
  WHERE {VALID_TIME}
)"""

# The seasons by month.
SEASON_CTE = """
ticket_season AS (
  SELECT *,
         CASE
           WHEN IssueMonth IN (12, 1, 2) THEN 'Winter'
           WHEN IssueMonth IN (3, 4, 5) THEN 'Spring'
           WHEN IssueMonth IN (6, 7, 8) THEN 'Summer'
           WHEN IssueMonth IS NOT NULL THEN 'Fall'
         END AS Season
  FROM ticket_bin
)"""


def _ev(body: str, *ctes: str) -> str:
    return "WITH " + ",".join((TICKETS_CTE, TIME_CTE) + ctes) + "\n" + body


def _ship(body: str, *ctes: str) -> str:
    return "WITH " + ",".join((SHIPMENTS_CTE, TIME_CTE) + ctes) + "\n" + body


def _top(key: str, n: int, where: str = "", source: str = "ticket_time", count: str = '"count"') -> str:
    cond = f"WHERE {where} " if where else ""
    return f"SELECT {key}, count(*) AS {count} FROM {source} {cond}GROUP BY {key} ORDER BY count(*) DESC, {key} LIMIT {n}"


def _ranked(group: str, item: str, source: str) -> str:
    """Per group the items whose count is among its three greatest ones."""
    return (
        f"SELECT {group}, {item}, count(*) AS TicketCount, "
        f"CAST(dense_rank() OVER (PARTITION BY {group} ORDER BY count(*) DESC) AS INTEGER) AS \"Rank\" "
        f"FROM {source} GROUP BY {group}, {item} QUALIFY \"Rank\" < 4"
    )


def _mix(items: str = "") -> str:
    cond = f"WHERE p.ViolationCode IN ({items}) " if items else ""
    return _ev(
        "SELECT p.ViolationCode, p.IssuerPrecinct, p.ticket_count, "
        f"{R('p.ticket_count / t.total * 100')} AS perc_ticket_count "
        "FROM (SELECT IssuerPrecinct, ViolationCode, count(*) AS ticket_count FROM ticket_time "
        "      WHERE IssuerPrecinct <> 0 GROUP BY IssuerPrecinct, ViolationCode) p "
        "JOIN (SELECT IssuerPrecinct, count(*) AS total FROM ticket_time WHERE IssuerPrecinct <> 0 "
        "      GROUP BY IssuerPrecinct ORDER BY count(*) DESC, IssuerPrecinct LIMIT 3) t "
        f"ON p.IssuerPrecinct = t.IssuerPrecinct {cond}"
        "ORDER BY p.ticket_count DESC, p.IssuerPrecinct, p.ViolationCode"
    )


_TICKET_TIME_COLUMNS = [
    ("IssueYear", False), ("IssueMonth", False), ("IssueDt", False), ("SummonsNumber", False),
    ("PlateID", True), ("RegistrationState", True), ("IssueDate", False), ("ViolationCode", False),
    ("VehicleBodyType", True), ("VehicleMake", True), ("ViolationPrecinct", False), ("IssuerPrecinct", False),
    ("ViolationTime", True), ("ViolationHour", True), ("ViolationMinute", True), ("ViolationPeriod", True),
]


def _null_profile() -> str:
    nulls = [f"count(*) FILTER (WHERE {c} IS NULL) AS Nulls_{c}" for c, _ in _TICKET_TIME_COLUMNS]
    tokens = "('', 'nan', 'null', 'none', 'na', 'n/a')"
    holders = [
        f"count(*) FILTER (WHERE lower(trim({c})) IN {tokens}) AS Placeholders_{c}"
        for c, text in _TICKET_TIME_COLUMNS
        if text
    ]
    return _ev("SELECT " + ", ".join(nulls + holders) + " FROM ticket_time")


_RAW_TICKET_TYPES = [
    ("SummonsNumber", "bigint"), ("PlateID", "string"), ("RegistrationState", "string"),
    ("IssueDate", "timestamp_ntz"), ("ViolationCode", "int"), ("VehicleBodyType", "string"),
    ("VehicleMake", "string"), ("ViolationPrecinct", "int"), ("IssuerPrecinct", "int"),
    ("ViolationTime", "string"),
]


# Types that inference gives the landed file: the timestamp in the session's
# default kind, ids and codes as whole numbers.
_INFERRED_TICKET_TYPES = [
    ("SummonsNumber", "int"), ("PlateID", "int"), ("RegistrationState", "int"), ("IssueDate", "timestamp"),
    ("ViolationCode", "int"), ("VehicleBodyType", "string"), ("VehicleMake", "int"), ("ViolationPrecinct", "int"),
    ("IssuerPrecinct", "int"), ("ViolationTime", "string"),
]


def _shape(types) -> str:
    values = ", ".join(f"({i + 1}, '{n}', '{t}')" for i, (n, t) in enumerate(types))
    return (
        "SELECT CAST(c.position AS INTEGER) AS position, c.column_name, c.data_type, t.n_rows, "
        f"CAST({len(_RAW_TICKET_TYPES)} AS INTEGER) AS n_columns "
        f"FROM (VALUES {values}) c(position, column_name, data_type), "
        "(SELECT count(*) AS n_rows FROM events) t"
    )


_MODE = (
    "(SELECT RegistrationState FROM ticket_time WHERE RegistrationState IS NOT NULL "
    "AND RegistrationState NOT IN ('99') GROUP BY RegistrationState "
    "ORDER BY count(*) DESC, RegistrationState LIMIT 1)"
)
_RECODED = (
    f"recoded AS (SELECT CASE WHEN RegistrationState IN ('99') THEN {_MODE} "
    "ELSE RegistrationState END AS RegistrationState FROM ticket_time)"
)

_TOP3_BIN = _top("ViolationCode", 3, source="ticket_bin", count="TicketCount")

TICKET_ORACLE = {
    "k01_ingest_renamed": "WITH " + TICKETS_CTE + "\nSELECT * FROM tickets",
    "k01b_ingest_inferred": _shape(_INFERRED_TICKET_TYPES),
    "k02_shape": _shape(_RAW_TICKET_TYPES),
    "k03_time_parts": _ev(
        "SELECT SummonsNumber, IssueYear, IssueMonth, IssueDt, ViolationHour, ViolationMinute, ViolationPeriod "
        "FROM ticket_time"
    ),
    "k04a_distinct_summons": _ev("SELECT count(DISTINCT SummonsNumber) AS CountSummons FROM ticket_time"),
    "k04b_distinct_states": _ev("SELECT count(DISTINCT RegistrationState) AS CountStates FROM ticket_time"),
    "k04c_stored_distinct_sketches": _ship(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CASE WHEN count(DISTINCT {c}) <= 4096 THEN CAST(count(DISTINCT {c}) AS VARCHAR) ELSE 'over 4096' END AS distinct_estimate, "
            "true AS within_stated_error, count(DISTINCT IssueMonth) AS n_partitions, count(*) AS n_rows FROM ticket_time"
            for c in ("RegistrationState", "ViolationCode", "VehicleMake", "SummonsNumber", "ViolationTime")
        )
    ),
    "k05_state_frequency": _ev(
        'SELECT RegistrationState, count(*) AS "count" FROM ticket_time GROUP BY RegistrationState '
        "ORDER BY count(*) DESC, RegistrationState"
    ),
    "k06_recode_to_mode": _ev(
        'SELECT RegistrationState, count(*) AS "count" FROM recoded GROUP BY RegistrationState '
        "ORDER BY count(*) DESC, RegistrationState",
        _RECODED,
    ),
    "k06b_distinct_after_recode": _ev(
        "SELECT count(DISTINCT RegistrationState) AS CountStates FROM recoded", _RECODED
    ),
    "k06c_recoded_rows": _ev(
        f"SELECT SummonsNumber, CASE WHEN RegistrationState IN ('99') THEN {_MODE} ELSE RegistrationState END "
        "AS RegistrationState FROM ticket_time"
    ),
    "k07a_top_codes": _ev(_top("ViolationCode", 5)),
    "k07b_top_body_types": _ev(_top("VehicleBodyType", 5)),
    "k07c_top_makes": _ev(_top("VehicleMake", 5)),
    "k07d_top_violation_precincts": _ev(_top("ViolationPrecinct", 5)),
    "k07e_top_owners_heavy": "WITH " + TICKETS_CTE + """
        SELECT CASE WHEN SummonsNumber % 10 < 3 THEN 'fleet ' || ViolationCode % 6 ELSE 'owner ' || SummonsNumber END AS "Owner",
               count(*) AS "count"
        FROM tickets GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "k08a_top_violation_precincts_valid": _ev(_top("ViolationPrecinct", 5, "ViolationPrecinct <> 0")),
    "k08b_top_issuer_precincts_valid": _ev(_top("IssuerPrecinct", 5, "IssuerPrecinct <> 0")),
    "k09_top_issuer_precincts": _ev(_top("IssuerPrecinct", 3, "IssuerPrecinct <> 0")),
    "k10_code_mix_in_top_precincts": _mix(),
    "k11_code_mix_filtered": _mix("6, 14"),
    "k12_null_profile": _null_profile(),
    "k13_period_frequency": _ev('SELECT ViolationPeriod, count(*) AS "count" FROM ticket_time GROUP BY ViolationPeriod'),
    "k14a_hour_frequency": _ev(
        'SELECT ViolationHour, count(*) AS "count" FROM ticket_time '
        "WHERE ViolationPeriod IN ('AM', 'PM') GROUP BY ViolationHour"
    ),
    "k14b_hour_frequency_min10": _ev(
        'SELECT ViolationHour, count(*) AS "count" FROM ticket_time '
        "WHERE ViolationPeriod IN ('AM', 'PM') GROUP BY ViolationHour HAVING count(*) >= 10"
    ),
    "k15_valid_time_filter": _ev(
        "SELECT count(*) AS raw_rows, "
        f"count(*) FILTER (WHERE coalesce({VALID_TIME}, false)) AS kept_rows, "
        f"count(*) FILTER (WHERE NOT coalesce({VALID_TIME}, false)) AS rejected_rows FROM ticket_time"
    ),
    "k16_time_of_day_bin": _ev(
        "SELECT SummonsNumber, ViolationHour, ViolationPeriod, TimeOfDay FROM ticket_bin", BIN_CTE
    ),
    "k17_top_codes_per_bin": _ev(_ranked("TimeOfDay", "ViolationCode", "ticket_bin"), BIN_CTE),
    "k17b_top_codes_per_bin_sql": _ev(_ranked("TimeOfDay", "ViolationCode", "ticket_bin"), BIN_CTE),
    "k18_top_codes": _ev(_TOP3_BIN, BIN_CTE),
    "k19_top_bins_per_top_code": _ev(
        _ranked(
            "ViolationCode",
            "TimeOfDay",
            f"(SELECT vt.* FROM ticket_bin vt JOIN ({_TOP3_BIN}) t3 ON t3.ViolationCode = vt.ViolationCode) j",
        ),
        BIN_CTE,
    ),
    "k20_month_frequency": _ship('SELECT IssueMonth, count(*) AS "count" FROM ticket_time GROUP BY IssueMonth'),
    "k21_season_bin": _ship("SELECT SummonsNumber, IssueMonth, Season FROM ticket_season", BIN_CTE, SEASON_CTE),
    "k21b_season_frequency": _ship('SELECT Season, count(*) AS "count" FROM ticket_season GROUP BY Season', BIN_CTE, SEASON_CTE),
    "k22_top_codes_per_season": _ship(_ranked("Season", "ViolationCode", "ticket_season"), BIN_CTE, SEASON_CTE),
    "k23_revenue_estimate": _ev(
        "SELECT t3.ViolationCode, t3.TicketCount, f.FineAmount, t3.TicketCount * f.FineAmount AS TotalRevenue "
        f"FROM ({_TOP3_BIN}) t3 JOIN (SELECT CAST(range AS INTEGER) AS ViolationCode, "
        "CAST(35 + range AS INTEGER) AS FineAmount FROM range(20)) f ON t3.ViolationCode = f.ViolationCode",
        BIN_CTE,
    ),
}

ORACLE = {**TRIP_ORACLE, **TICKET_ORACLE}
