"""Declared schemas of the two input roles."""

from __future__ import annotations

from pyspark.sql import types as T

# The trip file layout (17 columns, bound by position).
# Timestamps are wall-clock values with no zone.
TRIP_RAW_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.IntegerType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)

# The ticket file header (names with spaces) and the types
# the analyses use.
TICKET_RAW_SCHEMA = T.StructType(
    [
        T.StructField("Summons Number", T.LongType()),
        T.StructField("Plate ID", T.StringType()),
        T.StructField("Registration State", T.StringType()),
        T.StructField("Issue Date", T.TimestampNTZType()),
        T.StructField("Violation Code", T.IntegerType()),
        T.StructField("Vehicle Body Type", T.StringType()),
        T.StructField("Vehicle Make", T.StringType()),
        T.StructField("Violation Precinct", T.IntegerType()),
        T.StructField("Issuer Precinct", T.IntegerType()),
        T.StructField("Violation Time", T.StringType()),
    ]
)


def subset(schema: T.StructType, names: list[str]) -> T.StructType:
    """The fields of ``schema`` named in ``names``, in schema order."""
    keep = set(names)
    return T.StructType([f for f in schema.fields if f.name in keep])


def without_spaces(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name.replace(" ", ""), f.dataType, f.nullable) for f in schema.fields]
    )
