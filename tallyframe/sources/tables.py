"""Columnar tables: parquet inputs and the partitioned, bucketed ORC sink."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyframe.session import shared_dir


def read_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One input table. Column pruning and filters reach the scan."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A small table given in code (e.g. a fine schedule)."""
    return spark.createDataFrame(rows, schema)


def table_location(spark: SparkSession, name: str, unique: bool = True) -> tuple[str, str]:
    """A table name and a folder for it under the shared folder."""
    base = re.sub(r"[^A-Za-z0-9_]", "_", name)
    if unique:
        base = f"{base}_{uuid.uuid4().hex[:12]}"
    return base, f"{shared_dir(spark)}/tables/{base}"


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_table_if_absent(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    location: str,
    partition_by: str,
    bucket_by: str,
    buckets: int,
    fmt: str = "orc",
    compression: str = "snappy",
) -> None:
    """``CREATE TABLE IF NOT EXISTS`` a partitioned, bucketed table at ``location``."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{table}` ({_ddl(schema)}) USING {fmt} "
        f"OPTIONS (compression '{compression}') "
        f"PARTITIONED BY (`{partition_by}`) "
        f"CLUSTERED BY (`{bucket_by}`) INTO {buckets} BUCKETS "
        f"LOCATION '{location}'"
    )


def drop_table(spark: SparkSession, table: str) -> None:
    """Take a table out of the catalog; an external table's files stay."""
    spark.sql(f"DROP TABLE IF EXISTS `{table}`")


def check_table(spark: SparkSession, table: str, schema: T.StructType, location: str) -> None:
    """Raise if the table exists with other columns or at another place."""
    have = [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    if have != want:
        raise ValueError(f"table {table} has columns {have}, not {want}")
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED `{table}`").where("col_name = 'Location'").collect()
    plain = lambda path: path.removeprefix("file:").rstrip("/").replace("//", "/")
    if rows and plain(rows[0].data_type) != plain(location):
        raise ValueError(f"table {table} is at {rows[0].data_type}, not {location}")


def overwrite_partitions(df: DataFrame, table: str, partition_by: str, bucket_by: str) -> None:
    """``INSERT OVERWRITE ... PARTITION (p)`` with dynamic partitions.

    Only the partitions present in ``df`` are replaced. The rows are
    rebalanced on (partition, bucket key) first: AQE splits oversized
    groups and merges small ones, so each written file has a sensible
    size however skewed the partition values are.
    """
    spark = df.sparkSession
    columns = spark.table(table).columns
    out = df.select(*columns).hint("rebalance", partition_by, bucket_by)
    # insertInto follows the session's overwrite mode, not a writer option:
    # switch it to dynamic for this write only.
    key = "spark.sql.sources.partitionOverwriteMode"
    previous = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        out.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(key, previous)


def load_table(
    df: DataFrame,
    table: str,
    location: str,
    partition_by: str,
    bucket_by: str,
    buckets: int,
    fmt: str = "orc",
    compression: str = "snappy",
    analyze: bool = False,
) -> DataFrame:
    """Create the table if needed, overwrite the partitions in ``df`` and
    return the table as read back. ``analyze=True`` also stores column
    statistics in the catalog (one more pass) for the cost-based optimiser."""
    spark = df.sparkSession
    data_fields = [f for f in df.schema.fields if f.name != partition_by]
    part_field = [f for f in df.schema.fields if f.name == partition_by]
    schema = T.StructType(data_fields + part_field)
    create_table_if_absent(spark, table, schema, location, partition_by, bucket_by, buckets, fmt, compression)
    check_table(spark, table, schema, location)
    overwrite_partitions(df, table, partition_by, bucket_by)
    if analyze:
        gather_statistics(spark, table)
    return spark.table(table)


STATISTICS = ("min", "max", "num_nulls", "distinct_count", "avg_col_len", "max_col_len")
# The share by which the catalog's distinct counts may be off (Spark's default for them).
NDV_ERROR = 0.05


def gather_statistics(spark: SparkSession, table: str, histogram_bins: int | None = None) -> None:
    """``ANALYZE TABLE ... COMPUTE STATISTICS FOR ALL COLUMNS``: row count,
    size and per-column min, max, NULL count, estimated distinct count and
    lengths are stored in the catalog, where the cost-based optimiser reads
    them. With ``histogram_bins`` also an equi-height histogram of every
    column whose type has one, which takes a second pass."""
    bins = {
        "spark.sql.statistics.histogram.enabled": str(histogram_bins is not None).lower(),
        "spark.sql.statistics.histogram.numBins": str(histogram_bins or 254),
        # Bounds of bins are percentiles: off by a tenth of a bin at most.
        "spark.sql.statistics.percentile.accuracy": str(10 * (histogram_bins or 254)),
    }
    before = {k: spark.conf.get(k) for k in bins}
    try:
        for k, v in bins.items():
            spark.conf.set(k, v)
        spark.sql(f"ANALYZE TABLE `{table}` COMPUTE STATISTICS FOR ALL COLUMNS")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _described(spark: SparkSession, table: str, column: str) -> dict[str, str]:
    """What the catalog says of a column: metadata, a few rows."""
    rows = spark.sql(f"DESCRIBE EXTENDED `{table}` `{column}`").collect()
    return {r.info_name: r.info_value for r in rows if r.info_value != "NULL"}


def column_statistics(spark: SparkSession, table: str, columns: list[str] | None = None) -> DataFrame:
    """The stored column statistics, one row per column (as
    ``DESCRIBE EXTENDED t col`` reports them): ``column_name, min, max,
    num_nulls, distinct_count, avg_col_len, max_col_len`` as text.

    Catalog metadata only (a few rows per column); run
    ``gather_statistics`` first.
    """
    names = columns or spark.table(table).columns
    rows = [(name, *[_described(spark, table, name).get(k) for k in STATISTICS]) for name in names]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in ("column_name", *STATISTICS)))


_HEIGHT = re.compile(r"height: ([^,]+), num_of_bins: (\d+)")
_BIN = re.compile(r"lower_bound: ([^,]+), upper_bound: ([^,]+), distinct_count: (\d+)")


def column_histograms(spark: SparkSession, table: str, columns: list[str] | None = None) -> DataFrame:
    """The stored histograms, one row per bin: ``column_name, bin, lower,
    upper, distinct_count, height`` (rows per bin; bounds as the catalog's
    numbers, dates and times in days and microseconds). Columns without one
    have no row."""
    rows = []
    for name in columns or spark.table(table).columns:
        found = _described(spark, table, name)
        if (height := _HEIGHT.match(found.get("histogram", ""))) is None:
            continue
        for i in range(int(height.group(2))):
            low, high, different = _BIN.match(found[f"bin_{i}"]).groups()
            rows.append((name, i, float(low), float(high), int(different), float(height.group(1))))
    schema = "column_name string, bin int, lower double, upper double, distinct_count long, height double"
    return spark.createDataFrame(rows, schema)


def save_table(df: DataFrame, table: str, location: str, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` as an external table of the catalog, neither partitioned
    nor bucketed, and return it as read back."""
    df.write.format(fmt).option("path", location).saveAsTable(table)
    return df.sparkSession.table(table)
