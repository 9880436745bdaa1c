"""Distinct counts from stored sketches.

One theta sketch per column and partition is written beside the data. What
is asked later, of one partition, some or all, merges the sketches of those and
reads no rows. A sketch of up to 2 ** lg_k values holds them all, so its
estimate is exact; beyond that it is off by about 1 / sqrt(2 ** lg_k) of the
count (one standard deviation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K = 12


def stated_error(lg_k: int = LG_K) -> float:
    """Three standard deviations, as a share of the count."""
    return 3.0 / 2 ** (lg_k / 2)


def write_distinct_sketches(
    df: DataFrame, path: str, columns: Sequence[str], partition_by: str, lg_k: int = LG_K, mode: str = "errorifexists"
) -> None:
    """Rows (column_name, sketch, n_rows) per value of ``partition_by``,
    partitioned by it, so that a reload of some partitions replaces theirs only
    (with ``mode="overwrite"`` and dynamic partition overwrite).

    Each column is sketched as text: a sketch takes numbers, text and bytes, and
    merges only with its kind."""
    sketches = [F.theta_sketch_agg(F.col(f"`{c}`").cast("string"), lg_k).alias(f"s{i}") for i, c in enumerate(columns)]
    gathered = df.groupBy(partition_by).agg(F.count(F.lit(1)).alias("n_rows"), *sketches)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)])
    out = gathered.select(partition_by, "n_rows", F.explode(rows).alias("x")).select("x.column_name", "x.sketch", "n_rows", partition_by)
    out.write.mode(mode).partitionBy(partition_by).parquet(path)


def distinct_from_sketches(
    spark: SparkSession, path: str, where: Column | None = None, lg_k: int = LG_K
) -> DataFrame:
    """column_name, distinct_estimate, n_partitions, n_rows over the stored
    partitions that ``where`` picks (all by default)."""
    stored = spark.read.parquet(path)
    if where is not None:
        stored = stored.where(where)
    return stored.groupBy("column_name").agg(
        F.theta_sketch_estimate(F.theta_union_agg("sketch", lg_k)).alias("distinct_estimate"),
        F.count(F.lit(1)).alias("n_partitions"),
        F.sum("n_rows").alias("n_rows"),
    )
