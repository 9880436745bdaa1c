"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.session import shared_dir

# Rows and bytes that reach a Python worker at once. Whole documents travel
# in these batches, so the default of 10,000 rows could be gigabytes.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session and make sure that a
    checkpoint folder is set (the session's own wins, see ``shared_dir``)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{folder}/checkpoints")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder: what comes after
    rereads files when an executor is lost and never reruns the lineage."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and reread it. Unlike a
    checkpoint its size is known to the planner, which can then broadcast it
    where it is small instead of shuffling what it is joined with."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; ``sf_dir`` may be any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


ROW_KEY = ("no_id", "id", "h1", "h2")


def row_key(id_col: str, text_col: str) -> F.Column:
    """What names a row: its id and a 128-bit hash of its text, so that rows
    without an id and different texts under one id are told apart. Keys are
    ordered by id, those without one last."""
    text = F.col(text_col)
    return F.struct(
        F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.xxhash64(text).alias("h1"),
        F.xxhash64(text, F.lit(1)).alias("h2"),
    )


def without_keys(docs: DataFrame, dropped: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``key`` of the rows whose key is not
    among the rows of ``dropped`` (the fields of the key)."""
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key(id_col, text_col).alias("key"))
    match = [F.col(f"key.{k}").eqNullSafe(dropped[k]) for k in ROW_KEY]
    return keyed.join(dropped, match, "left_anti")


def unsigned_hex(col) -> F.Column:
    """A 64-bit value as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))
