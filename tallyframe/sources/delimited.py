"""Delimited text landing files: read with a declared or inferred schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
    check_header: bool = True,
) -> DataFrame:
    """Scan a file or a whole folder of delimited text with a fixed schema.

    The header line is skipped. Columns bind by position, so with
    ``check_header`` the header names are compared with the schema and a
    reordered file fails instead of loading shifted values. Malformed
    cells become NULL (permissive mode).
    """
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", not (header and check_header))
        .csv(path)
    )


def malformed_rows(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """One row: lines in all, and lines with a cell that does not fit its
    declared type (``read_delimited`` turns such cells into NULL)."""
    marked = T.StructType([*schema.fields, T.StructField("_malformed", T.StringType())])
    rows = (
        spark.read.schema(marked)
        .option("header", True)
        .option("sep", sep)
        .option("columnNameOfCorruptRecord", "_malformed")
        .option("enforceSchema", True)
        .csv(path)
    )
    # Every cell is looked at: a pruned scan would not parse the others.
    read = F.length(F.concat_ws("", *[F.col(f"`{f.name}`").cast("string") for f in schema.fields])) >= 0
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("_malformed").isNotNull() & read).alias("n_malformed")
    )


def read_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The rows of delimited text that fit the declared schema, and the
    lines that do not, as they stand, with a reason each.

    The rejects have ``line``, ``bad_columns`` (the columns whose cell does not
    fit its type) and ``reason``: ``cells`` where there are too few or too many of
    them, or else the bad columns joined by a blank. Nothing is
    dropped: each line is in one of the two. Both are lazy; write the rejects
    next to the table that the rows go to."""
    bad = "_malformed"
    marked = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    read = (
        spark.read.schema(marked)
        .option("header", header)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", bad)
        .option("enforceSchema", True)
        .csv(path)
    )
    cells = [F.col(f"`{f.name}`") for f in schema.fields]
    # A scan that prunes a column does not parse it: every cell is asked for.
    parsed = F.length(F.concat_ws("", *[c.cast("string") for c in cells])) >= 0
    rows = read.where(F.col(bad).isNull() & parsed).select(*cells)
    # The line again, all of it text: it is wrong by itself if it has too few
    # or too many cells; otherwise each cell is tried with its type.
    spelled = ", ".join([*[f"c{i} STRING" for i in range(len(cells))], f"{bad} STRING"])
    lines = read.where(F.col(bad).isNotNull() & parsed).select(F.col(bad).alias("line"))
    lines = lines.withColumn("text", F.from_csv("line", F.lit(spelled), {"sep": sep, "columnNameOfCorruptRecord": bad}))
    wrong = F.col(f"text.{bad}").isNotNull()
    misfits = [
        F.when(F.col(f"text.c{i}").isNotNull() & F.col(f"text.c{i}").try_cast(f.dataType).isNull(), F.lit(f.name))
        for i, f in enumerate(schema.fields)
    ]
    listed = F.when(~wrong, F.filter(F.array(*misfits), lambda c: c.isNotNull())).otherwise(F.array().cast("array<string>"))
    reason = F.when(wrong, F.lit("cells")).otherwise(F.array_join("bad_columns", " "))
    return rows, lines.withColumn("bad_columns", listed).select("line", "bad_columns", reason.alias("reason"))


def read_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Scan delimited text with header and inferred types.

    Inference costs an extra pass over the input; prefer
    ``read_delimited`` with a declared schema for large inputs.
    """
    return spark.read.option("header", True).option("sep", sep).option("inferSchema", True).csv(path)


def normalise_names(df: DataFrame) -> DataFrame:
    """Remove spaces from column names (``Summons Number`` -> ``SummonsNumber``)."""
    return df.withColumnsRenamed({c: c.replace(" ", "") for c in df.columns if " " in c})


# Timestamps are written with all six fractional digits (the writer's
# default keeps milliseconds only); the reader's default parser accepts them.
_TS_WRITE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    """Write ``df`` as headed delimited text (a landing folder)."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("timestampNTZFormat", _TS_WRITE_FORMAT)
        .option("timestampFormat", _TS_WRITE_FORMAT + "XXX")
        .csv(path)
    )
