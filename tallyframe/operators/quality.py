"""Validity rules: counting violations and keeping the rows that pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.aggregate import frequency


def all_of(rules: Sequence[Column]) -> Column:
    """Conjunction of rules (a NULL rule result counts as not passing)."""
    return reduce(lambda a, b: a & b, rules)


def any_of(rules: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, rules)


def violations_by(
    df: DataFrame,
    rule: Column,
    *keys: str,
    where: Column | None = None,
    count_col: str = "count",
) -> DataFrame:
    """Rows matching ``rule`` per key; ``where`` is an extra row filter.

    A condition on a group key is a row filter too: it is applied before
    grouping (the planner pushes it below the partial aggregate).
    """
    cond = rule if where is None else rule & where
    return frequency(df, *keys, where=cond, count_col=count_col)


def any_negative_by(df: DataFrame, columns: Sequence[str], *keys: str, count_col: str = "count") -> DataFrame:
    """Rows with at least one of ``columns`` below zero, per key. A column
    that ``df`` does not have is an error, never a narrower rule."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"columns of the rule are missing: {missing}")
    rule = any_of([F.col(c) < F.lit(0.0) for c in columns])
    return violations_by(df, rule, *keys, count_col=count_col)


def out_of_domain(
    df: DataFrame, column: str, allowed: Sequence[object], *keys: str, count_col: str = "count"
) -> DataFrame:
    """Rows whose ``column`` is not in ``allowed`` (NULL values drop out)."""
    return violations_by(df, ~F.col(column).isin(*allowed), *keys, count_col=count_col)


def apply_rules(df: DataFrame, rules: Sequence[Column]) -> DataFrame:
    """Keep the rows passing every rule."""
    return df.filter(all_of(rules))


def reconcile(df: DataFrame, rules: Sequence[Column]) -> DataFrame:
    """One row: raw, kept and rejected counts in a single pass."""
    keep = F.coalesce(all_of(rules), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(keep).alias("kept_rows"),
        F.count_if(~keep).alias("rejected_rows"),
    )


def reconcile_load(raw: DataFrame, loaded: DataFrame, rules: Sequence[Column]) -> DataFrame:
    """One row: rows read, rows found in the loaded table, rows the rules
    reject, and ``lost_rows``, which is 0 only if the load kept exactly the
    rest. The counts come from two tables, so a lost row shows."""
    reject = F.coalesce(~all_of(rules), F.lit(True))
    kept = loaded.agg(F.count(F.lit(1))).scalar()
    counted = raw.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(reject).alias("rejected_rows"))
    return counted.select("raw_rows", kept.alias("loaded_rows"), "rejected_rows").withColumn(
        "lost_rows", F.col("raw_rows") - F.col("loaded_rows") - F.col("rejected_rows")
    )


def content_checksums(df: DataFrame, *keys: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and an order-free checksum of their contents per key.

    The checksum is the sum of a 64-bit hash of each row, so it depends
    neither on the order nor on the partitioning, and repeated rows count as
    often as they occur. Which cells are NULL is part of the hash, which
    by itself leaves NULLs out."""
    names = [c for c in (columns or df.columns) if c not in keys]
    cells = [F.col(f"`{c}`") for c in names]
    row = F.xxhash64(*cells, *[c.isNull() for c in cells]) if cells else F.lit(0).cast("long")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(row.cast("decimal(20,0)")).alias("checksum")
    )


def reconcile_contents(expected: DataFrame, loaded: DataFrame, *keys: str) -> DataFrame:
    """Per key: rows expected, rows loaded, and whether their contents are
    the same. A changed cell shows like a lost row does; a key that only one
    side has counts no rows on the other."""
    columns = [c for c in expected.columns if c not in keys]
    sides = [content_checksums(df.select(*keys, *columns), *keys, columns=columns) for df in (expected, loaded)]
    left, right = (
        side.select(*[F.col(k).alias(f"{k}_{i}") for k in keys], F.col("n_rows").alias(f"n_{i}"), F.col("checksum").alias(f"c_{i}"))
        for i, side in enumerate(sides)
    )
    match = all_of([F.col(f"{k}_0").eqNullSafe(F.col(f"{k}_1")) for k in keys])
    n_0, n_1 = (F.coalesce(F.col(f"n_{i}"), F.lit(0)).cast("long") for i in (0, 1))
    return left.join(right, match, "full").select(
        *[F.when(F.col("n_0").isNotNull(), F.col(f"{k}_0")).otherwise(F.col(f"{k}_1")).alias(k) for k in keys],
        n_0.alias("expected_rows"),
        n_1.alias("loaded_rows"),
        ((n_0 == n_1) & F.col("c_0").eqNullSafe(F.col("c_1"))).alias("same_contents"),
    )
