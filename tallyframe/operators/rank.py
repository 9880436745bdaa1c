"""Ranking within groups and item mixes of the top groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.numeric import pct


def top_k_per_group(
    df: DataFrame,
    group: str,
    item: str,
    k: int,
    count_col: str = "TicketCount",
    rank_col: str = "Rank",
) -> DataFrame:
    """The ``k`` most frequent items of each group, ties kept.

    Items are counted first (partial aggregation), then ranked with
    ``dense_rank`` per group, so a group with tied counts returns more
    than ``k`` rows. The ``rank <= k`` filter lets Catalyst insert a
    WindowGroupLimit before the shuffle by group: each task forwards its own
    top-``k`` ranks per group only. Items tied within those ranks are all
    forwarded, as they are part of the answer.
    """
    counts = df.groupBy(group, item).agg(F.count(F.lit(1)).alias(count_col))
    return rank_counted(counts, group, count_col, k, rank_col)


def rank_counted(
    counts: DataFrame, group: str, count_col: str, k: int, rank_col: str = "Rank"
) -> DataFrame:
    """Dense rank of already-counted rows within ``group``; keep ranks <= k."""
    w = Window.partitionBy(group).orderBy(F.col(count_col).desc())
    ranked = counts.withColumn(rank_col, F.dense_rank().over(w))
    return ranked.filter(F.col(rank_col) <= F.lit(k))


def mix_within_top(
    df: DataFrame,
    group: str,
    item: str,
    k: int,
    exclude: Sequence[object] | None = None,
    items: Sequence[object] | None = None,
    count_col: str = "ticket_count",
    pct_col: str = "perc_ticket_count",
    digits: int = 2,
) -> DataFrame:
    """Per item, its count and share within each of the ``k`` largest groups.

    One aggregation to (group, item) counts feeds both the group totals
    (summed from the pair counts; AQE reuses that exchange) and the result;
    the planner sees that the top ``k`` groups are at most ``k`` rows.
    ``items`` restricts the output rows only: shares stay relative to the
    whole group. As in an equality join, a NULL group never matches.
    """
    if exclude:
        df = df.filter(~F.col(group).isin(*exclude))
    pairs = df.groupBy(group, item).agg(F.count(F.lit(1)).alias(count_col))
    totals = pairs.groupBy(group).agg(F.sum(count_col).alias("_group_total"))
    top = totals.orderBy(F.col("_group_total").desc(), F.col(group).asc()).limit(k)
    mixed = pairs.join(top, group)
    if items is not None:
        # Reads the count too, so it stays above the join and both branches
        # keep sharing the (group, item) aggregation.
        mixed = mixed.filter(F.when(F.col(count_col) > 0, F.col(item).isin(*items)))
    return mixed.select(
        F.col(item),
        F.col(group),
        F.col(count_col),
        pct(count_col, "_group_total", digits).alias(pct_col),
    ).orderBy(F.col(count_col).desc(), F.col(group).asc(), F.col(item).asc())
