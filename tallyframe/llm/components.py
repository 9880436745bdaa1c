"""Connected components of a graph given as rows, never collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import cut


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: root is the smallest node reachable, for every node that
    has an edge to another node.

    Alternates large-star and small-star steps: each node points its larger
    neighbours, then its smaller ones, at the smallest node it sees. Both
    are a grouped minimum (partially aggregated, so a node with very many
    neighbours is no hot spot) and a join that adaptive execution can split.
    The edge list never grows and ends as one star per component after about
    log(longest path) rounds; each round is written to the checkpoint
    folder."""
    hi, lo = F.greatest(a, b), F.least(a, b)
    links = cut(edges.where(F.col(a) != F.col(b)).select(hi.alias("hi"), lo.alias("lo")).distinct())
    state = _fingerprint(links)
    while True:
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        # Minima are written before they are joined: then both sides of the
        # join are plain exchanges, and a node with very many neighbours can
        # be split.
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        )
        large = cut(large)
        best = cut(large.groupBy("hi").agg(F.min("lo").alias("m")))
        small = (
            large.join(best, "hi")
            .where("lo != m")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionByName(best.select("hi", F.col("m").alias("lo")))
            .distinct()
        )
        links = cut(small)
        before, state = state, _fingerprint(links)
        if state == before:
            break
    stars = links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def _fingerprint(links: DataFrame) -> tuple:
    """Count and an order-free checksum of the edge set."""
    digest = F.xxhash64("hi", "lo")
    return tuple(
        links.agg(
            F.count(F.lit(1)),
            F.bit_xor(digest),
            F.sum(F.pmod(digest, F.lit(1 << 20))),
        ).first()
    )
