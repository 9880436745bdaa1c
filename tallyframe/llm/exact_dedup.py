"""Exact de-duplication by two-pass Bloom filtering.

Texts are equal when they are identical after lower-casing A-Z only. Every
text is reduced to the SHA-256 of its normal form during one scan; what
follows works on that hash.

Pass 1 builds a Bloom filter of the hashes that were *seen twice*: each hash
sets two bits of one 64-bit block, bits are counted with map-side partial
aggregation, and a bit stays only if it was set at least twice. Pass 2
tests every row against the filter. A row with a clear bit cannot have a
copy and passes straight through; only the possibly repeated rows are
shuffled, grouped by their full hash and resolved exactly.

The filter has ``bits_per_row`` bits per row up to ``MAX_BLOCKS`` blocks, so
its broadcast never exceeds MAX_BLOCKS rows of 16 bytes. Beyond that size
the filter only gets denser: more rows take the (exact) shuffled path, and
those rows carry an id and a 32-byte hash, never the text.

Defined results: a null text counts as empty; equal rows that tie on the
largest id keep exactly one of them; a null id sorts below every other id;
an empty table gives an empty result; further columns of the input are
carried by ``drop_copies`` and ignored by ``duplicate_labels``.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import cut

MAX_BLOCKS = 1 << 21


def ascii_lower(col) -> F.Column:
    """Lower-case A-Z and nothing else. Pure ASCII texts (as many bytes as
    characters) take the built-in, which is faster and then equivalent."""
    text = F.coalesce(col, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def text_hash(col) -> F.Column:
    """SHA-256 of the normalised text, as 32 bytes."""
    return F.unhex(F.sha2(ascii_lower(col), 256))


def _block(sha, blocks: int) -> F.Column:
    return F.pmod(F.xxhash64(sha), F.lit(blocks))


def _bits(sha) -> F.Column:
    """Two different bit numbers within a block."""
    h = F.xxhash64(sha, F.lit(1))
    first = F.pmod(h, F.lit(64))
    return F.array(first, F.pmod(first + 1 + F.pmod(F.shiftright(h, 8), F.lit(63)), F.lit(64)))


def _mask(sha) -> F.Column:
    bits = _bits(sha)
    one = F.lit(1).cast("long")
    return F.call_function("shiftleft", one, bits[0].cast("int")).bitwiseOR(
        F.call_function("shiftleft", one, bits[1].cast("int"))
    )


def seen_twice(hashes: DataFrame, rows: int, bits_per_row: int = 32) -> tuple[DataFrame, int]:
    """Pass 1 over a ``sha`` column: (block, word) rows of the Bloom filter
    of hashes seen at least twice, and the number of blocks."""
    blocks = 1
    while blocks < MAX_BLOCKS and blocks * 64 < rows * bits_per_row:
        blocks *= 2
    words = (
        hashes.select(_block(F.col("sha"), blocks).alias("block"), F.explode(_bits(F.col("sha"))).alias("bit"))
        .groupBy("block", "bit")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .groupBy("block")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").cast("int"))).alias("word"))
    )
    return words, blocks


def mark_possible(rows: DataFrame, words: DataFrame, blocks: int) -> DataFrame:
    """Pass 2: add ``possible``, false only where the hash has no copy. The
    broadcast side has at most MAX_BLOCKS rows of two longs."""
    mask = _mask(F.col("sha"))
    return (
        rows.withColumn("block", _block(F.col("sha"), blocks))
        .join(F.broadcast(words), "block", "left")
        .withColumn("possible", F.coalesce(F.col("word").bitwiseAND(mask) == mask, F.lit(False)))
        .drop("block", "word")
    )


def _groups(possible: DataFrame) -> DataFrame:
    """Exact groups of two or more rows: sha, keep_id, group_size. Written
    out, so that the join with it reads plain exchanges on both sides and a
    hot hash can be split by the adaptive skew join."""
    return cut(
        possible.groupBy("sha")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )


def duplicate_labels(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, sha, keep_id, group_size, kept."""
    hashed = cut(docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("sha")))
    words, blocks = seen_twice(hashed, hashed.count())
    marked = mark_possible(hashed, cut(words), blocks)
    alone = marked.where("not possible").select(
        "id", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    possible = marked.where("possible")
    # Repeated rows (same id, same text) are counted before they meet their
    # group and expanded after it: any number of them is one row here.
    copies = possible.groupBy("sha", "id").agg(F.count(F.lit(1)).alias("n"))
    resolved = (
        copies.join(_groups(possible), "sha", "left")
        .withColumn("keep_id", F.coalesce("keep_id", "id"))
        .withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("long")))
        .select("id", "sha", "keep_id", "group_size", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
        .select(
            "id", "sha", "keep_id", "group_size", (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept")
        )
    )
    return alone.unionByName(resolved)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged. Rows without a
    possible copy are passed on from the scan; the others are reduced to one
    row per text."""
    columns = docs.columns
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.col(id_col).alias("id"),
        text_hash(F.col(text_col)).alias("sha"),
    )
    hashed = cut(packed.select("id", "sha"))
    words, blocks = seen_twice(hashed, hashed.count())
    words = cut(words)
    marked = mark_possible(packed, words, blocks)
    groups = _groups(mark_possible(hashed, words, blocks).where("possible"))
    repeated = (
        marked.where("possible")
        .join(groups, "sha", "left")
        .where("group_size is null or id <=> keep_id")
    )
    # Copies that tie on the largest id as well: the one that is smallest in
    # all columns, in their order, stays (they must be orderable).
    tied = cut(hashed.groupBy("sha", "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    if not tied.isEmpty():
        last = repeated.where("group_size is not null").groupBy("sha", "id").agg(F.min("row").alias("row"))
        repeated = repeated.where("group_size is null").select("row").unionByName(last.select("row"))
    return marked.where("not possible").select("row").unionByName(repeated.select("row")).select("row.*")
