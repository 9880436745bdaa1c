"""SimHash near-duplicate detection with a byte-position inverted index.

Fingerprint: words are the runs of characters other than ASCII white space
in the text with A-Z lower-cased; every shingle of ``words`` consecutive
words (the whole sequence if there are fewer) is hashed by XXH64 with seed
42, and a bit of the 64-bit fingerprint is set if more than half of the
hashes, repeats included, have it. A text without words has fingerprint 0.

Index: two fingerprints that differ in at most ``bits`` bits differ in at
most ``bits`` of their eight bytes, so they share at least ``8 - bits``
positional bytes: that is the guaranteed minimum of the count filter.
Posting lists of single (position, byte) keys would hold 1/256 of the corpus
each and their pairs would have to be tallied one by one; the index instead
keys its postings on every set of ``8 - bits`` positions with their bytes,
so that two fingerprints meet in a posting exactly if their tally of shared
positional bytes reaches the minimum. A posting leaves ``bits`` bytes free
and therefore holds at most 256 ** bits distinct fingerprints (65,536 at 2
bits), whatever the size of the corpus. Fingerprints that meet are verified
by the number of differing bits, and only a forest that connects those that
pass leaves the posting: never all pairs of a group.

Equal fingerprints are collapsed before the index, with partial
aggregation, so a group of copies of any size is one fingerprint.

Defined results: a null text counts as empty; all texts without words share
fingerprint 0; repeated rows are labelled each; a null id has a label like
any row but never names a component unless no other id is in it; an empty
table gives an empty result; other columns are ignored by ``near_duplicates``
and carried by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import ROW_KEY, cut, prepare, row_key, without_keys, written
from tallyframe.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
# Shingle hashes whose bits are summed at once (64 bytes each).
CHUNK = 1 << 16
# Postings up to this size compare all fingerprints in one small matrix.
DENSE = 64


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of one text, unsigned."""
    from xxhash import xxh64_intdigest

    # bytes.lower and bytes.split treat ASCII letters and ASCII white space only.
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    k = min(words, len(found))
    hashes = [xxh64_intdigest(joined[s:e], 42) for s, e in zip(starts, ends[k - 1 :].tolist(), strict=False)]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        part = np.array(hashes[i : i + CHUNK], dtype=">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """id, fp (the fingerprint's bits as a signed long) per row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in batch["text"].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(fps.view(np.int64))], ["id", "fp"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"id {slim.schema['id'].dataType.simpleString()}, fp long")


def position_masks(bits: int) -> list[int]:
    """One mask per set of 8 - ``bits`` byte positions."""
    full = (1 << 64) - 1
    return [
        full & ~sum(0xFF << (8 * p) for p in free) for free in combinations(range(8), bits)
    ]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.astype(np.uint64, copy=False))


def _neighbour_masks(mask: int, bits: int) -> np.ndarray:
    """Every change of 1 to ``bits`` bits outside ``mask``."""
    free = [1 << i for i in range(64) if not mask >> i & 1]
    return np.array([sum(c) for n in range(1, bits + 1) for c in combinations(free, n)], dtype=np.uint64)


def link_posting(fps: np.ndarray, mask: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct fingerprints of one posting -> a star per group of
    fingerprints connected by differences of at most ``bits`` bits."""
    n = len(fps)
    if n <= DENSE:
        near = _popcount(fps[:, None] ^ fps[None, :]) <= bits
        left, right = np.nonzero(np.triu(near, 1))
    else:
        lefts, rights = [], []
        for change in _neighbour_masks(mask, bits):
            other = fps ^ change
            at = np.searchsorted(fps, other)
            hit = np.nonzero((at < n) & (fps[np.minimum(at, n - 1)] == other))[0]
            hit = hit[at[hit] > hit]
            lefts.append(hit)
            rights.append(at[hit])
        left, right = np.concatenate(lefts), np.concatenate(rights)
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        after = label.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        after = after[after]
        if np.array_equal(after, label):
            break
        label = after
    moved = np.nonzero(label != np.arange(n))[0]
    return fps[moved], fps[label[moved]]


def links(classes: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Edges a, b that connect the distinct fingerprints (column ``fp``)
    differing in at most ``bits`` bits, directly or through others."""
    prepare(classes.sparkSession)
    masks = position_masks(bits)
    keys = F.array(*[F.struct(F.lit(i).cast("int").alias("positions"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bytes")) for i, m in enumerate(masks)])
    postings = (
        classes.select("fp", F.explode(keys).alias("key"))
        .select("key.positions", "key.bytes", "fp")
        .repartition("positions", "bytes")
        .sortWithinPartitions("positions", "bytes", "fp")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64)]

        def whole(positions, bytes_, fps) -> Iterator[pa.RecordBatch]:
            """Links of postings that are complete."""
            if not len(fps):
                return
            first = np.concatenate([[True], (positions[1:] != positions[:-1]) | (bytes_[1:] != bytes_[:-1])])
            starts = np.nonzero(first)[0]
            sizes = np.diff(np.append(starts, len(fps)))
            two = starts[sizes == 2]
            two = two[_popcount(fps[two] ^ fps[two + 1]) <= bits]
            left, right = [fps[two + 1]], [fps[two]]
            for at, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                x, y = link_posting(np.sort(fps[at : at + size]), masks[positions[at]], bits)
                left.append(x)
                right.append(y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)], ["a", "b"]
            )

        for batch in batches:
            now = [batch[c].to_numpy(zero_copy_only=False) for c in ("positions", "bytes", "fp")]
            now[2] = now[2].view(np.uint64)
            held = [np.concatenate(x) for x in zip(held, now, strict=True)]
            if not len(held[2]):
                continue
            last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
            cut_at = len(last) - int(last.sum())
            yield from whole(*[x[:cut_at] for x in held])
            held = [x[cut_at:] for x in held]
        yield from whole(*held)

    return postings.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, bits: int = MAX_BITS
) -> DataFrame:
    """One row per input row: id, fp, component (the smallest id reachable
    over links of at most ``bits`` differing bits, itself included)."""
    fps = cut(fingerprints(docs, id_col, text_col, words))
    classes = cut(fps.groupBy("fp").agg(F.min("id").alias("least")))
    stars = connected_components(links(classes, bits))
    placed = classes.join(stars.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    placed = cut(placed)
    named = placed.groupBy("root").agg(F.min("least").alias("component"))
    # Written out, so that both sides of the last join are plain exchanges
    # and a fingerprint that many rows share can be split.
    by_fp = cut(placed.join(named, "root").select("fp", "component"))
    return fps.join(by_fp, "fp").select("id", "fp", "component")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, bits: int = MAX_BITS
) -> DataFrame:
    """The rows that stay: of each component the one with the smallest id, all
    columns unchanged. Rows without an id come last, different texts under one
    id are different rows, ordered by a hash; of rows equal in id and text the
    one smallest in all columns, in their order, stays (they must be orderable)."""
    keyed = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    labels = cut(near_duplicates(keyed, "key", "text", words, bits))
    dropped = written(labels.where("id != component").select("id.*").distinct(), "near-copies")
    kept = without_keys(docs, dropped, id_col, text_col)
    shared = cut(labels.where("id = component").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id.*"))
    if shared.isEmpty():
        return kept.select("row.*")
    match = [F.col(f"key.{k}").eqNullSafe(shared[k]) for k in ROW_KEY]
    one = kept.join(shared, match, "left_semi").groupBy("key").agg(F.min("row").alias("row"))
    return kept.join(shared, match, "left_anti").select("row").unionByName(one.select("row")).select("row.*")
