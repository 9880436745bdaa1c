"""Removal of repeated passages by deep-shallow suffix sorting.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else is removed (documents as UTF-8 bytes, matches within one document).

A suffix array of the whole corpus is not needed for that; it is enough to
sort, per place that can repeat, the suffixes that start there:

1. Anchors. Of each window of ``length`` bytes the smallest KGRAM-byte hash
   (the leftmost of equal ones) is its anchor. Equal windows have the same
   anchor at the same offset, so a window that repeats has an anchor whose
   hash repeats. About one byte in seventy is an anchor. An anchor's context
   is the union of its own windows.
2. Candidates. Anchor hashes are counted with partial aggregation. A bitmap
   of fixed size keeps, in a second scan, those that may repeat. These are
   counted per hash and context hash, again with partial aggregation: equal
   contexts repeat as a whole, which is all there is to say of them, however
   many they are. Hashes that have different contexts go on with one row per
   different context.
3. Sorting. The contexts of one hash are sorted as suffixes starting at the
   anchor: multikey quicksort on words of eight bytes to a shallow depth,
   then a blind trie orders each group that still agrees. Common prefixes of
   neighbours give the groups that agree to some depth; in each, the contexts
   are in the order of their reversed left sides (sorted the same way), whose
   neighbours have the longest common left sides. Left plus right of at least
   ``length`` bytes is a repeated passage.

No group meets whole: anchors with equal contexts, which a passage in a third
of all documents has, are only counted and joined with their count (plain
exchanges, which adaptive execution splits). The different contexts of one
hash are sorted in one task up to GROUP of them (some 6 MB). The windows of
larger groups are counted one by one by their 128-bit hash instead, which is
exact and linear in the number of contexts.

Defined results: a null text counts as empty; texts of fewer than ``length``
bytes keep all bytes; repeated rows repeat each other's passages; rows that
share an id are told apart by their text (rows are joined by a 64-bit hash of
both), and a null id is a value like any other; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import cut, prepare, written

LENGTH = 200
KGRAM = 32
CHUNK = 1 << 20
SHALLOW = 48  # bytes sorted by multikey quicksort before blind tries
GROUP = 20_000
MIN_BITS, MAX_BITS = 1 << 20, 1 << 27
_LOW = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _kgrams(data: np.ndarray) -> np.ndarray:
    """Hash of every run of KGRAM bytes, by doubling the run length."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x94D049BB133111EB)
    n, power = 1, _BASE
    while n < KGRAM:
        h = h[:-n] * np.uint64(power) + h[n:]
        n, power = 2 * n, power * power % (1 << 64)
    return _mixed(h)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    rest = width - n
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64, grown as needed."""
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = 1 << max(12, (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = _POWERS[name] = np.multiply.accumulate(have)
    return have[:n]


def _chunk_anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Hash, context hash, position, left and right size of the anchors of
    all windows of a run of bytes."""
    h = _kgrams(data)
    least = _sliding_min((h & ~_LOW) | np.arange(len(h), dtype=np.uint64), length - KGRAM + 1)
    first = np.nonzero(np.concatenate([[True], least[1:] != least[:-1]]))[0]
    last = np.append(first[1:], len(least)) - 1
    at = (least[first] & _LOW).astype(np.int64)
    left, right = at - first, last + length - at
    values = (data.astype(np.uint64) + np.uint64(7)) * np.uint64(0xD6E8FEB86659FD93)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers("up", _BASE, len(data)), dtype=np.uint64)])
    context = (sums[at + right] - sums[first]) * _powers("down", _INVERSE, len(data))[first]
    return h[at], _mixed(context + (left * 256 + right).astype(np.uint64) * np.uint64(_BASE)), at, left, right


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, context hash and place (position, left and right size in one
    number) of the anchors of a document, a bounded chunk at a time."""
    out = []
    for base in range(0, len(data) - length + 1, CHUNK):
        h, context, at, left, right = _chunk_anchors(data[base : base + CHUNK + length - 1], length)
        out.append((h, context, ((at + base) << 16) | (left << 8) | right))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class BlindTrie:
    """Orders strings that agree on a long prefix: inner nodes know only the
    depth at which they branch, so an insertion compares one string."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | None = None  # leaf: [-1, indexes]; inner: [depth, {byte: node}]

    def _branch(self, i: int, depth: int) -> int:
        s = self.strings[i]
        return s[depth] if depth < len(s) else -1

    def insert(self, i: int) -> None:
        if self.root is None:
            self.root = [-1, [i]]
            return
        node = self.root
        while node[0] >= 0:  # blind: bytes between branches are not looked at
            node = node[1].get(self._branch(i, node[0])) or next(iter(node[1].values()))
        other = node[1][0]
        depth = common_prefix(self.strings[i], self.strings[other])
        if depth == len(self.strings[i]) == len(self.strings[other]):
            node[1].append(i)
            return
        above, node = None, self.root
        while 0 <= node[0] < depth:
            above, node = node, node[1][self._branch(i, node[0])]
        if node[0] == depth:
            node[1][self._branch(i, depth)] = [-1, [i]]
            return
        inner = [depth, {self._branch(other, depth): node, self._branch(i, depth): [-1, [i]]}]
        if above is None:
            self.root = inner
        else:
            above[1][self._branch(i, above[0])] = inner

    def order(self) -> list[int]:
        out, todo = [], [self.root] if self.root else []
        while todo:
            node = todo.pop()
            if node[0] < 0:
                out += node[1]
            else:
                todo += [node[1][k] for k in sorted(node[1], reverse=True)]
        return out


def deep_shallow_sort(strings: list[bytes]) -> list[int]:
    """Indexes in the order of the strings: multikey quicksort on words of
    eight bytes down to SHALLOW, blind tries for what still agrees."""
    out: list[int] = []
    todo = [(list(range(len(strings))), 0)]
    while todo:
        some, depth = todo.pop()
        if len(some) < 2 or depth < 0:
            out += some
        elif depth >= SHALLOW:
            trie = BlindTrie(strings)
            for i in some:
                trie.insert(i)
            out += trie.order()
        else:
            words = [strings[i][depth : depth + 8] for i in some]
            pivot = words[len(words) // 2]
            parts: tuple[list[int], ...] = ([], [], [])
            for i, word in zip(some, words, strict=True):
                parts[(word >= pivot) + (word > pivot)].append(i)
            # A short word ends its string: those with it are equal.
            below = depth + 8 if len(pivot) == 8 else -1
            todo += [(parts[2], depth), (parts[1], below), (parts[0], depth)]
    return out


def prefix_groups(prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of every maximal run of sorted strings that share
    ``depth`` bytes; ``prefixes[i]`` is the common prefix of i and i + 1."""
    stack: list[tuple[int, int]] = []  # depth, first
    for i, depth in enumerate([*prefixes, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            yield d, first, i
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def repeated_in_group(lefts: list[bytes], rights: list[bytes], length: int) -> Iterator[tuple[int, int, int]]:
    """(index, bytes before, bytes after the anchor) of the passages of at
    least ``length`` bytes that a context shares with another one. ``lefts``
    are reversed, so that common left sides are common prefixes."""
    order = deep_shallow_sort(rights)
    rank = [0] * len(lefts)
    for r, i in enumerate(deep_shallow_sort(lefts)):
        rank[i] = r
    prefixes = [common_prefix(rights[a], rights[b]) for a, b in zip(order, order[1:], strict=False)]
    for depth, first, last in prefix_groups(prefixes):
        some = sorted(order[first : last + 1], key=rank.__getitem__)
        before = [common_prefix(lefts[a], lefts[b]) for a, b in zip(some, some[1:], strict=False)]
        for i, one, two in zip(some, [0, *before], [*before, 0], strict=True):
            if max(one, two) + depth >= length:
                yield i, max(one, two), depth


def _bitmap(hashes: DataFrame, rows: int) -> bytes:
    """Bitmap of a ``h`` column: at most MAX_BITS bits, however many rows."""
    bits = MIN_BITS
    while bits < MAX_BITS and bits < rows * 16:
        bits *= 2
    at = F.pmod(F.col("h"), F.lit(bits))
    words = (
        hashes.select(F.shiftright(at, 6).alias("word"), F.pmod(at, F.lit(64)).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("ones"))
    )
    out = np.zeros(bits // 64, np.int64)
    for word, ones in words.toLocalIterator():
        out[word] = ones
    return out.tobytes()


def _hit(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = h % np.uint64(len(bitmap) * 64)
    return bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1) != 0


def _batch(columns: dict[str, object]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], list(columns))


def _all_anchors(texts: DataFrame, length: int, bitmap=None) -> DataFrame:
    """h, c (context hash), key and place of the anchors; with a bitmap of
    hashes that repeat only those that may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = np.frombuffer(bitmap.value, np.uint64) if bitmap is not None else None
        for batch in batches:
            found = [anchors(np.frombuffer(t.encode(), np.uint8), length) for t in batch["text"].to_pylist()]
            keys = np.repeat(batch["key"].to_numpy(zero_copy_only=False), [len(x[0]) for x in found])
            h, c, place = (np.concatenate(x) for x in zip(*found, strict=True))
            if repeated is not None:
                keep = _hit(repeated, h)
                h, c, place, keys = h[keep], c[keep], place[keep], keys[keep]
            yield _batch({"h": h.view(np.int64), "c": c.view(np.int64), "key": keys, "place": place})

    return texts.mapInArrow(run, "h long, c long, key long, place long")


def _groups_of(column: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``column``."""
    held: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        if not held.num_rows:
            continue
        values = held[column].to_numpy()
        last = int(np.nonzero(values != values[-1])[0][-1]) + 1 if (values != values[-1]).any() else 0
        if last:
            yield held.slice(0, last)
            held = held.slice(last)
    if held is not None and held.num_rows:
        yield held


# What the candidate step says of an anchor: its whole context repeats; its
# context is to be compared (alone, or for a number of equal ones); the same
# in a group too large for one sort.
WHOLE, ALONE, SEVERAL, ALONE_WIDE, SEVERAL_WIDE = range(5)


def _judge(candidates: DataFrame) -> DataFrame:
    """kind, h, key, place: every anchor whose context repeats, and one
    anchor per different context of the hashes that have several. Sides of
    joins are written first, so that each is a plain exchange."""
    contexts = written(
        candidates.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "place")).alias("one")),
        "contexts",
    )
    several = contexts.where("n > 1").select("h", "c")
    whole = candidates.join(several, ["h", "c"]).select(F.lit(WHOLE).alias("kind"), "h", "key", "place")
    mixed = written(contexts.groupBy("h").agg(F.count(F.lit(1)).alias("contexts")).where("contexts > 1"), "mixed")
    kind = F.when(F.col("n") > 1, SEVERAL).otherwise(ALONE) + F.when(F.col("contexts") > GROUP, 2).otherwise(0)
    ask = contexts.join(mixed, "h").select(kind.alias("kind"), "h", "one.key", "one.place")
    return whole.unionByName(ask)


def _start() -> F.Column:
    return (F.shiftright("place", 16) - F.shiftright("place", 8).bitwiseAND(F.lit(255))).cast("long")


def _end() -> F.Column:
    return (F.shiftright("place", 16) + F.col("place").bitwiseAND(F.lit(255))).cast("long")


def _contexts(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """kind, h, key, place and the bytes of the contexts asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {x: [] for x in ("kind", "h", "key", "place", "context")}
            for key, text, wanted in zip(batch["key"].to_pylist(), batch["text"].to_pylist(), batch["asked"].to_pylist(), strict=True):
                data = text.encode() if wanted else b""
                for w in wanted or []:
                    at, left, right = w["place"] >> 16, w["place"] >> 8 & 255, w["place"] & 255
                    for name, value in zip(out, (w["kind"], w["h"], key, w["place"], data[at - left : at + right]), strict=True):
                        out[name].append(value)
            if out["kind"]:
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))

    # One row per document that has candidates: their number is bounded by
    # its length.
    by_document = asked.groupBy("key").agg(F.collect_list(F.struct("kind", "h", "place")).alias("asked"))
    return texts.join(by_document, "key", "left").mapInArrow(run, "kind int, h long, key long, place long, context binary")


def _sorted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """key, s, e of the passages that contexts of one hash share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups_of("h", batches):
            h, kind, key, place = (table[x].to_numpy() for x in ("h", "kind", "key", "place"))
            strings = table["context"].to_pylist()
            edges = np.concatenate([[0], np.nonzero(h[1:] != h[:-1])[0] + 1, [len(h)]]).tolist()
            spans: list[tuple[int, int, int]] = []
            for first, last in zip(edges, edges[1:], strict=False):
                if last - first < 2:
                    continue
                sizes = [p >> 8 & 255 for p in place[first:last].tolist()]
                lefts = [s[:n][::-1] for s, n in zip(strings[first:last], sizes, strict=True)]
                rights = [s[n:] for s, n in zip(strings[first:last], sizes, strict=True)]
                for i, before, after in repeated_in_group(lefts, rights, length):
                    if kind[first + i] == ALONE:
                        at = int(place[first + i]) >> 16
                        spans.append((int(key[first + i]), at - before, at + after))
            if spans:
                yield _batch({x: np.array(v, np.int64) for x, v in zip(("key", "s", "e"), zip(*spans, strict=True), strict=True)})

    return (
        contexts.where(F.col("kind") <= SEVERAL)
        .repartition("h")
        .sortWithinPartitions("h")
        .mapInArrow(run, "key long, s long, e long")
    )


def _window_spans(contexts: DataFrame, length: int) -> DataFrame:
    """The same for groups too large for one sort: every window of their
    contexts, counted by its 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            rows = zip(batch["kind"].to_pylist(), batch["key"].to_pylist(), batch["place"].to_pylist(), batch["context"].to_pylist(), strict=True)
            for kind, key, place, data in rows:
                n = len(data) - length + 1
                first = (place >> 16) - (place >> 8 & 255)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([xxh3_128_digest(data[i : i + length]) for i in range(n)], pa.binary()),
                        pa.array(np.full(n, key, np.int64)),
                        pa.array(np.arange(first, first + n, dtype=np.int64)),
                        pa.array(np.full(n, 2 if kind == SEVERAL_WIDE else 1, np.int64)),
                    ],
                    ["window", "key", "s", "weight"],
                )

    wide = contexts.where(F.col("kind") > SEVERAL)
    windows = wide.mapInArrow(run, "window binary, key long, s long, weight long")
    repeated = windows.groupBy("window").agg(F.sum("weight").alias("n")).where("n > 1").select("window")
    return (
        windows.where("weight = 1").join(repeated, "window").select("key", "s", (F.col("s") + length).alias("e"))
    )


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """id, text, spans per document: the spans (s, e) in bytes, not merged,
    whose union is what repeats. ``length`` is from KGRAM to 223 bytes."""
    if not KGRAM <= length <= 223:
        raise ValueError(f"length must be from {KGRAM} to 223")
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.xxhash64(F.col(id_col), text).alias("key"), F.col(id_col).alias("id"), text.alias("text"))
    slim = texts.select("key", "text")

    counts = cut(_all_anchors(slim, length).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    bitmap = spark.sparkContext.broadcast(_bitmap(counts, counts.count()))  # MAX_BITS at most
    judged = written(_judge(_all_anchors(slim, length, bitmap)), "repeated-anchors")
    contexts = _contexts(texts, judged.where(F.col("kind") != WHOLE))
    spans = judged.where(F.col("kind") == WHOLE).select("key", _start().alias("s"), _end().alias("e"))
    spans = spans.unionByName(_sorted_spans(contexts, length))
    if not judged.where(F.col("kind") > SEVERAL).isEmpty():
        spans = spans.unionByName(_window_spans(contexts, length))
    # As many spans as a document has anchors at most, times their depths.
    by_document = spans.groupBy("key").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    return texts.join(by_document, "key", "left").select("id", "text", "spans")


def merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """id, n_bytes, removed (the maximal removed runs as (s, e) in bytes) and
    kept (the remaining bytes) per document."""
    found = repeated_spans(docs, id_col, text_col, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist(), strict=True):
                data = text.encode()
                runs = merged((x["s"], x["e"]) for x in spans or [])
                edges = [0, *[x for run in runs for x in run], len(data)]
                sizes.append(len(data))
                removed.append([{"s": s, "e": e} for s, e in runs])
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())],
                ["id", "n_bytes", "removed", "kept"],
            )

    id_type = found.schema["id"].dataType.simpleString()
    return found.mapInArrow(run, f"id {id_type}, n_bytes long, removed array<struct<s:bigint,e:bigint>>, kept binary")
