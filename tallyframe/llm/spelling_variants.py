"""Spelling variants: words one edit apart, by pivotal grams.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point. Each word chooses two disjoint bigrams, its pivots; they cut it
into three zones: up to the end of the first one, between them, and from
the start of the second one on. One edit touches one zone only, so at least
one pivot is found in the other word with all of the word that is not in the
touched zone: the second one with everything right of the first zone (A), the
first one with everything left of the third (B), or both (C). These three
anchored grams are what a word looks up.

A gram's rarity is estimated from counts of bigrams: of those at the start
or end of a word, carried on by the share of each further bigram among those
with the same letter. Pivots are chosen by dynamic programming so that the most
common of the three anchored grams is as rare as possible; that value is the
word's limit. A word's gram prefix is every anchored gram of it that is no
more common than its own limit. Of two near words, the one with the smaller
limit finds all its three grams in the other's prefix if they are there at
all, so pivots are looked up in prefixes only, and in one direction. Position
limits are part of the gram, which holds the word up to its end or start, and
lengths may differ by one. What is found is verified by edit distance.

Words longer than LONG code points take pivots at thirds, whatever is in them,
so that their prefix is nine grams and not a number that grows with the square
of the length; a word of LONG + 1 holds both kinds.

Everything is rows: grams are joined by a 64-bit hash of their text (equal
hashes are no more than candidates). No list of words that share a gram is
ever gathered. Broadcast are the counts of bigrams, of characters modulo
CLASSES: at most CLASSES ** 2 numbers, whatever the alphabet.

Defined results: words of fewer than MIN_LENGTH code points have no two
disjoint bigrams and no near words; a null word is left out; of repeated
words the counts are added; ties of the largest count go to the word smallest
in code-point order; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tallyframe.llm.common import cut, prepare, written

MIN_LENGTH = 4
LONG = 24
CLASSES = 256
NO_LIMIT = 1 << 62
UNIT = 1e6  # logarithms are whole numbers of millionths, so that sums are exact


def _gram(kind: str, *parts: str) -> int:
    """A gram's 64-bit name, signed."""
    name = xxh64_intdigest("\x1f".join((kind, *parts)).encode("utf-8", "surrogatepass"), 5)
    return name - (1 << 64) if name >> 63 else name


class Rarity:
    """Weights of bigrams as logarithms: at the start and end of a word, and
    carrying a gram on to the right (``after``) or to the left (``before``)."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray):
        """``pairs`` names bigrams, ``counts`` has for each the occurrences
        anywhere, at the start and at the end of words."""
        table = np.zeros((3, CLASSES * CLASSES))
        table[:, pairs] = counts.T
        every = table[0].reshape(CLASSES, CLASSES)

        def log(x: np.ndarray) -> np.ndarray:
            return np.log(np.maximum(x, 1)).reshape(-1)

        whole = lambda x: np.round(x * UNIT).astype(np.int64).tolist()
        self.start, self.end = whole(log(table[1])), whole(log(table[2]))
        self.after = whole(log(every) - np.repeat(log(every.sum(1)), CLASSES))
        self.before = whole(log(every) - np.tile(log(every.sum(0)), CLASSES))
        self.words = whole(log(table[1].sum(keepdims=True)))[0]

    def estimates(self, word: str) -> tuple[list[int], list[int]]:
        """For each m, how common a start of m code points is, and for each k,
        an end from k on (two code points at least)."""
        length, code = len(word), [ord(c) % CLASSES for c in word]
        pair = [a * CLASSES + b for a, b in zip(code, code[1:], strict=False)]
        left, right = [self.words] * (length + 1), [self.words] * (length + 1)
        left[2], right[length - 2] = self.start[pair[0]], self.end[pair[-1]]
        for m in range(3, length + 1):
            left[m] = left[m - 1] + self.after[pair[m - 2]]
        for k in range(length - 3, -1, -1):
            right[k] = right[k + 1] + self.before[pair[k]]
        return left, right

    def pivots(self, word: str) -> tuple[int, int, int]:
        """The word's limit, the end of its first pivot and the start of its
        second one: for each start of a second pivot the best first one is
        carried on from the one before, as far as it stays the best."""
        left, right = self.estimates(word)
        best = (NO_LIMIT, 0, 0)
        for b in range(2, len(word) - 1):
            for a in range(2, b + 1):
                middle = left[a] + right[b] - self.words if a < b else -NO_LIMIT
                best = min(best, (max(right[a], left[b], middle), a, b))
        return best

    def grams(self, word: str) -> tuple[int, set[int], set[int]]:
        """The word's limit, the grams that it looks up and its prefix."""
        length = len(word)
        if length > LONG:
            prefix = set()
            for other in (length - 1, length, length + 1):
                if other > LONG:
                    prefix |= _thirds(word, other)
            if length == LONG + 1:
                prefix |= self.prefix(word, NO_LIMIT)
            return NO_LIMIT, _thirds(word, length), prefix
        limit, a, b = self.pivots(word)
        asked = {_gram("A", word[a:]), _gram("B", word[:b])}
        if a < b:
            asked.add(_gram("C", word[:a], word[b:]))
        return limit, asked, self.prefix(word, limit)

    def prefix(self, word: str, limit: int) -> set[int]:
        left, right = self.estimates(word)
        length = len(word)
        found = {_gram("A", word[k:]) for k in range(1, length - 1) if right[k] <= limit}
        found |= {_gram("B", word[:m]) for m in range(2, length) if left[m] <= limit}
        for x in range(2, length - 1):
            most = limit - left[x] + self.words
            found |= {_gram("C", word[:x], word[y:]) for y in range(x, length - 1) if right[y] <= most}
        return found


def _thirds(word: str, other: int) -> set[int]:
    """The grams of ``word`` that a long word of ``other`` code points looks up."""
    a, b, shift = other // 3, 2 * other // 3, len(word) - other
    return {_gram("A", word[a + shift :]), _gram("B", word[:b]), _gram("C", word[:a], word[b + shift :])}


def bigram_counts(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bigrams of the words, named by their characters modulo CLASSES, and
    how often each occurs anywhere, at the start and at the end. At most
    CLASSES ** 2 rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((3, CLASSES * CLASSES), np.int64)
        for batch in batches:
            for word in batch["word"].to_pylist():
                code = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) % CLASSES
                pair = code[:-1] * CLASSES + code[1:]
                np.add.at(table[0], pair, 1)
                table[1, pair[0]] += 1
                table[2, pair[-1]] += 1
        seen = np.nonzero(table[0])[0]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (seen, *table[:, seen])], ["pair", "n", "at_start", "at_end"])

    schema = "pair long, n long, at_start long, at_end long"
    sums = words.mapInArrow(run, schema).groupBy("pair").agg(*[F.sum(c).alias(c) for c in ("n", "at_start", "at_end")])
    rows = np.array([tuple(r) for r in sums.collect()], np.int64).reshape(-1, 4)
    return rows[:, 0], rows[:, 1:]


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, near, near_n: every pair of near words once, of the different
    words (word, n)."""
    spark = words.sparkSession
    prepare(spark)
    words = words.where(F.length("word") >= MIN_LENGTH).select("word", "n")
    rarity = spark.sparkContext.broadcast(bigram_counts(words))  # CLASSES ** 2 rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Rarity(*rarity.value)
        for batch in batches:
            found = [table.grams(w) for w in batch["word"].to_pylist()]
            lists = [pa.array([sorted(f[i]) for f in found], pa.list_(pa.int64())) for i in (1, 2)]
            limits = pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["word"], batch["n"], limits, *lists], ["word", "n", "bound", "asked", "prefix"])

    grams = written(words.mapInArrow(run, "word string, n long, bound long, asked array<bigint>, prefix array<bigint>"), "grams")
    pivots = grams.select(F.explode("asked").alias("gram"), *[F.col(c).alias(f"{c}_a") for c in ("word", "n", "bound")])
    prefixes = grams.select(F.explode("prefix").alias("gram"), *[F.col(c).alias(f"{c}_b") for c in ("word", "n", "bound")])
    first = F.struct("bound_a", "word_a") < F.struct("bound_b", "word_b")
    lengths = F.abs(F.length("word_a") - F.length("word_b")) <= 1
    verified = F.levenshtein("word_a", "word_b", 1) == 1
    met = prefixes.join(pivots, (prefixes["gram"] == pivots["gram"]) & first & lengths & verified)
    # A pair may meet in several grams.
    return met.select(F.col("word_a").alias("word"), F.col("n_a").alias("n"), F.col("word_b").alias("near"), F.col("n_b").alias("near_n")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where following ``form`` from word to word ends. Counts
    grow along the way, so there are no circles, and each round doubles the
    steps that are done."""
    links = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        links = step.select("word", "root")
        if step.where("moved").isEmpty():
            return links


def spelling_forms(words: DataFrame, ratio: int = 2) -> DataFrame:
    """One row per different word of (word, n): word, form, root, n, n_near,
    form_n. The form is the near word with the largest n, if that is at least
    ``ratio`` times the word's."""
    words = written(words.where("word is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "words")
    pairs = written(near_pairs(words), "near-words")
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    found = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = words.join(found, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "best")
    chosen = -F.col("best.less") >= ratio * F.col("n")
    labelled = cut(
        joined.select("word", "n", "n_near", F.when(chosen, F.col("best.near")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n"))
    )
    ends = roots(labelled.where("form is not null"))
    return labelled.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
