"""Periodic runs of words, by sparse diagonal dynamic programming.

Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of
consecutive words with smallest period q (words q apart are identical) and a
length of at least max(LEAST, TIMES * q) that no neighbouring word extends
keeping period q.

The words are read in order. A word that stood ``lag`` words ago lies on the
diagonal ``lag``; the diagonal's match length grows by one with every such
word, a diagonal that gets no match at a word has ended there, and it is
emitted at once if its length suffices. The table stays sparse because most
earlier occurrences of a word cannot lie on a diagonal that will suffice:

* such a diagonal has at least max(LEAST - q, (TIMES - 1) * q) matches in a row.
  Occurrences are therefore those of the word together with the words before it:
  for lags up to SEED, SEED words; for lags in (g / 2, g], g words, g = 8, 16, ...
* of these only the latest counts. Within a run of smallest period q, g >= q
  words that stood fewer than q words ago would make one period of the run a
  rotation of itself, and its period smaller; so the latest one is at lag q,
  from word q + g - 1 of the run on, and at the word after the run it is not.
  Conversely, a diagonal of such lags that is long enough has no smaller
  period, since that would have been met as a later occurrence.

So each word has at most one lag per doubling of g, and the work is bounded by
words * log(words) however repetitive a text is; ordinary words have none at all.
The contexts of g words are named by pairs of names of g / 2 words, exactly
and without hashing, and only where the shorter ones occur twice in the text.

Texts travel in batches of bounded size; a document is worked on whole, in one
task. Nothing is shuffled.

Defined results: a null text has no words; repeated rows are judged each; a
null id is passed on; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import prepare

SEED = 5
LEAST, TIMES = 6, 4


class Numbers(dict):
    """word -> number, in the order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the keys (equal keys, equal names), and their order by key,
    then place."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    names = np.empty(len(keys), np.int64)
    names[order] = np.cumsum(new) - 1
    return names, order


class Contexts:
    """The places of a batch where a context of ``width`` words ends that
    occurs at least twice in its document: their numbers (ascending), the
    name of the context, and the lag to its latest earlier occurrence (0:
    none)."""

    def __init__(self, places: np.ndarray, keys: np.ndarray, document: np.ndarray, width: int):
        names, order = _named(keys)
        sorted_places, sorted_names = places[order], names[order]
        again = (sorted_names[1:] == sorted_names[:-1]) & (document[sorted_places[1:]] == document[sorted_places[:-1]])
        lags = np.zeros(len(places), np.int64)
        lags[order[1:][again]] = (sorted_places[1:] - sorted_places[:-1])[again]
        twice = np.zeros(len(places), bool)
        twice[order[1:][again]] = True
        twice[order[:-1][again]] = True
        self.places, self.names, self.lags, self.width = places[twice], names[twice], lags[twice], width

    def wider(self, width: int, document: np.ndarray) -> Contexts:
        """Contexts of up to twice as many words, from two that overlap."""
        if not len(self.places):
            return self
        earlier = self.places - (width - self.width)
        back = np.searchsorted(self.places, earlier)  # never past the end: earlier is smaller
        here = np.nonzero((self.places[back] == earlier) & (document[earlier] == document[self.places]))[0]
        count = int(self.names.max()) + 1
        return Contexts(self.places[here], self.names[back[here]] * count + self.names[here], document, width)


def _first(words: np.ndarray, document: np.ndarray) -> Contexts:
    """Contexts of SEED words. Each word more leaves fewer places."""
    contexts = Contexts(np.arange(len(words)), words, document, 1)
    for width in (2, 4, SEED):
        contexts = contexts.wider(width, document)
    return contexts


def lagged(words: np.ndarray, document: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per context width: the width, the places with an earlier occurrence
    at a lag of this width's class, and these lags."""
    contexts, least = _first(words, document), 0
    while len(contexts.places):
        width = contexts.width
        fits = (contexts.lags > least) & (contexts.lags <= width)
        yield width, contexts.places[fits], contexts.lags[fits]
        least, width = width, 8 if width == SEED else 2 * width
        contexts = contexts.wider(width, document)


def diagonals(width: int, places: np.ndarray, lags: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Start, length and period of the runs among (place, lag) in reading
    order. A place has one lag, so one diagonal of this width is active."""
    if not len(places):
        return
    # Where a diagonal ends: the next word does not stand at the same lag.
    cuts = np.nonzero((np.diff(places) != 1) | (np.diff(lags) != 0))[0] + 1
    for a, b in pairwise([0, *cuts.tolist(), len(places)]):
        lag = int(lags[a])
        matches = b - a + width - 1  # the context's own words matched before
        if matches + lag >= max(LEAST, TIMES * lag):
            yield int(places[a]) - width + 1 - lag, matches + lag, lag


def find_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Per text (a list of words): its runs (start, length, period), by
    start, then period."""
    numbers = Numbers()
    sizes = np.array([len(x) for x in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    words = np.fromiter((i for x in texts for i in map(numbers.__getitem__, x)), np.int64, int(starts[-1]))
    document = np.repeat(np.arange(len(texts)), sizes)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for width, places, lags in lagged(words, document):
        # A diagonal never goes from one document into the next: the first
        # words of a document have no earlier occurrence in it.
        for start, length, period in diagonals(width, places, lags):
            at = int(document[start])
            found[at].append((start - int(starts[at]), length, period))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    inside = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        inside[start + period] += 1
        inside[start + length] -= 1
    return [words[i] for i in np.nonzero(np.cumsum(inside)[:-1] == 0)[0].tolist()]


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, runs (start, length, period; by
    start, then period) and collapsed (the kept words joined by one blank)."""
    prepare(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Without an argument, bytes are split at exactly these six characters.
            texts = [x.split() if x else [] for x in batch["text"].cast(pa.binary()).to_pylist()]
            found = find_runs(texts)
            kept = [b" ".join(collapsed(words, runs)) for words, runs in zip(texts, found, strict=True)]
            ends = np.cumsum([0] + [len(x) for x in found]).astype(np.int32)
            flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array([len(x) for x in texts], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(RUN))),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["id", "n_words", "runs", "collapsed"],
            )

    id_type = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(
        run, f"id {id_type}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    )
