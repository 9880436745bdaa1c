"""Word-piece token counts by a linear longest-match automaton.

Greedy longest-match splitting of a word takes the longest vocabulary piece
that starts it, then goes on with the rest. Done naively that rereads
characters. The automaton here is the trie of the vocabulary with a failure
link per node: when no edge fits the next character, the pieces that greedy
matching would have cut off by then are *popped* and the link leads to the
node of what remains. As only lengths are wanted, a node stores how many
pieces its link pops, never the pieces. Each character is read once.

Words are the matches of the splitter pattern in the NFC-normalised,
lower-cased text, as UTF-8 bytes; the last byte of a word is a symbol of its
own kind, because pieces that end a word differ from those that do not. The
vocabulary has every byte in both kinds, so each word can be split.

Defined results: a null or empty text has no words and no pieces; repeated
rows are counted each; other columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import prepare
from tallyframe.llm.token_files import SPLIT

MEMO_WORDS = 400_000
END = "</w>"


def piece_symbols(piece: str, to_byte: dict[str, int]) -> tuple[int, ...]:
    """A piece of a byte-level vocabulary as symbols: a byte, or 256 more
    for the byte that ends a word."""
    last = piece.endswith(END)
    symbols = [to_byte[c] for c in (piece[: -len(END)] if last else piece)]
    if last:
        symbols[-1] += 256
    return tuple(symbols)


def byte_alphabet() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte:
    printable Latin-1 characters for themselves, the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}


def read_pieces(path: str) -> list[tuple[int, ...]]:
    """The pieces of a vocabulary file as symbols (special tokens left out)."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    special = {x["content"] for x in parts["added_tokens"]}
    alphabet = byte_alphabet()
    return [piece_symbols(p, alphabet) for p in parts["model"]["vocab"] if p not in special]


class Automaton:
    """Trie with failure links and popped-piece counts."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        self.edges: dict[int, int] = {}  # node * 512 + symbol -> node
        children: list[list[tuple[int, int]]] = [[]]
        whole = [False]
        for piece in pieces:
            node = 0
            for symbol in piece:
                key = node << 9 | symbol
                if key not in self.edges:
                    self.edges[key] = len(children)
                    children[node].append((symbol, len(children)))
                    children.append([])
                    whole.append(False)
                node = self.edges[key]
            whole[node] = bool(piece)
        self.link = [-1] * len(children)  # -1: what the node holds cannot be split
        self.popped = [0] * len(children)
        queue = deque((0, symbol, node) for symbol, node in children[0])
        while queue:
            parent, symbol, node = queue.popleft()
            if whole[node]:
                self.link[node], self.popped[node] = 0, 1
            else:
                state, popped = self.link[parent], self.popped[parent]
                while state >= 0 and (state << 9 | symbol) not in self.edges:
                    popped += self.popped[state]
                    state = self.link[state]
                if state >= 0:
                    self.link[node], self.popped[node] = self.edges[state << 9 | symbol], popped
            queue.extend((node, s, child) for s, child in children[node])

    def count(self, word: bytes) -> int:
        """Pieces of a word; -1 if greedy matching cannot split it."""
        symbols = list(word)
        if not symbols:
            return 0
        symbols[-1] += 256
        edges, link, popped = self.edges, self.link, self.popped
        node = total = 0
        for symbol in symbols:
            while (after := edges.get(node << 9 | symbol)) is None:
                if link[node] < 0:
                    return -1
                total += popped[node]
                node = link[node]
            node = after
        while node:
            if link[node] < 0:
                return -1
            total += popped[node]
            node = link[node]
        return total


class Counter:
    """Counts of whole texts; remembers words between blanks."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        import regex

        self.automaton = Automaton(pieces)
        self.split = regex.compile(SPLIT).findall
        self.memo: dict[str, int] = {}

    def _word(self, raw: str) -> int:
        """Words and pieces of the text between two blanks, in one number."""
        words = self.split(unicodedata.normalize("NFC", raw).lower())
        pieces = [self.automaton.count(w.encode()) for w in words]
        if min(pieces, default=0) < 0:
            raise ValueError("the vocabulary lacks a single byte")
        return len(words) << 40 | sum(pieces)

    def count(self, text: str | None) -> tuple[int, int]:
        """Words and pieces of a text. Neither a word nor a composed letter
        reaches across a blank, so what lies between blanks adds up."""
        raw = (text or "").replace("\n", " ").split(" ")
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        for w in set(raw).difference(memo):
            memo[w] = self._word(w)
        total = sum(map(memo.__getitem__, raw))
        return total >> 40, total & (1 << 40) - 1


_COUNTERS: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_pieces, n_bytes per row."""
    prepare(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(read_pieces(vocabulary_path))  # one vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _COUNTERS.get(vocabulary_path) or _COUNTERS.setdefault(vocabulary_path, Counter(shipped.value))
        for batch in batches:
            counts = np.array([counter.count(t) for t in batch["text"].to_pylist()], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(counts[:, 0]), pa.array(counts[:, 1]), batch["n_bytes"]],
                ["id", "n_words", "n_pieces", "n_bytes"],
            )

    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    id_type = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {id_type}, n_words long, n_pieces long, n_bytes long")
