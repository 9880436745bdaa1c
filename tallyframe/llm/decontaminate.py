"""Benchmark decontamination by templates.

Texts are read as words (runs between white space, punctuation trimmed,
lower-cased). Words that a question can be re-parameterised by are replaced
with typed placeholders: numbers, units, and names (words of two or more
letters with a capital that neither start a sentence nor are all capitals). A *template window* is ``window`` consecutive
words in that form; it is found by hash, in two steps:

1. a bitmap of the benchmark's window hashes (fixed size, see MAX_BITS)
   discards, inside the scan, document windows that match nothing;
2. the windows that are left are joined with the benchmark's on their hash.

Each window is looked up three times: in its template form; as its literal
words (lower-cased), so that a copy whose capitals were changed is found too;
and in a wide form. There a capitalised word that starts a sentence or the
window is a name too, unless the benchmark has it in lower case and never as a
name, and adjacent names, or adjacent numbers, of a sentence are one
placeholder. The benchmark's words that are no names are collected and
broadcast (8 bytes each).

Slot consistency: the placeholders of a window must repeat in the same
places on both sides (equal values where the benchmark's are equal,
different ones where they differ), which is what a consistent renaming of
slots means. The pattern of repetition is part of the join key, and the
benchmark side is one row per (hash, pattern), so a passage that a third of
the documents contain meets one row and gives one row per window.

A template needs at least half of its words literal; a window with fewer is
looked up in its literal form only, so that runs of numbers do not match each
other. In the template form the first word of a window always counts as the
start of a sentence. Benchmark items of fewer than ``window`` words are one window of
their own length. Items of fewer than ``MIN_WORDS`` words have a literal form
only, and since such runs of words occur by chance they must stand by
themselves, as one or more whole sentences; items of fewer than LEAST_WORDS
words name nothing and are left out. In scripts that are written without spaces (``_UNSPACED``) each
character counts as a word.

Defined results: null texts and items count as empty and match nothing;
repeated rows are judged each; an empty benchmark leaves all documents; rows
with a null id are judged like others; other columns are carried.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tallyframe.llm.common import cut, prepare, row_key, without_keys, written

WINDOW = 12
MIN_WORDS = 5
LEAST_WORDS = 3
MIN_BITS, MAX_BITS = 1 << 20, 1 << 27
MEMO_WORDS = 600_000
BASE = np.uint64(0x9E3779B97F4A7C15)
LITERAL_FORM, WIDE_FORM = np.uint64(3), np.uint64(5)
NUMBER, UNIT, NAME = (np.uint64(x) for x in (0xA5A5_0001, 0xA5A5_0002, 0xA5A5_0003))

# Words that stand for a number, and units of measure.
NUMBER_WORDS = set(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
    "million billion dozen half twice".split()
)
UNIT_WORDS = set(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces "
    "pound pounds ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour "
    "hours day days week weeks month months year years cent cents dollar dollars euro euros percent degree "
    "degrees mph kph meter meters metre metres kilometer kilometers centimeter centimeters".split()
)
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%)?")
# Characters of scripts without spaces between words: Thai, Lao, Myanmar, Khmer, kana and ideographs.
_UNSPACED = "[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF]"
_TRIM = re.compile(r"^[\W_]+|[\W_]+$")
_END = re.compile(r"[.!?:;|。！？：；][\"')\]]*$")
# Word kinds and flags in one byte.
_LITERAL, _NUM, _UNIT, _EMPTY, _CAPITAL, _ENDS = 0, 1, 2, 3, 4, 8


def spaced(texts: pa.Array) -> pa.Array:
    """Texts with blanks around each character of an unspaced script."""
    if bool(pc.any(pc.match_substring_regex(texts, _UNSPACED)).as_py()):
        return pc.replace_substring_regex(texts, f"({_UNSPACED})", r" \1 ")
    return texts


class Words(dict):
    """raw word -> row of ``codes`` and ``kinds``; each word is read once."""

    def __init__(self):
        super().__init__()
        self.codes, self.kinds = array("Q"), array("B")

    def __missing__(self, raw: str) -> int:
        plain = raw.isalpha()
        word = raw if plain else _TRIM.sub("", raw)
        low = word.lower()
        if not word:
            kind = _EMPTY if raw else _EMPTY | _ENDS  # the nothing before a text's first word
        elif low in NUMBER_WORDS or not plain and _NUMBER.fullmatch(word):
            kind = _NUM
        elif low in UNIT_WORDS:
            kind = _UNIT
        else:
            kind = _LITERAL | (_CAPITAL if word[0].isupper() and len(word) > 1 and not word.isupper() else 0)
        self.codes.append(xxh64_intdigest(low.encode("utf-8", "surrogatepass"), 7))
        self.kinds.append(kind | (0 if plain or not _END.search(raw) else _ENDS))
        self[raw] = at = len(self.codes) - 1
        return at

    def read(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, ...]:
        """All non-empty words of the texts: text number, literal code, kind,
        whether the word is a name (capitalised inside a sentence), whether it
        is capitalised, and whether it starts a sentence."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        split = pc.utf8_split_whitespace(spaced(pc.fill_null(column, "")))
        coded = split.flatten().dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self) + len(different) > MEMO_WORDS:  # what this batch has is likely to come again
            again = [(w, self[w]) for w in different if w in self]
            codes, kinds = self.codes, self.kinds
            self.clear()
            self.codes, self.kinds = array("Q", (codes[i] for _, i in again)), array("B", (kinds[i] for _, i in again))
            self.update((w, i) for i, (w, _) in enumerate(again))
        known = np.fromiter(map(self.__getitem__, different), np.int64, len(different))
        sizes, at = np.diff(split.offsets.to_numpy()), known[coded.indices.to_numpy()]
        code = np.frombuffer(self.codes, np.uint64)[at] if len(at) else np.zeros(0, np.uint64)
        kind = np.frombuffer(self.kinds, np.uint8)[at] if len(at) else np.zeros(0, np.uint8)
        text = np.repeat(np.arange(len(texts)), sizes)
        inside = np.zeros(len(at), bool)
        inside[1:] = (kind[:-1] & _ENDS == 0) & (text[1:] == text[:-1])
        full = kind & 3 != _EMPTY
        capital = kind & _CAPITAL != 0
        return text[full], code[full], kind[full] & 3, (inside & capital)[full], capital[full], ~inside[full]


def _rolled(codes: np.ndarray, width: int, plus=np.uint64(0)) -> np.ndarray:
    """Polynomial hash of every run of ``width`` codes."""
    out = np.zeros(len(codes) - width + 1, np.uint64)
    for j in range(width):
        out = out * BASE + codes[j : j + len(out)]
    out = out + plus
    return out ^ (out >> np.uint64(29))


def template_windows(read, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, text number, template hash and literal hash of every window of
    ``width`` words; the template hash is 0 where too few words are literal."""
    text, code, kind, name = read[:4]
    n = len(code) - width + 1
    if n < 1:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    opening = np.where(kind == _NUM, NUMBER, np.where(kind == _UNIT, UNIT, code))
    typed = np.where(name, NAME, opening)
    power = np.uint64(pow(int(BASE), width - 1, 1 << 64))
    slots = np.concatenate([[0], np.cumsum((kind != _LITERAL) | name)])
    few = (slots[width:] - slots[:-width]) * 2 > width
    template = _rolled(typed, width, (opening[:n] - typed[:n]) * power)
    template[few] = 0
    starts = np.nonzero(text[width - 1 :] == text[:n])[0]
    return starts, text[starts], template[starts], (_rolled(code, width) * LITERAL_FORM)[starts]


def widened(read, common: np.ndarray):
    """The words of the wide form, as text number, code, kind and name: what
    is capitalised and not one of the ``common`` codes (sorted) is a name
    everywhere, and runs of names or of numbers are one word. Also the first
    word of each."""
    text, code, kind, name, capital, starts = read
    known = np.zeros(len(code), bool)
    maybe = np.nonzero(capital & ~name)[0]
    if len(common):
        at = np.minimum(np.searchsorted(common, code[maybe]), len(common) - 1)
        known[maybe] = common[at] == code[maybe]
    name = capital & (name | ~known)
    of = np.where(name, 9, kind)
    again = np.zeros(len(code), bool)
    again[1:] = (of[1:] == of[:-1]) & ((of[1:] == 9) | (of[1:] == _NUM)) & ~starts[1:]
    first = np.nonzero(~again)[0]
    if len(first) < len(code):
        # A run's code: the sum of its codes by their place in the run.
        place = np.arange(len(code)) - first[np.cumsum(~again) - 1]
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(place.max()), BASE)]), dtype=np.uint64)
        code = np.add.reduceat(code * power[place], first)
    return (text[first], code, kind[first], name[first]), first


def wide_windows(wide, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, text number and hash of every window of the wide form in which
    at least half of the words are literal; the hash is 0 in the others."""
    text, code, kind, name = wide
    n = len(code) - width + 1
    if n < 1:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64))
    typed = np.where(name, NAME, np.where(kind == _NUM, NUMBER, np.where(kind == _UNIT, UNIT, code)))
    slots = np.concatenate([[0], np.cumsum((kind != _LITERAL) | name)])
    hashes = _rolled(typed, width) * WIDE_FORM
    hashes[(slots[width:] - slots[:-width]) * 2 > width] = 0
    starts = np.nonzero(text[width - 1 :] == text[:n])[0]
    return starts, text[starts], hashes[starts]


def _common_words(items: DataFrame) -> np.ndarray:
    """Sorted codes of the items' words that occur in lower case and never
    capitalised inside a sentence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            _, code, _, name, capital, _ = words.read(batch["text"])
            lower, named = np.unique(code[~capital]), np.unique(code[name])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([lower, named]).view(np.int64)), pa.array(np.repeat([False, True], [len(lower), len(named)]))],
                ["code", "named"],
            )

    found = items.select("text").mapInArrow(run, "code long, named boolean").groupBy("code").agg(F.max("named").alias("named"))
    codes = found.where("not named").select("code").toPandas()["code"].to_numpy(np.int64)
    return np.sort(codes.view(np.uint64))


def slot_pattern(read, start: int, width: int, opening: bool = True) -> int:
    """Which placeholders of the window are equal, as one number. With
    ``opening`` the first word is no name."""
    _, code, kind, name = read[:4]
    part = slice(start, start + width)
    slot = (kind[part] != _LITERAL) | name[part]
    if opening:
        slot[0] = kind[start] != _LITERAL
    seen: dict[int, int] = {}
    return xxh64_intdigest(bytes(seen.setdefault(int(c), len(seen)) for c in code[part][slot]), 3) >> 1


def _alone(read, starts: np.ndarray, width: int) -> np.ndarray:
    """Whether the windows start with a sentence and end with one."""
    text, opens = read[0], read[5]
    last = np.minimum(starts + width, len(text) - 1)
    ends = (starts + width == len(text)) | (text[last] != text[starts]) | opens[last]
    return opens[starts] & ends


_WORDS = Words()


def _words() -> Words:
    """The words that this Python worker has read; they depend on nothing else."""
    return _WORDS


def _windows(texts: DataFrame, widths: list[int], wide_widths: list[int], common, possible=None) -> DataFrame:
    """id, width, hash, pattern, window (hash of the plain words), literal,
    wide per window of each form; ``common`` and ``possible`` are broadcast:
    codes of words and a bitmap of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words()
        bitmap = np.frombuffer(possible.value, np.uint64) if possible is not None else None

        def hits(hashes: np.ndarray) -> np.ndarray:
            bit = hashes % np.uint64(len(bitmap) * 64)
            return bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1) != 0

        known = np.frombuffer(common.value, np.uint64)
        for batch in batches:
            read = words.read(batch["text"])
            lengths = np.bincount(read[0], minlength=batch.num_rows)
            rows: list[tuple] = []
            for width in widths:
                starts, text, template, literal = template_windows(read, width)
                short = width < MIN_WORDS
                for hashes, plain in ((template, False), (literal, True))[short:]:
                    hit = np.ones(len(starts), bool) if plain else hashes != 0
                    if short:
                        hit &= _alone(read, starts, width)
                    if bitmap is not None:
                        hit &= hits(hashes)
                    elif width < WINDOW:  # an item's short window is all of it
                        hit &= lengths[text] == width
                    for i in np.nonzero(hit)[0].tolist():
                        pattern = 0 if plain else slot_pattern(read, starts[i], width)
                        rows.append((text[i], width, hashes[i], pattern, literal[i], plain, False))
            wide, first = widened(read, known)
            lengths = np.bincount(wide[0], minlength=batch.num_rows)
            for width in wide_widths:
                starts, text, hashes = wide_windows(wide, width)
                hit = hashes != 0
                if bitmap is not None:
                    hit &= hits(hashes)
                elif width < WINDOW:
                    hit &= lengths[text] == width
                for i in np.nonzero(hit)[0].tolist():
                    # Named by its first words as they are, like the windows of the other forms.
                    plain = (_rolled(read[1][first[starts[i]] :][:width], width) * LITERAL_FORM)[0]
                    rows.append((text[i], width, hashes[i], slot_pattern(wide, starts[i], width, False), plain, False, True))
            for at in range(0, len(rows), 50_000):
                some = rows[at : at + 50_000]
                column = lambda i, some=some: np.array([r[i] for r in some], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].take(pa.array(column(0))),
                        pa.array(column(1).astype(np.int32)),
                        *[pa.array(column(i)) for i in (2, 3, 4)],
                        pa.array([r[5] for r in some]),
                        pa.array([r[6] for r in some]),
                    ],
                    ["id", "width", "hash", "pattern", "window", "literal", "wide"],
                )

    id_type = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {id_type}, width int, hash long, pattern long, window long, literal boolean, wide boolean")


def contaminated_windows(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per window and form of a document that a benchmark item has:
    id, window (hash of the document's words), item_id (the smallest of the
    items), literal (true in the literal form: also the slot values agree)."""
    spark = docs.sparkSession
    prepare(spark)
    items = benchmark.select(F.col(item_col).alias("id"), F.col(item_text_col).alias("text"))
    short = list(range(MIN_WORDS, WINDOW))
    common = spark.sparkContext.broadcast(_common_words(items).tobytes())
    mine = cut(_windows(items, [*range(LEAST_WORDS, MIN_WORDS), *short, WINDOW], [*short, WINDOW], common))
    found = mine.select("width", "wide").distinct().collect()  # at most WINDOW numbers for each
    widths, wide_widths = (sorted(r.width for r in found if r.wide == x) for x in (False, True))
    n = mine.count()
    bits = MIN_BITS
    while bits < MAX_BITS and bits < n * 64:
        bits *= 2
    # The bitmap: at most MAX_BITS / 64 words, whatever the benchmark's size.
    unsigned = F.pmod(F.col("hash"), F.lit(bits))  # bits is a power of two
    set_words = (
        mine.select((unsigned / 64).cast("long").alias("word"), F.pmod(unsigned, F.lit(64)).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("ones"))
    )
    bitmap = np.zeros(bits // 64, np.uint64)
    for word, ones in set_words.toLocalIterator():
        bitmap[word] = np.array([ones], np.int64).view(np.uint64)[0]
    possible = spark.sparkContext.broadcast(bitmap.tobytes())

    theirs = _windows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), widths, wide_widths, common, possible)
    keys = ["width", "hash", "pattern", "literal", "wide"]
    templates = mine.groupBy(*keys).agg(F.min("id").alias("item_id"))
    return theirs.join(templates, keys).groupBy("id", "window", "literal").agg(F.min("item_id").alias("item_id")).select(
        "id", "window", "item_id", "literal"
    )


def contaminated_documents(windows: DataFrame) -> DataFrame:
    """One row per contaminated document: id, item_id (the smallest item),
    n_windows (different ones), reparameterised (no window agrees in its
    slot values)."""
    return (
        windows.groupBy("id", "window")
        .agg(F.min("item_id").alias("item_id"), F.max("literal").alias("literal"))
        .groupBy("id")
        .agg(
            F.min("item_id").alias("item_id"),
            F.count(F.lit(1)).alias("n_windows"),
            (~F.max("literal")).alias("reparameterised"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without any window of the benchmark, columns unchanged.
    A row is named by its id and text, so that rows without an id are judged
    like others and texts that share an id each by themselves."""
    keyed = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    found = contaminated_windows(keyed, benchmark, "key", "text").select("id").distinct()
    return without_keys(docs, written(found.select("id.*"), "contaminated"), id_col, text_col).select("row.*")
