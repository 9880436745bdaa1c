"""Token ids as Parquet files that can be read selectively.

Every text is encoded with a vocabulary of the tokenizers library, an end id
is appended, and the documents are written in ascending id order as Parquet
list columns: token ids dictionary-encoded (a page of bit-packed indexes),
document ids and positions delta-encoded, row groups and pages of a set
size, page indexes as the writer makes them. A reader can then fetch only
the metadata columns, or only the pages of a range of documents.

Layout: the documents are range-partitioned by id and sorted, so each file
holds a run of the order. ``part`` numbers the runs, ``local_start`` is
the position of a document's first id within its run and ``size`` its number
of ids; the start in the whole corpus is that plus the sizes of the runs before, one number per file.

Encoding goes word by word where that is sure to equal the library's
result, because the normaliser turns white space into a blank and the splitter
never joins across one. A batch is cut at ASCII white space by Arrow and each
different word of it is looked up once (up to MEMO_WORDS are remembered); the
ids of all its words are then gathered with offsets. A new word of Latin
letters is taken apart by the splitter's own pattern, and each different piece
goes to the library once (up to MEMO_PIECES); other words go to it whole.

Defined results: a null text counts as empty and becomes the end id alone; a
null id sorts first; rows that share an id are ordered by their text;
strings of special tokens are encoded as ordinary text; other columns are
left out.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import prepare

MEMO_WORDS = 600_000
MEMO_PIECES = 800_000
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
# The splitter pattern that the fast path reproduces (a fixed value of the vocabulary file).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The normaliser and word ends under which encoding piece by piece is exact.
NORMALISERS = ["NFC", "Replace", "Lowercase"]
END_OF_WORD = "</w>"


def latin_splitter():
    """SPLIT for text below U+0250: no alternative starts like another one,
    so they may be tried in another order, and the classes are spelled out."""
    kind = {c: unicodedata.category(c)[0] for c in map(chr, range(0x250))}
    letters = re.escape("".join(c for c in kind if kind[c] == "L"))
    numbers = re.escape("".join(c for c in kind if kind[c] == "N"))
    # White space as the vocabulary's pattern has it: without the separators U+001C to U+001F.
    blank = "\\t-\\r \x85\xa0"
    return re.compile(f"[{letters}]+|[{numbers}]|'(?:s|t|re|ve|m|ll|d)|[^{blank}{letters}{numbers}]+").findall


def is_latin(text: str) -> bool:
    """All characters below U+0250: there, composition and lower case do not
    depend on neighbours, in this library or in Python."""
    return text.isascii() or max(text) < "\u0250"


def byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary: the
    byte's own Latin-1 character where that is printed, else one from U+0100 on."""
    own = {b for b in range(256) if chr(b).isprintable() and chr(b) != " "}
    others = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in own else chr(next(others)) for b in range(256))


class PieceEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, vocabulary: str):
        import os

        # One Spark task is one core: the library must not start threads of its own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.library.encode_special_tokens = True
        parts = json.loads(vocabulary)
        self.by_piece = (
            [x["type"] for x in (parts["normalizer"] or {}).get("normalizers", [])] == NORMALISERS
            and parts["pre_tokenizer"]["pretokenizers"][0].get("pattern") == {"Regex": SPLIT}
            and [x["type"] for x in parts["pre_tokenizer"]["pretokenizers"][1:]] == ["ByteLevel"]
            and parts["model"].get("end_of_word_suffix") == END_OF_WORD
        )
        self.split = latin_splitter()
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.letters = byte_letters()

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_pieces(self, new: set[str]) -> None:
        """Pieces go to the vocabulary's merges, as letters for their bytes."""
        merge, letters = self.library.model.tokenize, self.letters
        for piece in new:
            spelled = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(letters)
            self.pieces[piece] = array("I", [x.id for x in merge(spelled)]).tobytes()

    def _learn(self, new: list[str]) -> None:
        latin = [w for w in new if is_latin(w)]
        split = [self.split(w.lower()) for w in latin]
        unseen = set().union(*split).difference(self.pieces)
        if len(self.pieces) + len(unseen) > MEMO_PIECES:
            self.pieces = {}
            unseen = set().union(*split)
        self._learn_pieces(unseen)
        known = self.pieces.__getitem__
        self.words.update(zip(latin, [b"".join(map(known, pieces)) for pieces in split], strict=True))
        other = [w for w in new if w not in self.words]
        self.words.update(zip(other, self._whole(other), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        ids, offsets = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]

    def encode_column(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, each followed by the end
        id if there is one, and the offsets of the texts (and the end)."""
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        texts = pc.fill_null(texts, "")
        if not self.by_piece:
            coded = [x + end for x in self._whole(texts.to_pylist())]
            return np.frombuffer(b"".join(coded), "<u4"), np.cumsum([0] + [len(x) // 4 for x in coded])
        # Lower-cased as the normaliser will do, so that fewer words are different.
        words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded = words.flatten().dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [w for w in different if w not in self.words]
        if len(self.words) + len(new) > MEMO_WORDS:  # what this batch has is likely to come again
            self.words = {w: self.words[w] for w in different if w in self.words}
        self._learn(new)
        ids = [*map(self.words.__getitem__, different), end]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        store, begins = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        # The end id is one more word after each text.
        breaks = words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
        which = np.insert(coded.indices.to_numpy().astype(np.int64), breaks[1:], len(different))
        long = sizes[which]
        until = np.cumsum(long)
        places = np.repeat(begins[which] - (until - long), long) + np.arange(int(until[-1]) if len(until) else 0)
        return store[places], np.concatenate([[0], until[breaks[1:] + np.arange(len(texts))]])


_ENCODERS: dict[int, PieceEncoder] = {}


def encoder_for(vocabulary: str) -> PieceEncoder:
    """One encoder per vocabulary and Python worker."""
    key = hash(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(vocabulary)
    return _ENCODERS[key]


def encode_sorted(
    docs: DataFrame, vocabulary_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """part, doc_id, local_start, size, ids in ascending id order."""
    spark = docs.sparkSession
    prepare(spark)
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())  # one vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, position, part = encoder_for(vocabulary.value), 0, TaskContext.get().partitionId()
        for batch in batches:
            flat, ends = encoder.encode_column(batch["text"], end_id)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(batch.num_rows, part, np.int32)),
                    batch["doc_id"],
                    pa.array(position + ends[:-1]),
                    pa.array(np.diff(ends)),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.astype(np.int32))),
                ],
                ["part", "doc_id", "local_start", "size", "ids"],
            )
            position += int(ends[-1])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()
    ordered = slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, f"part int, doc_id {id_type}, local_start long, size long, ids array<int>")


def write_tokens(encoded: DataFrame, path: str, row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES) -> None:
    """Write ``encode_sorted`` rows as Parquet files, one per run."""
    writer = encoded.write.mode("errorifexists").option("compression", "zstd")
    for key, value in {
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": 1000,
        "parquet.writer.version": "v2",
        "parquet.enable.dictionary": "true",  # the ids, and the constant part
        "parquet.enable.dictionary#doc_id": "false",  # these ascend: delta encoding
        "parquet.enable.dictionary#local_start": "false",
        "parquet.enable.dictionary#size": "false",
    }.items():
        writer = writer.option(key, str(value))
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str, low=None, high=None) -> DataFrame:
    """Rows of the files, of documents ``low`` to ``high`` if given (pushed
    down to row groups and pages)."""
    rows = spark.read.parquet(path)
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") <= high)
    return rows


def starts(spark: SparkSession, path: str) -> DataFrame:
    """part, base: ids before each run. The window runs over one row per
    written file; of the files only the metadata columns are read."""
    sizes = spark.read.parquet(path).groupBy("part").agg(F.max(F.col("local_start") + F.col("size")).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long").alias("base"))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, read from the files: doc_id, start, n_tokens, ids_crc32
    (of the ids as little-endian unsigned 32-bit integers)."""
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["ids"]
            ends = ids.offsets.to_numpy().astype(np.int64)
            data = memoryview(ids.values.to_numpy().astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["part"], batch["doc_id"], batch["local_start"], pa.array(np.diff(ends)), pa.array(crc, pa.int64())],
                ["part", "doc_id", "local_start", "n_tokens", "ids_crc32"],
            )

    rows = spark.read.parquet(path)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    digests = rows.mapInArrow(run, f"part int, doc_id {id_type}, local_start long, n_tokens long, ids_crc32 long")
    return digests.join(F.broadcast(starts(spark, path)), "part").select(  # one row per file
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )
