import json
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tallyframe.llm import token_files as tf
from tallyframe.llm.queries import LLM_QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(PATH)
    out.encode_special_tokens = True
    return out


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_word_by_piece_equals_the_library(library, documents, monkeypatch):
    with open(PATH, encoding="utf-8") as file:
        encoder = tf.PieceEncoder(file.read())
    assert encoder.by_piece
    random.seed(4)
    odd = " aAbé\n\tÉ'sİıß́İΣσςǅK1９²½_-‍\x1c "
    texts = [r.text for r in documents.collect()]
    texts += ["".join(random.choices(odd, k=50)) for _ in range(500)] + ["", "<|endoftext|> x", "ΣΑΣ a", "日本語 🙂", "x" * 30_000]
    for size in (tf.MEMO_PIECES, 30):
        monkeypatch.setattr(tf, "MEMO_PIECES", size)
        for at in range(0, len(texts), 50):
            got = encoder.encode(texts[at : at + 50])
            for text, data in zip(texts[at : at + 50], got, strict=True):
                assert np.frombuffer(data, "<u4").tolist() == ids_of(library, text)


def test_another_vocabulary_goes_to_the_library_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        encoder = tf.PieceEncoder(file.read())
    assert not encoder.by_piece
    texts = ["Some text, with  blanks", ""]
    want = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want


def test_query(spark, sample_dir, documents, library):
    got = {r.doc_id: r for r in LLM_QUERIES["op8_token_files"](spark, sample_dir).collect()}
    start = 0
    for r in sorted(documents.collect(), key=lambda r: r.doc_id):
        ids = [*ids_of(library, r.text), 2]
        row = got[r.doc_id]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_files(spark, documents, tmp_path):
    path = str(tmp_path / "tokens")
    tf.write_tokens(tf.encode_sorted(documents, PATH, 2), path, row_group_bytes=64 << 10, page_bytes=4 << 10)
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    order = []
    for name in files:
        file = pq.ParquetFile(f"{path}/{name}")
        group = file.metadata.row_group(0)
        columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
        assert columns["doc_id"].has_column_index and columns["ids.list.element"].has_offset_index
        order += file.read(columns=["doc_id"])["doc_id"].to_pylist()
    assert order == sorted(order) and len(order) == documents.count()
    some = tf.read_tokens(spark, path, 10, 19).select("doc_id", "local_start")
    plan = some._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,10)" in plan and "ids" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert sorted(r.doc_id for r in some.collect()) == list(range(10, 20))


def test_odd_rows(spark, odd_documents, tmp_path, library):
    path = str(tmp_path / "odd")
    tf.write_tokens(tf.encode_sorted(odd_documents, PATH, 2), path)
    got = tf.token_index(spark, path).collect()
    assert len(got) == odd_documents.count()
    assert sorted(r.start for r in got)[0] == 0 and {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    first = min(r.start for r in got if r.doc_id is not None)
    assert all(r.start < first for r in got if r.doc_id is None)
    ends = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))
    empty = str(tmp_path / "none")
    tf.write_tokens(tf.encode_sorted(odd_documents.limit(0), PATH, 2), empty)
    assert tf.token_index(spark, empty).count() == 0


def test_the_fast_path_knows_its_vocabulary():
    with open(PATH, encoding="utf-8") as file:
        parts = json.load(file)
    parts["normalizer"]["normalizers"].pop()
    assert not tf.PieceEncoder(json.dumps(parts)).by_piece
