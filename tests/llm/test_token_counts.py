import unicodedata

import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import token_counts as tc
from tallyframe.llm.queries import LLM_QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = tc.read_pieces(PATH)
VOCABULARY = set(PIECES)
COUNTER = tc.Counter(PIECES)


def greedy(symbols, vocabulary):
    n = 0
    while symbols:
        size = next((k for k in range(len(symbols), 0, -1) if symbols[:k] in vocabulary), None)
        if size is None:
            return -1
        symbols, n = symbols[size:], n + 1
    return n


def plain(text):
    words = regex.findall(tc.SPLIT, unicodedata.normalize("NFC", text or "").lower())
    data = [w.encode() for w in words]
    return len(words), sum(greedy((*w[:-1], w[-1] + 256), VOCABULARY) for w in data)


def test_query(spark, sample_dir, documents):
    got = {r.doc_id: r for r in LLM_QUERIES["op4_token_counts"](spark, sample_dir).collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    for r in rows[:60]:
        assert (got[r.doc_id].n_words, got[r.doc_id].n_pieces) == plain(r.text)
        assert got[r.doc_id].n_bytes == len(r.text.encode())


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert COUNTER.count(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=5).map(lambda b: bytes(x % 3 for x in b)), max_size=12), st.binary(max_size=14))
def test_automaton_over_small_vocabularies(pieces, word):
    """Also vocabularies that lack single bytes, where greedy can get stuck."""
    word = bytes(x % 3 for x in word)
    symbols = [tuple(p) for p in pieces] + [(*p[:-1], p[-1] + 256) for p in pieces[::2]]
    last = (*word[:-1], word[-1] + 256) if word else ()
    assert tc.Automaton(symbols).count(word) == greedy(last, set(symbols))


@pytest.mark.parametrize("text", ["", "  \n ", "a" * 5000, "́a é", "don't  stop", "١٢ ½"])
def test_edges(text):
    assert COUNTER.count(text) == plain(text)


def test_odd_rows(odd_documents):
    got = tc.count_tokens(odd_documents, PATH).collect()
    assert len(got) == odd_documents.count()
    assert all(r.n_words == r.n_pieces == 0 for r in got if r.id in (3, 4, 5))
    assert tc.count_tokens(odd_documents.limit(0), PATH).count() == 0
