import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import suffix_dedup as sd
from tallyframe.llm.queries import LLM_QUERIES


def plain(rows, n=200):
    """Runs covered by a string of n bytes that starts anywhere else too."""
    data = [(t or "").encode() for _, t in rows]
    counts = {}
    for b in data:
        for k in range(len(b) - n + 1):
            w = b[k : k + n]
            counts[w] = counts.get(w, 0) + 1
    out = []
    for b in data:
        out.append(sd.merged((k, k + n) for k in range(len(b) - n + 1) if counts[b[k : k + n]] > 1))
    return data, out


def check(spark, rows, n=200):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.id is not None, r.id, r.kept, [tuple(x) for x in r.removed]) for r in sd.remove_repeated(docs, length=n).collect())
    data, runs = plain(rows, n)
    want = []
    for (i, _), b, cuts in zip(rows, data, runs, strict=True):
        mask = np.ones(len(b), bool)
        for s, e in cuts:
            mask[s:e] = False
        want.append((i is not None, i, bytes(np.frombuffer(b, np.uint8)[mask]), cuts))
    assert got == sorted(want)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=9).map(lambda b: b"x" * 50 + bytes(97 + c % 2 for c in b) * 3), max_size=12))
def test_sort(strings):
    assert [strings[i] for i in sd.deep_shallow_sort(strings)] == sorted(strings)
    trie = sd.BlindTrie(strings)
    for i in range(len(strings)):
        trie.insert(i)
    assert [strings[i] for i in trie.order()] == sorted(strings)


@given(st.binary(max_size=12), st.binary(max_size=12), st.binary(max_size=12))
def test_common_prefix(a, b, c):
    n = sd.common_prefix(c + a, c + b)
    assert (c + a)[:n] == (c + b)[:n] and (n == min(len(c + a), len(c + b)) or (c + a)[n] != (c + b)[n])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=6), st.binary(max_size=6)).map(lambda p: tuple(bytes(97 + c % 2 for c in x) for x in p)), min_size=2, max_size=8))
def test_pairs_of_a_group(pairs):
    lefts, rights = [p[0] for p in pairs], [p[1] for p in pairs]
    got = {}
    for i, before, after in sd.repeated_in_group(lefts, rights, 5):
        got.setdefault(i, set()).update((s, s + 5) for s in range(-before, after - 4))
    want = {}
    for i in range(len(pairs)):
        for j in range(len(pairs)):
            if i != j:
                before, after = sd.common_prefix(lefts[i], lefts[j]), sd.common_prefix(rights[i], rights[j])
                if before + after >= 5:
                    want.setdefault(i, set()).update((s, s + 5) for s in range(-before, after - 4))
    assert got == want


def passages():
    random.seed(5)
    word = lambda: "".join(random.choices("abcdé", k=random.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(random.randrange(30, 90)) for _ in range(6)]
    rows = [(i, f"{text(20)} {random.choice(shared)} {text(25)}") for i in range(60)]
    edge = text(200).encode().decode()
    rows += [(100, edge[:199]), (101, "z" + edge[:199]), (102, edge[300:500] + "q"), (103, "p" + edge[300:501])]
    rows += [(200, "ab" * 300), (201, "a" * 199), (202, "b" * 200), (203, "c" * 201), (204, "la " * 400 + edge)]
    return rows + [(300, None), (301, ""), (302, rows[0][1]), (302, rows[0][1]), (None, shared[0]), (None, text(60)), (303, rows[3][1][:250])]


@pytest.mark.parametrize("group", [20_000, 3, 1])
def test_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(sd, "GROUP", group)
    check(spark, passages())


def test_another_length_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(sd, "CHUNK", 150)
    check(spark, passages(), 64)


def test_query(spark, sample_dir, documents):
    got = {r.doc_id: r for r in LLM_QUERIES["op6_suffix_dedup"](spark, sample_dir).collect()}
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    data, runs = plain(rows)
    for (i, _), b, cuts in zip(rows, data, runs, strict=True):
        kept = b"".join(b[x:y] for x, y in zip([0, *[e for _, e in cuts]], [*[s for s, _ in cuts], len(b)], strict=True))
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(b), sum(e - s for s, e in cuts), len(cuts))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_odd_rows(odd_documents):
    got = sd.remove_repeated(odd_documents).collect()
    assert len(got) == odd_documents.count()
    assert sd.remove_repeated(odd_documents.limit(0)).count() == 0
    with pytest.raises(ValueError, match="length"):
        sd.remove_repeated(odd_documents, length=10)
