import re
from collections import defaultdict

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import simhash
from tallyframe.llm.components import connected_components
from tallyframe.llm.queries import LLM_QUERIES


def plain_fingerprint(text, k=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, fps, bits):
    root = {i: i for i in range(len(fps))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = defaultdict(lambda: 1 << 62)
    for i, doc in enumerate(pairs):
        least[find(i)] = min(least[find(i)], doc)
    return {doc: least[find(i)] for i, doc in enumerate(pairs)}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAéÉ \n\t\x0b\x1c z1", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_query_equals_brute_force(spark, sample_dir, documents):
    got = {r.doc_id: r for r in LLM_QUERIES["op2_simhash"](spark, sample_dir).collect()}
    docs = documents.collect()
    fps = [plain_fingerprint(r.text) for r in docs]
    want = plain_components([r.doc_id for r in docs], fps, 2)
    assert {k: r.component_id for k, r in got.items()} == want
    assert [got[r.doc_id].fingerprint for r in docs] == [f"{x:016x}" for x in fps]


def test_dense_and_large_postings_agree(monkeypatch):
    rng = np.random.default_rng(1)
    mask = simhash.position_masks(2)[5]
    free = ~np.uint64(mask)
    fps = np.unique((rng.integers(0, 1 << 63, 400).astype(np.uint64) & free) | np.uint64(0x1234567812345678 & mask))
    want = None
    for limit in (0, 1 << 20):
        monkeypatch.setattr(simhash, "DENSE", limit)
        a, b = simhash.link_posting(fps, mask, 2)
        assert len(a) == len(set(a.tolist())) < len(fps)  # a forest
        label = {int(x): int(x) for x in fps} | dict(zip(a.tolist(), b.tolist(), strict=True))
        want = want or label
        assert label == want


def test_links_find_every_near_pair(spark):
    rng = np.random.default_rng(3)
    seeds = rng.integers(-(1 << 62), 1 << 62, 300).tolist()
    fps = set(seeds)
    for x in seeds[:200]:
        y = x
        for _ in range(6):  # chains of up to two flipped bits
            for b in rng.integers(0, 63, 2).tolist():
                y ^= 1 << b
            fps.add(y)
    fps = sorted(fps)
    edges = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"))
    got = {r.node: r.root for r in connected_components(edges).collect()}
    want = plain_components(fps, [x & (1 << 64) - 1 for x in fps], 2)
    group = defaultdict(set)
    for x in fps:
        group[got.get(x, x)].add(x)
    other = defaultdict(set)
    for x, y in want.items():
        other[y].add(x)
    assert sorted(map(sorted, group.values())) == sorted(map(sorted, other.values()))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}


def test_odd_rows(odd_documents):
    labels = simhash.near_duplicates(odd_documents).collect()
    assert len(labels) == odd_documents.count()
    component = {r.id: r.component for r in labels if r.id is not None}
    assert component[1] == component[2] == 1
    assert component[3] == component[4] == component[5] == 3
    kept = simhash.drop_near_duplicates(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids.count(1) == 1 and {3, 7} <= set(ids) and not {2, 4, 5} & set(ids)
    assert simhash.near_duplicates(odd_documents.limit(0)).count() == 0


def test_rows_are_named_by_id_and_text(spark):
    """Null ids, and different texts under one id: one copy stays, no clean text goes."""
    copy = "the same words stand in all of these rows and nothing else does"
    clean = "another text altogether that has an id in common with one of the copies"
    rows = [(None, copy, 1), (None, copy, 2), (5, copy, 3), (9, clean, 4), (9, copy, 5)]
    schema = "doc_id long, text string, extra int"
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(5, copy), (9, clean)]
    # Without any id one still stays; of rows equal in id and text the smallest in the other columns.
    kept = simhash.drop_near_duplicates(spark.createDataFrame([(None, copy, 7), (None, copy, 6), (3, clean, 9), (3, clean, 8)], schema)).collect()
    assert sorted(tuple(r) for r in kept if r.doc_id) == [(3, clean, 8)] and [tuple(r) for r in kept if not r.doc_id] == [(None, copy, 6)]
