import random
import re
import zlib
from collections import Counter

import pytest

from tallyframe.llm import spelling_variants as sv
from tallyframe.llm.queries import LLM_QUERIES

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def neighbours(words):
    """Near words by comparing each word with all others that keep its start
    or its end (one edit leaves one half as it is)."""
    by_half = {}
    for w in words:
        for cut in range(len(w) + 1):
            by_half.setdefault((0, w[:cut]), []).append(w)
            by_half.setdefault((1, w[cut:]), []).append(w)
    out = {}
    for w in words:
        half = len(w) // 2
        out[w] = {x for x in {*by_half[0, w[:half]], *by_half[1, w[half:]]} if near(w, x)}
    return out


def brute(counts, short=4):
    found = neighbours([w for w in counts if len(w) >= short])
    rows, form = {}, {}
    for w, n in counts.items():
        best = min(found.get(w, ()), key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows[w] = (w, form[w], root, n, len(found.get(w, ())), counts[form[w]] if form[w] else None)
    return rows


def forms(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {r.word: tuple(r) for r in sv.spelling_forms(df).select(*COLUMNS).collect()}


@pytest.mark.parametrize("alphabet,lengths", [("ab", range(4, 9)), ("abcdefghij", range(4, 8)), ("aé€😀", range(4, 7)), ("ab", [23, 24, 25, 26, 27])])
def test_forms_equal_brute_force(spark, alphabet, lengths):
    rng = random.Random(len(alphabet) + len(lengths))
    words = set()
    while len(words) < 260:
        w = "".join(rng.choices(alphabet, k=rng.choice(list(lengths))))
        words.add(w)
        for _ in range(2):
            i = rng.randrange(len(w))
            words.add(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(alphabet) + w[i:], w[:i] + rng.choice(alphabet) + w[i + 1 :]]))
    counts = {w: rng.choice([3, 4, 7, 20, 20, 100, 1000]) for w in words if len(w) >= 4}
    want = brute(counts)
    assert sum(r[4] for r in want.values()) > 100
    assert forms(spark, counts) == want


def test_every_near_pair_meets_in_a_gram():
    """The lemma on the grams alone: the word with the smaller limit finds
    one of its grams in the other's prefix."""
    import numpy as np

    rng = random.Random(8)
    words = ["".join(rng.choices("aabcde", k=rng.randint(4, 30))) for _ in range(150)]
    pairs = Counter(ord(a) % 256 * 256 + ord(b) % 256 for w in words for a, b in zip(w, w[1:], strict=False))
    keys = sorted(pairs)
    table = sv.Rarity(np.array(keys), np.array([[pairs[k], 1 + k % 3, 1 + k % 5] for k in keys]))
    for w in words:
        for i in range(len(w) + 1):
            for x in {w[:i] + w[i + 1 :], w[:i] + "c" + w[i:], w[:i] + "e" + w[i + 1 :]}:
                if len(x) < 4 or not near(w, x):
                    continue
                (a, asked_a, prefix_a), (b, asked_b, prefix_b) = table.grams(w), table.grams(x)
                assert a > b or asked_a & prefix_b
                assert b > a or asked_b & prefix_a


def planted_words(rows):
    lower = {i: i + 32 for i in range(65, 91)}
    counts = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(lower)
            h = zlib.crc32(f"{doc_id}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def test_query_equals_brute_force(spark, documents, sample_dir):
    want = brute(planted_words(documents.select("doc_id", "text").collect()), 5)
    got = {r.word: tuple(r) for r in LLM_QUERIES["op12_spelling_variants"](spark, sample_dir).select(*COLUMNS).collect()}
    assert len(want) > 2000 and got == want
    assert any(r[1] and r[2] != r[1] for r in want.values())


def test_odd_rows(spark, odd_documents, tmp_path):
    df = spark.createDataFrame([(None, 5, "x"), ("", 1, "x"), ("ab", 2, "x"), ("abc", 9, "x"), ("word", 2, "x"), ("word", 1, "x"), ("words", 6, "x"), ("wordy", 6, "x")], "word string, n long, near string").selectExpr("*", "1 as form", "2 as gram")
    got = {r.word: tuple(r) for r in sv.spelling_forms(df).select(*COLUMNS).collect()}
    assert got["word"] == ("word", "words", "words", 3, 2, 6) and got["ab"] == ("ab", None, "ab", 2, 0, None) and got[""][4] == 0
    assert got["wordy"] == ("wordy", None, "wordy", 6, 2, None) and None not in got and len(got) == 6
    assert sv.spelling_forms(df.limit(0)).count() == 0
    long = "a" * 5_000
    assert forms(spark, {long: 3, long + "a": 9, "a" * 4_000 + "b" + "a" * 1_000: 20}) == {
        long: (long, "a" * 4_000 + "b" + "a" * 1_000, "a" * 4_000 + "b" + "a" * 1_000, 3, 2, 20),
        long + "a": (long + "a", "a" * 4_000 + "b" + "a" * 1_000, "a" * 4_000 + "b" + "a" * 1_000, 9, 2, 20),
        "a" * 4_000 + "b" + "a" * 1_000: ("a" * 4_000 + "b" + "a" * 1_000, None, "a" * 4_000 + "b" + "a" * 1_000, 20, 2, None),
    }
    odd_documents.write.parquet(f"{tmp_path}/documents.parquet")
    want = brute(planted_words(odd_documents.select("doc_id", "text").collect()), 5)
    got = {r.word: tuple(r) for r in LLM_QUERIES["op12_spelling_variants"](spark, str(tmp_path)).select(*COLUMNS).collect()}
    assert got == want
