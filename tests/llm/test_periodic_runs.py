import hashlib
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import periodic_runs as pr
from tallyframe.llm.queries import LLM_QUERIES


def brute(words):
    """Every maximal stretch of every period, by definition; of the periods
    of a stretch only the smallest counts."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(6, 4 * q):
                part = words[start : start + length]
                if not any(all(part[k] == part[k - d] for k in range(d, length)) for d in range(1, q)):
                    out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def row(doc_id, words):
    from fractions import Fraction

    runs = brute(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *numbers, sha("".join("%d,%d,%d\n" % r for r in runs)), sha(kept))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), max_size=4), st.data())
def test_runs_equal_the_definition(texts, data):
    # Repeat a part of each text, so that longer periods occur.
    for words in texts:
        if words and data.draw(st.booleans()):
            a = data.draw(st.integers(0, len(words) - 1))
            b = data.draw(st.integers(a + 1, len(words)))
            words[b:b] = words[a:b] * data.draw(st.integers(0, 5))
    assert pr.find_runs(texts) == [brute(x) for x in texts]


def test_long_periods_and_nested_runs():
    rng = random.Random(3)
    block = [b"w%d" % rng.randrange(40) for _ in range(211)]
    nested = ([b"x"] * 7 + [b"y"]) * 5 + [b"z"]
    texts = [block * 4, block * 3 + block[:-1], nested * 6, [b"x"] * 5, [b"x"] * 6, block + nested * 4 + block * 5, [b"x"] * 3000]
    for q in (1, 2, 3, 4, 5, 6, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 65):
        unit = [b"u%d" % i for i in range(q - 1)] + [b"v"]
        texts += [unit * 4, unit * 3 + unit[:-1], unit * 9 + unit[:1]]
    got = pr.find_runs(texts)
    for words, runs in zip(texts[:6] + texts[7:], got[:6] + got[7:], strict=True):
        assert runs == brute(words)
    assert got[6] == [(0, 3000, 1)]


def test_query_equals_brute_force(spark, documents, sample_dir):
    want = {r.doc_id: row(r.doc_id, planted(r.doc_id, r.text)) for r in documents.where("length(text) < 6000").collect()}
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    result = LLM_QUERIES["op13_periodic_runs"](spark, sample_dir).select(*columns).collect()
    assert len(result) == documents.count()
    got = {r.doc_id: tuple(r) for r in result}
    assert len(want) > 150 and all(got[k] == want[k] for k in want)
    assert sum(r.n_runs > 0 for r in result) >= 10


def test_odd_rows(spark, odd_documents, tmp_path):
    got = sorted((r.id is None, r.id or 0, r.n_words, len(r.runs)) for r in pr.periodic_runs(odd_documents.selectExpr("*", "1 as id", "2 as runs")).collect())
    assert len(got) == 11 and (False, 3, 0, 0) in got and (False, 5, 0, 0) in got and (False, 7, 120_000, 0) in got
    assert pr.periodic_runs(odd_documents.limit(0)).count() == 0
    # Words end at the six ASCII characters only.
    text = "a\x1cb c d\x0be\x0cf\tg\rh\ni"
    one = pr.periodic_runs(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert one.n_words == 7 and one.collapsed == "a\x1cb c d e f g h i"
    repeated = "x " * 200_000 + "tail"
    one = pr.periodic_runs(spark.createDataFrame([(1, repeated)], "doc_id int, text string")).first()
    assert [tuple(r) for r in one.runs] == [(0, 200_000, 1)] and one.collapsed == "x tail"
    # The query on odd rows: nothing is lost.
    odd_documents.write.parquet(f"{tmp_path}/documents.parquet")
    result = LLM_QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()
    assert len(result) == 11 and all(r.runs_sha256 and r.collapsed_sha256 for r in result)
