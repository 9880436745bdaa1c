import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import secret_scan as ss
from tallyframe.llm.queries import LLM_QUERIES

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return out + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


def entropy(s):
    best = 0.0
    for i in range(len(s) - ss.WINDOW + 1):
        counts = Counter(s[i : i + ss.WINDOW])
        best = max(best, -sum(n / ss.WINDOW * math.log2(n / ss.WINDOW) for n in counts.values()))
    return best


def added(text):
    out = []
    for rank, (kind, (pattern, least)) in enumerate(ss.CLASSES.items(), 3):
        for m in re.finditer(pattern, text):
            s = m[0]
            if re.search("[0-9]", s) and re.search("[A-Za-z]", s) and not any(re.search(a, s) for a in ss.ALLOW) and entropy(s) >= least:
                out.append((m.start(), rank, m.end(), kind))
    return out


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = ss.scan(docs).select("id", ss.joined(ss.KINDS[:3]).alias("base"), ss.joined(ss.KINDS).alias("spans"))
    return {r.id: r for r in found.collect()}


def random_texts(n):
    random.seed(9)
    words = ["token", "TOKEN = ", 'secret": "', "api_key:", "apikey=", "passwd", " ", "é", "🙂", "\n", ".", "=", "AKIA", "A1B2C3D4E5F6G7H8", "a1b2c3d4", "0f" * 12, "Zz9+/", "abc", "token=ab", "ſecret=abcdefgh"]
    out = ["".join(random.choices(words, k=random.randrange(1, 40))) for _ in range(n)]
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    out += [f"x {''.join(random.choices(letters, k=k))} y" for k in range(15, 60, 3)]
    return out


def test_against_brute_force(spark):
    texts = random_texts(300)
    got = scanned(spark, texts)
    for i, text in enumerate(texts):
        assert got[i].base == joined(base(text)), text
        assert got[i].spans == joined(base(text) + added(text)), text


def test_query(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in LLM_QUERIES["op7_secret_scan"](spark, d).collect()}
    for r in spark.read.parquet(f"{d}/documents.parquet").collect():
        want = base(r.text or "")
        row = got[r.doc_id]
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(x[1] == k for x in want) for k in range(3)]
        assert row.base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest()
        assert row.spans == joined(want + added(r.text or ""))


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("key Xa81kQ0pVz7Lw3RtY9bC here", "entropy_base64"),
        ("id 123e4567-e89b-12d3-a456-426614174000 here", None),
        ("EXAMPLEkeyXa81kQ0pVz7Lw3RtY9bC", None),
        ("zzzzzzzzzzzzzzzzzzzzzzzzz1", None),
        ("internationalisationalists", None),
    ],
)
def test_entropy_and_allow_list(spark, text, kind):
    spans = scanned(spark, [text])[0].spans
    assert (kind in spans) if kind else spans == ""


def test_max_window_entropy(spark):
    random.seed(2)
    texts = ["".join(random.choices("abAB01+/=_-z", k=random.randrange(20, 90))) for _ in range(40)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in frame.select("t", ss.max_window_entropy(F.col("t")).alias("h")).collect():
        assert abs(r.h - entropy(r.t)) < 1e-9


def test_many_matches_in_one_text(spark):
    text = "token=abcdef " * 3000 + "é" + "0a" * 12
    row = scanned(spark, [text])[0]
    assert row.base == joined(base(text))


def test_only_sql_functions(spark, sample_dir):
    plan = LLM_QUERIES["op7_secret_scan"](spark, sample_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_odd_rows(odd_documents):
    got = ss.scan(odd_documents, keep=("kept", "score"))
    assert got.columns[-2:] == ["kept", "score"] and got.count() == odd_documents.count()
    assert ss.scan(odd_documents.limit(0)).count() == 0


BORDERS = [
    ("sig=9F86D081884C7D659A2F", "9F86D081884C7D659A2F", "entropy_hex"),
    ("a/b_9F86D081884C7D659A2F/c", "9F86D081884C7D659A2F", "entropy_hex"),
    ("sample/Xa81kQ0pVz7Lw3RtY9bC", "Xa81kQ0pVz7Lw3RtY9bC", "entropy_piece"),
    ("Xa81kQ0pVz7Lw3RtY9bC=example_0123456789", "Xa81kQ0pVz7Lw3RtY9bC", "entropy_piece"),
    ("sample-key=Xa81kQ0pVz7Lw3RtY9bC==", "Xa81kQ0pVz7Lw3RtY9bC==", "entropy_piece"),
    ("sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=", "", None),
    ("id=sample-Xa81kQ0pVz", "", None),
]


def test_borders_of_candidates(spark):
    got = scanned(spark, [text for text, _, _ in BORDERS])
    for i, (text, secret, kind) in enumerate(BORDERS):
        start = text.index(secret)
        assert (f"{kind}:{start}:{start + len(secret)}" in got[i].spans.split(",")) if kind else got[i].spans == "", text
