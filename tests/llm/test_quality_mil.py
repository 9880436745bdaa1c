import zlib

import numpy as np
import pytest

from tallyframe.llm import quality_mil as q
from tallyframe.llm.queries import LLM_QUERIES


@pytest.fixture(scope="module")
def model(spark):
    d = "/root/testdata/sf0.01"
    return q.train(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(0)
    bags = [rng.random((n, q.N_FEATURES)).astype(np.float32) for n in (1, 4, 2)]
    labels, weight = np.array([1, 0, 1], np.float32), np.array([0.7, 1.2, 0.7])
    model = q.Model()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}

    def loss():
        total = 0
        for x, y, w in zip(bags, labels, weight, strict=True):
            h = model.encode(x)
            a = np.exp(model.attend(h)[0])
            s = 1 / (1 + np.exp(-((a / a.sum()) @ h @ model.p["c"] + model.p["b"][0])))
            total -= w * (y * np.log(s) + (1 - y) * np.log(1 - s))
        return total / len(bags)

    grads = model._gradients(bags, labels, weight)
    for name, grad in grads.items():
        flat = model.p[name].reshape(-1)
        for i in rng.integers(0, flat.size, 3):
            kept = flat[i]
            flat[i] = kept + 1e-5
            up = loss()
            flat[i] = kept - 1e-5
            down = loss()
            flat[i] = kept
            assert abs((up - down) / 2e-5 - np.asarray(grad).reshape(-1)[i]) < 1e-4


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in LLM_QUERIES["op5_quality_mil"](spark, d).collect()}
    for doc, r in got.items():
        assert r.held_out == (zlib.crc32(str(doc).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in spark.read.parquet(f"{d}/labels.parquet").collect() if got[r.doc_id].held_out]
    score = np.array([got[r.doc_id].score for r in held])
    label = np.array([r.quality for r in held])
    auc = (score[label == 1][:, None] > score[label == 0][None, :]).mean()
    assert auc > 0.98
    assert (score[label == 1] >= 0.3).mean() > 0.97


def test_attention_finds_the_junk_passage(model, spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    good = next(t for t in texts if len(t) > 3000 and model.score(t) > 0.9)
    junk = next(t for t in texts if len(t) > 600 and model.score(t) < 0.05)
    assert model.score(good + " " + junk[:600]) < model.score(good)


def test_long_text_in_blocks_scores_like_one_block(model, monkeypatch):
    text = "Some ordinary words in a sentence. " * 3000
    whole = model.score(text)
    monkeypatch.setattr(q, "BLOCK", 3)
    # Blocks cut byte pairs at their borders only, which are passage borders.
    assert abs(model.score(text) - whole) < 1e-3


def test_odd_rows(spark, odd_documents):
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (2, 0), (3, None), (None, 1), (4, 0), (99, 1), (7, 1), (8, 0)], "doc_id long, quality int"
    )
    model = q.train(odd_documents, labels)
    scored = q.with_score(odd_documents, model, "points")
    assert scored.columns == [*odd_documents.columns, "points"] and scored.count() == odd_documents.count()
    assert all(0 <= r.points <= 1 for r in scored.collect())
    assert q.drop_rejected(odd_documents.withColumnRenamed("kept", "score_"), model, 0.0).count() == odd_documents.count()
    none = q.train(odd_documents, labels.limit(0))
    assert none.constant == 0.5
    one = q.train(odd_documents, spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int"))
    assert one.constant in (0.5, 1.0)
    assert q.with_score(odd_documents.limit(0), model).count() == 0


def plain_score(model, text):
    """All passages at once, and the softmax as it is written down."""
    x = np.concatenate(list(q.passage_blocks(text))).astype(np.float64)
    size = x[:, -1:] * q.PASSAGE
    x = (x - model.mean) / model.scale * (size / (size + q.SHORT))
    p = {k: v.astype(np.float64) for k, v in model.p.items()}
    h = np.tanh(x @ p["E"] + p["e"])
    logit = (np.tanh(h @ p["V"]) / (1 + np.exp(-(h @ p["U"])))) @ p["w"]
    attention = np.exp(logit - logit.max())
    return 1 / (1 + np.exp(-(attention / attention.sum() @ h @ p["c"] + p["b"][0])))


def test_scores_equal_a_plain_scorer_of_the_same_model(model, spark):
    """Every document of the table; and the pipeline's stage keeps the same ones."""
    import corpus_pipeline

    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    want = {r.doc_id: plain_score(model, r.text) for r in docs.collect()}
    got = {r.doc_id: r.score for r in LLM_QUERIES["op5_quality_mil"](spark, d).collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-4
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, d).select("doc_id").collect()}
    clear = {k for k, v in want.items() if abs(v - q.THRESHOLD) > 1e-4}
    assert kept & clear == {k for k in clear if want[k] >= q.THRESHOLD} and 0 < len(kept) < len(want)
