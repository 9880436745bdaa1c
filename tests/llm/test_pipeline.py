import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from tallyframe.llm import byte_bpe
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_every_stage_against_its_input(spark, tmp_path):
    sample_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    columns = docs.columns
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sample_dir)
        out.write.parquet(f"{tmp_path}/{k}")
        kept = spark.read.parquet(f"{tmp_path}/{k}")
        before, after = docs.toPandas().set_index("doc_id"), kept.toPandas().set_index("doc_id")
        assert set(after.index) <= set(before.index) and after.index.is_unique
        if name != "byte_bpe":
            assert kept.columns == columns
            assert (after.text == before.text[after.index]).all()
        seen.append((name, before, after))
        docs = kept
    by_name = {n: (b, a) for n, b, a in seen}
    before, after = by_name["exact_dedup"]
    low = before.text.map(lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
    assert set(after.index) == set(before.reset_index().groupby(low.values).doc_id.max())
    before, after = by_name["byte_bpe"]
    assert set(after.index) == set(before.index)
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(ranks)}, special_tokens={})
    for doc, text in before.text.items():
        assert after.n_tokens[doc] == len(library.encode_ordinary(text))
        assert after.decoded_sha256[doc] == hashlib.sha256(text.encode()).hexdigest()
    before, after = by_name["simhash_near_dedup"]
    prints = [plain_fingerprint(t) for t in before.text]
    component = plain_components(list(before.index), prints, 2)
    assert set(after.index) == set(component.values())
    for name in ("quality_classifier", "exact_dedup", "benchmark_decontamination"):
        assert len(by_name[name][1]) < len(by_name[name][0])


def test_run(spark, sample_dir):
    out = corpus_pipeline.run(spark, sample_dir)
    assert out.count() > 50 and "ids_sha256" in out.columns


def test_empty_corpus(spark, sample_dir, tmp_path):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sample_dir).write.parquet(f"{tmp_path}/e{k}")
        docs = spark.read.parquet(f"{tmp_path}/e{k}")
    assert docs.count() == 0


def test_stages_on_odd_rows(spark, odd_documents, sample_dir, tmp_path):
    """Nulls, empties, a long text, repeated rows, ties, and extra columns
    that are called like the operators' own."""
    from pyspark.sql import functions as F

    clashing = ["id", "sha", "row", "possible", "keep_id", "component", "score", "label", "key", "hash", "window", "n", "fp", "block", "word"]
    docs = odd_documents.withColumns({c: F.lit(c) for c in clashing}).withColumn("lang", F.lit(None).cast("string"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sample_dir)
        out.write.parquet(f"{tmp_path}/o{k}")
        kept = spark.read.parquet(f"{tmp_path}/o{k}")
        assert kept.count() <= docs.count()
        if name != "byte_bpe":
            assert kept.columns == docs.columns
            assert kept.where("component != 'component'").count() == 0
        docs = kept if kept.count() and name != "byte_bpe" else docs
    assert docs.where("doc_id = 1").count() <= 1
