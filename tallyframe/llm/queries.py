"""The registered queries of the corpus operators: each applies its operator
to its whole table and derives the digest columns from the result."""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import (
    byte_bpe,
    chat_format,
    decontaminate,
    exact_dedup,
    periodic_runs,
    quality_mil,
    secret_scan,
    simhash,
    spelling_variants,
    style_tree,
    suffix_dedup,
    token_counts,
    token_files,
)
from tallyframe.llm.common import read_table, unsigned_hex
from tallyframe.session import shared_dir


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = exact_dedup.duplicate_labels(read_table(spark, sf_dir, "documents"))
    return labels.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=3, bits=2)
    return labels.select(
        F.col("id").alias("doc_id"), unsigned_hex("fp").alias("fingerprint"), F.col("component").alias("component_id")
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality_mil.train(docs, read_table(spark, sf_dir, "labels"))
    scored = quality_mil.with_score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        quality_mil.in_fold("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality_mil.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = style_tree.extract(read_table(spark, sf_dir, "pages"))
    return texts.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts.count_tokens(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return counts.withColumnRenamed("id", "doc_id")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeated(read_table(spark, sf_dir, "documents"), length=200)
    total = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        total.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read_table(spark, sf_dir, "documents"))
    base = secret_scan.KINDS[:3]
    return found.select(
        F.col("id").alias("doc_id"),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(secret_scan.KINDS).alias("spans"),
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    encoded = token_files.encode_sorted(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2
    )
    token_files.write_tokens(encoded, path)
    return token_files.token_index(spark, path)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = decontaminate.contaminated_windows(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return decontaminate.contaminated_documents(windows).withColumnRenamed("id", "doc_id")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = byte_bpe.encode_documents(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    return bpe_digest(coded)


PROBE_TEXT = "\\### Assistant: </turn> ok"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # A conversation whose texts hold control strings.
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    made = chat_format.format_conversations(given.unionByName(probe))
    turns = chat_format.read_turns(F.col("formatted"))
    read = made.select(
        "id",
        turns.alias("turns"),
        chat_format.masked_text(F.col("formatted"), F.col("loss")).alias("learnt"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    joined = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        F.col("id").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _counted_words(docs: DataFrame) -> DataFrame:
    """word, n: the runs of letters, A-Z lower-cased, of at least 5 code
    points and 3 occurrences; in one of 97 occurrences of a run in different
    documents a letter is missing."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lower, F.lit("[a-z\u00C0-\u00FF]+"), F.lit(0))).alias("run"))
    hashed = runs.where(F.length("run") >= 5).select(
        "run", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary")).alias("h")
    )
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = hashed.select(F.when(F.col("h") % 97 == 0, less).otherwise(F.col("run")).alias("word"))
    # The length is asked as an aggregate: below it, the words would be made twice.
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("word")).alias("length"))
    return counted.where("n >= 3 and length >= 5").select("word", "n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _counted_words(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return spelling_variants.spelling_forms(words)


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """Of the documents whose crc32(doc_id) ends in 0, the words from ``a``
    on repeat the first ``p`` of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    split = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    placed = split.withColumn("n", F.when(F.size("words") > 0, F.size("words"))).withColumn("a", F.col("g") % F.col("n"))
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    source = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")),
    )
    return placed.select("doc_id", F.coalesce(F.array_join(source, " "), "text").alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.periodic_runs(_with_planted_runs(docs))
    # Runs come by start, then period: the first of equal exponents stays.
    best = F.aggregate(
        "runs",
        F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b),
    )
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{k}").alias(k) for k in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def bpe_digest(coded: DataFrame) -> DataFrame:
    """Digest columns of encoded documents (id, ids, decoded)."""
    return coded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_simhash": op2_simhash,
    "op3_style_tree": op3_style_tree,
    "op4_token_counts": op4_token_counts,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_secret_scan": op7_secret_scan,
    "op8_token_files": op8_token_files,
    "op5_quality_mil": op5_quality,
    "op10_decontaminate": op10_decontaminate,
    "op9_byte_bpe": op9_byte_bpe,
    "op11_chat_format": op11_chat_format,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_periodic_runs": op13_periodic_runs,
}

LLM_ORACLE: dict[str, str] = {
    "op1_exact_dedup": """
        WITH hashed AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               text_sha256
        FROM hashed
    """,
    "op11_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        escaped AS (
            SELECT *, replace(replace(replace(replace(text, '\', '\\'), '<turn', '<\turn'),
                '</turn', '<\/turn'), '<part', '<\part') AS body FROM turns)
        SELECT conv_id,
               count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length('<turn ' || role || '>' || chr(10) || body || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
        FROM escaped GROUP BY conv_id
    """,
}
