"""The corpus pipeline: five operators in a row over the documents table.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. ``run`` writes
what a stage returns as Parquet to the shared folder and hands the reread
table to the next one, so a lost executor costs a reread and never an
earlier stage. All stages but the last return the columns of documents; the
last returns the encoded documents as digests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import byte_bpe, decontaminate, exact_dedup, quality_mil, simhash
from tallyframe.llm.common import prepare, read_table
from tallyframe.llm.queries import bpe_digest
from tallyframe.session import remove_folder, shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. It is trained
    on labelled rows of what it is given."""
    model = quality_mil.train(docs, read_table(spark, sf_dir, "labels"))
    return quality_mil.drop_rejected(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked SimHash fingerprints, the document with the smallest id."""
    return simhash.drop_near_duplicates(docs, words=3, bits=2)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the decoded bytes of every document, as digests."""
    import public_tokenizers

    return bpe_digest(
        byte_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    )


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("benchmark_decontamination", benchmark),
    ("byte_bpe", encode),
]

# A trained classifier decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    prepare(spark)
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    done = None
    for number, (name, stage) in enumerate(STAGES, 1):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if done is not None:
            remove_folder(spark, done)  # what the next stage has read is no longer needed
        done = path
    return docs
