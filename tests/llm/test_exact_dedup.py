import duckdb
from pyspark.sql import functions as F

from tallyframe.llm import exact_dedup
from tallyframe.llm.queries import LLM_ORACLE, LLM_QUERIES


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_query_equals_sql(spark, sample_dir):
    got = LLM_QUERIES["op1_exact_dedup"](spark, sample_dir).toPandas()
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sample_dir}/documents.parquet'")
    want = con.execute(LLM_ORACLE["op1_exact_dedup"]).df()
    cols = sorted(want.columns)
    assert sorted(map(tuple, got[cols].values.tolist())) == sorted(map(tuple, want[cols].values.tolist()))


def test_odd_rows(odd_documents):
    labels = [r.asDict() for r in exact_dedup.duplicate_labels(odd_documents).collect()]
    assert len(labels) == odd_documents.count()
    same = [r for r in labels if r["keep_id"] == 2]
    assert len(same) == 4 and {r["group_size"] for r in same} == {4}
    assert [r["id"] for r in same if r["kept"]] == [2]
    empty = [r for r in labels if r["keep_id"] == 4]
    assert sorted(r["id"] for r in empty) == [3, 4] and [r["id"] for r in empty if r["kept"]] == [4]
    # A-Z only: the capital with an accent is another letter.
    assert all(r["group_size"] == 1 for r in labels if r["id"] in (8, 9))


def test_drop_copies_keeps_columns(odd_documents):
    kept = exact_dedup.drop_copies(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "4", "5", "7", "8", "9", "None"]


def test_repeated_rows_tied_on_the_kept_id(spark):
    docs = spark.createDataFrame([(5, "x"), (5, "x"), (5, "X"), (4, "x"), (6, "y"), (6, "y")], "doc_id long, text string")
    assert sorted(r.doc_id for r in exact_dedup.drop_copies(docs).collect()) == [5, 6]
    labels = exact_dedup.duplicate_labels(docs)
    assert labels.count() == 6 and sorted(r.id for r in labels.where("kept").collect()) == [5, 6]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.duplicate_labels(docs).count() == 0
    assert exact_dedup.drop_copies(docs).count() == 0


def test_crowded_filter_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_BLOCKS", 1)  # every bit is seen twice
    docs = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 300).cast("string").alias("text"))
    labels = exact_dedup.duplicate_labels(docs)
    assert labels.where("kept").count() == 300
    assert labels.agg(F.sum("group_size")).first()[0] == 200 * 2 + 200 * 2 + 100


def test_only_possible_copies_shuffle(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.least("id", F.lit(1989))).alias("text"))
    hashed = docs.select(F.col("doc_id").alias("id"), exact_dedup.text_hash(F.col("text")).alias("sha"))
    words, blocks = exact_dedup.seen_twice(hashed, 2000)
    possible = exact_dedup.mark_possible(hashed, words, blocks).where("possible")
    assert 11 <= possible.count() < 100
    assert possible.where("id >= 1989").count() == 11


def test_ties_in_id_and_text_are_resolved_by_the_other_columns(spark):
    rows = [(5, "x", i, None if i % 2 else "s") for i in (4, 2, 9)] + [(1, "X", 0, "s")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, n int, s string").repartition(3)
        assert [tuple(r) for r in exact_dedup.drop_copies(docs).collect()] == [(5, "x", 2, "s")]
