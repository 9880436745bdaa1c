"""Landing files and the partitioned, bucketed ORC sink."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.sources import (
    TICKET_RAW_SCHEMA,
    drop_table,
    TRIP_RAW_SCHEMA,
    load_table,
    normalise_names,
    read_delimited,
    read_inferred,
    table_location,
    write_delimited,
)

SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("amount", T.DoubleType()),
    ]
)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_csv_declared_schema_malformed_blank_quoted(spark, tmp_path):
    path = str(tmp_path / "landing" / "part-0.csv")
    _write(path, 'id,name,amount\n1,"Smith, J",2.5\n2,plain,oops\n\n3,x,4\n')
    df = read_delimited(spark, os.path.dirname(path), SCHEMA)
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [(1, "Smith, J", 2.5), (2, "plain", None), (3, "x", 4.0)]


def test_csv_reordered_header_is_refused(spark, tmp_path):
    path = str(tmp_path / "landing2" / "part-0.csv")
    _write(path, "name,id,amount\nx,1,2.0\n")
    with pytest.raises(Exception):
        read_delimited(spark, os.path.dirname(path), SCHEMA).collect()
    # Without the check the columns bind by position and go silently wrong.
    loose = read_delimited(spark, os.path.dirname(path), SCHEMA, check_header=False).first()
    assert loose.id is None


def test_csv_round_trip_keeps_microseconds(spark, tmp_shared):
    ts = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([(1, ts, "0143A")], "id long, ts timestamp_ntz, t string")
    _, path = table_location(spark, "rt")
    write_delimited(df, path)
    back = read_delimited(spark, path, df.schema).first()
    assert back.ts == ts and back.t == "0143A"
    inferred = read_inferred(spark, path)
    assert inferred.columns == ["id", "ts", "t"]


def test_normalise_names():
    names = [f.name.replace(" ", "") for f in TICKET_RAW_SCHEMA.fields]
    assert names[0] == "SummonsNumber" and names[-1] == "ViolationTime"
    assert len(TRIP_RAW_SCHEMA.fields) == 17


def test_normalise_names_on_frame(spark):
    df = spark.createDataFrame([(1, "x")], "`Summons Number` long, `Plate ID` string")
    assert normalise_names(df).columns == ["SummonsNumber", "PlateID"]


def test_load_table_layout_and_dynamic_overwrite(spark):
    # The session default must not matter: a static default would wipe
    # the untouched partitions on reload.
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        _check_load_table(spark)
    finally:
        spark.conf.set(key, before)
    assert spark.conf.get(key) == before


def _check_load_table(spark):
    rows = [
        (1, dt.date(2017, 11, d), 11, float(d)) for d in range(1, 11)
    ] + [(2, dt.date(2017, 12, d), 12, float(d)) for d in range(1, 6)]
    df = spark.createDataFrame(rows, "id int, date date, month int, v double")
    name, path = table_location(spark, "layout")
    out = load_table(df, name, path, partition_by="month", bucket_by="date", buckets=5)
    assert out.count() == 15
    assert out.columns[-1] == "month"
    parts = sorted(os.path.basename(p) for p in glob.glob(os.path.join(path.replace("file:", ""), "month=*")))
    assert parts == ["month=11", "month=12"]
    files = glob.glob(os.path.join(path.replace("file:", ""), "month=11", "*.orc"))
    assert files and all("snappy" in f for f in files)
    buckets = {os.path.basename(f).split("_")[-1].split(".")[0] for f in files}
    assert len(buckets) <= 5
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED `{name}`").collect()
    info = {r.col_name: r.data_type for r in detail}
    assert "5 buckets" in info.get("Num Buckets", "") or info.get("Num Buckets") == "5"
    # Re-loading only December leaves November as it was.
    dec = spark.createDataFrame([(3, dt.date(2017, 12, 31), 12, 9.0)], "id int, date date, month int, v double")
    out = load_table(dec, name, path, partition_by="month", bucket_by="date", buckets=5)
    counts = {r.month: r["count"] for r in out.groupBy("month").count().collect()}
    assert counts == {11: 10, 12: 1}
    # Partition pruning reaches the scan.
    plan = out.filter("month = 11")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan
    # Dropping the (external) table keeps its files; dropping twice is fine.
    drop_table(spark, name)
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
    assert spark.read.orc(path).count() == 11


def test_catalog_statistics_match_profile(spark):
    from tallyframe.operators import column_profile
    from tallyframe.sources import column_statistics

    rows = [(1, dt.date(2017, 11, d % 28 + 1), 11, float(d % 7), "ab"[d % 2]) for d in range(40)]
    df = spark.createDataFrame(rows, "id int, date date, month int, v double, s string")
    name, path = table_location(spark, "stats")
    load_table(df, name, path, partition_by="month", bucket_by="date", buckets=5, analyze=True)
    stats = {r.column_name: r for r in column_statistics(spark, name, ["v", "s"]).collect()}
    prof = {r.column_name: r for r in column_profile(df.select("v", "s")).collect()}
    assert stats["v"].min == "0.0" and stats["v"].max == "6.0" and stats["v"].num_nulls == "0"
    assert int(stats["v"].distinct_count) == prof["v"].distinct_count == 7
    assert int(stats["s"].max_col_len) == 1


def test_malformed_cells_are_counted(spark, tmp_path):
    from tallyframe.sources import malformed_rows

    path = str(tmp_path / "bad" / "part-0.csv")
    _write(path, 'id,name,amount\n1,"Smith, J",2.5\n2,plain,oops\nx,y,1\n3,x,4\n')
    assert tuple(malformed_rows(spark, path, SCHEMA).first()) == (4, 2)


def test_a_table_of_another_shape_or_place_is_refused(spark):
    df = spark.createDataFrame([(1, dt.date(2017, 11, 1), 11)], "id int, date date, month int")
    name, path = table_location(spark, "checked")
    load_table(df, name, path, partition_by="month", bucket_by="date", buckets=2)
    with pytest.raises(ValueError, match="columns"):
        load_table(df.withColumnRenamed("id", "other"), name, path, partition_by="month", bucket_by="date", buckets=2)
    with pytest.raises(ValueError, match="is at"):
        load_table(df, name, f"{path}_elsewhere", partition_by="month", bucket_by="date", buckets=2)
    drop_table(spark, name)


def test_shared_folder_must_be_named_on_a_cluster():
    from types import SimpleNamespace

    from tallyframe.session import shared_dir

    conf = SimpleNamespace(get=lambda key, default=None: default)
    sc = SimpleNamespace(master="yarn", applicationId="a", getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(SimpleNamespace(sparkContext=sc))
    sc.getCheckpointDir = lambda: "hdfs:///shared/x/"
    assert shared_dir(SimpleNamespace(sparkContext=sc)) == "hdfs:///shared/x"


def test_catalog_histograms_are_rows(spark):
    from tallyframe.sources import column_histograms, column_statistics, gather_statistics, save_table

    df = spark.range(0, 1000).select(F.col("id").cast("int").alias("i"), (F.col("id") % 10).cast("double").alias("v"), F.lit("t").alias("s"))
    name, path = table_location(spark, "histograms")
    save_table(df, name, path)
    before = spark.conf.get("spark.sql.statistics.histogram.enabled")
    gather_statistics(spark, name, histogram_bins=10)
    assert spark.conf.get("spark.sql.statistics.histogram.enabled") == before
    bins = column_histograms(spark, name).collect()
    of = {c: sorted((r.bin, r.lower, r.upper) for r in bins if r.column_name == c) for c in "ivs"}
    assert len(of["i"]) == 10 and of["i"][0][1] == 0.0 and of["i"][-1][2] == 999.0 and of["s"] == []
    assert all(r.height == 100.0 for r in bins)
    assert all(a[2] == b[1] for a, b in zip(of["i"], of["i"][1:], strict=False))
    got = {r.column_name: r for r in column_statistics(spark, name).collect()}
    assert got["i"].max == "999" and got["s"].min is None and got["s"].avg_col_len == "1"


def test_statistics_change_the_join_order(spark):
    """Three joined tables of like size on disk: with statistics the
    optimiser starts with the join that leaves fewest rows."""
    from tallyframe.sources import gather_statistics, save_table

    fact = spark.range(0, 20_000).select((F.col("id") % 100).alias("a"), (F.col("id") % 4000).alias("b"), F.col("id").alias("f"))
    wide = spark.range(0, 4_000).select((F.col("id") % 100).alias("a"), F.col("id").alias("w"))
    narrow = spark.range(0, 40).select(F.col("id").alias("b"), (F.col("id") + 1).alias("n"))
    names = []
    for df, name in ((fact, "join_fact"), (wide, "join_wide"), (narrow, "join_narrow")):
        table, path = table_location(spark, name)
        save_table(df, table, path)
        names.append(table)
    conf = {"spark.sql.cbo.enabled": "true", "spark.sql.cbo.joinReorder.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}

    def first_join():
        f, w, n = (spark.table(t) for t in names)
        plan = f.join(w, "a").join(n, "b").select("f", "w", "n")._jdf.queryExecution().optimizedPlan().toString()
        # The deepest join stands last; what is joined in it are the last two relations.
        relations = [line for line in plan.splitlines() if "Relation" in line]
        return {next(c for c in ("f#", "w#", "n#") if c in line) for line in sorted(relations, key=lambda x: -len(x[: x.index("Relation")]))[:2]}

    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert first_join() == {"f#", "w#"}
        for name in names:
            gather_statistics(spark, name)
        assert first_join() == {"f#", "n#"}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rejects_are_found_and_the_rest_is_untouched(spark, tmp_path):
    from tallyframe.sources import read_with_rejects

    path = str(tmp_path / "bad" / "part-0.csv")
    lines = ['1,"Smith, J",2.5', "2,plain,oops", "x,y,1", "3,x", "4,x,5,6", "x,a,b", "5,,", '6,"say \\"hi\\"",1e3', "9999999999,big,1"]
    _write(path, "id,name,amount\n" + "\n".join(lines) + "\n")
    rows, rejects = read_with_rejects(spark, path, SCHEMA)
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "Smith, J", 2.5), (5, None, None), (6, 'say "hi"', 1000.0)]
    got = {r.line: (r.bad_columns, r.reason) for r in rejects.collect()}
    assert got == {
        "2,plain,oops": (["amount"], "amount"), "x,y,1": (["id"], "id"), "3,x": ([], "cells"), "4,x,5,6": ([], "cells"),
        "x,a,b": (["id", "amount"], "id amount"), "9999999999,big,1": (["id"], "id"),
    }
    assert rows.count() + rejects.count() == len(lines)
    assert rejects.select("reason").distinct().count() == 4 and rows.select("id").count() == 3
