"""Keyed corpus table: changes rewrite only the buckets they hit."""

import os
import re

import pytest
from pyspark.sql import functions as F

from comparo.operators import corpus_ops as C
from comparo.session import shared_path
from comparo.sources import keyed_store as K


def files(path):
    """{bucket: its data files}"""
    out = {}
    for folder, _, names in os.walk(path.removeprefix("file:")):
        if m := re.search(r"id_bucket=(\d+)$", folder):
            out[int(m[1])] = {(n, os.stat(f"{folder}/{n}").st_mtime_ns) for n in names if n.endswith(".parquet")}
    return out


def corpus(spark, n=4000):
    return spark.range(n).select(F.concat(F.lit("d"), "id").alias("id"), (F.col("id") * 2).cast("double").alias("price"),
                                 F.when(F.col("id") % 1000 == 0, None).otherwise(F.lit(5)).alias("length"),
                                 F.concat(F.lit("name"), "id", F.lit(".com")).alias("domain"),
                                 F.lit(".com").alias("tld"), F.lit(True).alias("has_numbers"))


@pytest.fixture
def table(spark):
    return K.create(corpus(spark), shared_path(spark, "keyed"), 64)


def rows(df):
    return sorted(map(tuple, df.select("id", "price", "length").collect()))


def test_an_upsert_rewrites_only_hit_buckets(spark, table):
    before, stored = files(table), rows(K.read(spark, table))
    assert len(before) == 64
    new = corpus(spark).where("id IN ('d7', 'd11')").withColumn("price", F.lit(-1.0)).unionByName(
        corpus(spark).where("id = 'd3'").withColumn("id", F.lit("new")))
    hit = K.upsert_rows(spark, table, new)
    after = files(table)
    assert 1 <= len(hit) <= 3
    assert {b for b in before if before[b] != after[b]} == set(hit)
    want = {r[0]: r for r in stored} | {r[0]: r for r in rows(new)}
    assert rows(K.read(spark, table)) == sorted(want.values())
    once = rows(K.read(spark, table))
    K.upsert_rows(spark, table, new)
    assert rows(K.read(spark, table)) == once


def test_upsert_agrees_with_the_plain_operator(spark, table):
    new = corpus(spark, 6000).where("CAST(substr(id, 2) AS INT) % 3 = 0").withColumn("price", F.lit(9.0))
    want = rows(C.upsert(corpus(spark), new))
    K.upsert_rows(spark, table, new)
    assert rows(K.read(spark, table)) == want


def test_update_changes_named_columns_and_ignores_unknown_ids(spark, table):
    before = files(table)
    changes = spark.createDataFrame([("d5", 1), ("d6", None), ("nowhere", 3)], "id string, length int")
    hit = K.update_rows(spark, table, changes)
    got = {r.id: (r.price, r.length) for r in K.read(spark, table).where("id IN ('d5', 'd6', 'd7', 'nowhere')").collect()}
    assert got == {"d5": (10.0, 1), "d6": (12.0, None), "d7": (14.0, 5)}
    assert {b for b in before if before[b] != files(table)[b]} == set(hit) and len(hit) <= 2
    assert K.update_rows(spark, table, changes.where("id = 'nowhere'")) == []
    with pytest.raises(ValueError):
        K.update_rows(spark, table, changes.withColumnRenamed("length", "size"))


def test_backfill_touches_buckets_with_gaps(spark, table):
    before = files(table)
    hit = K.backfill_rows(spark, table)
    after = files(table)
    assert 1 <= len(hit) <= 4 and {b for b in before if before[b] != after[b]} == set(hit)
    got = K.read(spark, table)
    assert got.where("length IS NULL").count() == 0
    assert got.where("id = 'd1000'").first().length == len("name1000")
    assert K.backfill_rows(spark, table) == []


def test_missing_reads_hit_buckets_only(spark, table):
    some = spark.createDataFrame([("d1",), ("d2",), ("other",)], "id string")
    assert [r.id for r in K.missing(spark, table, some).collect()] == ["other"]
    near, hit, buckets = K.rows_near(spark, table, some)
    assert buckets == 64 and len(hit) <= 3
    scan = near.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and near.select("id").count() < 4000 / 8


def test_missing_moves_ids_and_not_rows(spark, table):
    """Few ids are missing, stored ids are too many to be broadcast: the rows are not shuffled. A null id is not stored."""
    new = corpus(spark, 4003).withColumn("id", F.when(F.col("id") != "d4001", F.col("id")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")
        found = K.missing(spark, table, new)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
        assert sorted(map(str, (r.id for r in found.collect()))) == ["None", "d4000", "d4002"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_empty_changes_and_bucket_counts(spark, table):
    before = files(table)
    assert K.upsert_rows(spark, table, corpus(spark).limit(0)) == [] and files(table) == before
    assert K.bucket_count(0) == 1 and K.bucket_count(10**15) == K.MOST_BUCKETS
    assert K.bucket_count(K.BUCKET_ROWS + 1) == 2


def shuffles_behind(spark, change):
    """Shuffles in the job that writes the table."""
    plans, write = [], K._write
    K._write = lambda dealt, *args: (plans.append(dealt._jdf.queryExecution().executedPlan().toString()), write(dealt, *args))
    try:
        change()
    finally:
        K._write = write
    return plans[0].count("Exchange hashpartitioning")


def test_a_change_moves_rows_once(spark, table):
    """Each side is dealt by bucket, and neither is moved again to find the rows that change, nor to write them."""
    new = corpus(spark, 6000).where("CAST(substr(id, 2) AS INT) % 3 = 0").withColumn("price", F.lit(9.0))
    want = rows(C.upsert(corpus(spark), new))
    changes = corpus(spark, 2000).select("id", F.lit(7).alias("length"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert shuffles_behind(spark, lambda: K.upsert_rows(spark, table, new)) == 3  # stored rows, new ids, new rows
        assert rows(K.read(spark, table)) == want
        assert shuffles_behind(spark, lambda: K.update_rows(spark, table, changes)) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(K.read(spark, table)) == sorted((i, p, 7 if int(i[1:]) < 2000 else n) for i, p, n in want)


def test_a_backfill_moves_no_rows(spark, table):
    """Rows are filled where they are read. Rows without an id are left, and ids that repeat are joined as an update joins them."""
    want = rows(C.backfill_metadata(K.read(spark, table)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert shuffles_behind(spark, lambda: K.backfill_rows(spark, table)) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(K.read(spark, table)) == want and "None" not in {str(r[2]) for r in want}


def test_a_backfill_leaves_rows_without_an_id(spark):
    odd = corpus(spark, 40).withColumn("id", F.when(F.col("id") != "d3", F.col("id"))).withColumn(
        "length", F.when(F.col("id").isNotNull() & (F.col("id") != "d4"), F.col("length")))
    path = K.create(odd, shared_path(spark, "odd_ids"), 4)
    assert K.backfill_rows(spark, path)
    assert [(r.id, r.length) for r in K.read(spark, path).where("length IS NULL").collect()] == [(None, None)]
    assert K.read(spark, path).count() == 40
