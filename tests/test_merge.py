"""Merges: first-wins determinism, insert-only, aggregating and replacing upserts, skew."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import merge


def test_first_wins_is_lowest_order_tuple(spark):
    df = spark.createDataFrame(
        [("a", 3, "z"), ("a", 1, "y"), ("a", 1, "x"), ("b", 2, "q")], "k string, cur long, payload string"
    )
    got = sorted(tuple(r) for r in merge.first_wins(df, ["k"], ["cur", "payload"]).collect())
    assert got == [("a", 1, "x"), ("b", 2, "q")]


def test_first_wins_with_a_hot_key(spark):
    # one key holds a third of all rows; the aggregate combines map-side
    rows = [("hot", i, f"p{i}") for i in range(3000, 0, -1)] + [(f"k{i}", i, "p") for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, cur long, payload string").repartition(8)
    out = merge.first_wins(df, ["k"], ["cur", "payload"])
    assert out.filter(F.col("k") == "hot").collect()[0]["cur"] == 1
    assert out.count() == 6001


def test_insert_only_keeps_existing(spark):
    target = spark.createDataFrame([("a", 1, "old")], "k string, cur long, payload string")
    batch = spark.createDataFrame(
        [("a", 9, "new"), ("b", 5, "b2"), ("b", 4, "b1")], "k string, cur long, payload string"
    )
    inserts = merge.insert_only(batch, target, ["k"], ["cur", "payload"])
    assert sorted(tuple(r) for r in inserts.collect()) == [("b", 4, "b1")]


def test_upsert_aggregate_overwrites_with_null_and_keeps_extremes(spark):
    schema = "k string, attr string, first_seen long, last_seen long"
    target = spark.createDataFrame([("u1", "old", 5, 10), ("u2", "keep", 1, 2)], schema)
    source = spark.createDataFrame([("u1", None, 3, 8), ("u3", "new", 7, 7)], schema)
    out = merge.upsert_aggregate(target, source, "k", ["attr"], ["first_seen"], ["last_seen"])
    assert sorted(tuple(r) for r in out.collect()) == [
        ("u1", None, 3, 10),
        ("u2", "keep", 1, 2),
        ("u3", "new", 7, 7),
    ]


def test_upsert_replace(spark):
    schema = "a string, b long, v double"
    target = spark.createDataFrame([("x", 1, 1.0), ("y", 2, 2.0)], schema)
    source = spark.createDataFrame([("y", 2, 20.0), ("z", 3, 3.0)], schema)
    out = merge.upsert_replace(target, source, ["a", "b"])
    assert sorted(tuple(r) for r in out.collect()) == [("x", 1, 1.0), ("y", 2, 20.0), ("z", 3, 3.0)]


def test_anti_join_reads_only_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    right = spark.createDataFrame([(2, "zzz")], "k long, w string")
    assert [tuple(r) for r in merge.anti_join(left, right, ["k"]).collect()] == [(1, "a")]


def test_insert_only_reduces_the_target_to_colliding_keys(spark, scratch):
    target_path = f"{scratch}/target"
    spark.range(0, 5000).selectExpr("cast(id as string) as k", "id as cur", "'p' as payload").write.parquet(target_path)
    target = spark.read.parquet(target_path)
    batch = spark.createDataFrame([("1", 9, "x"), ("new", 1, "y")], "k string, cur long, payload string")
    inserts = merge.insert_only(batch, target, ["k"], ["cur", "payload"])
    plan = inserts._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "ReadSchema: struct<k:string>" in plan
    assert [tuple(r) for r in inserts.collect()] == [("new", 1, "y")]
