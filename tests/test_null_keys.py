"""Null keys in the keyed sinks: one row per key, also for null, and a null day keeps its totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickscope.runtime import scratch_path
from clickscope.sinks import ops
from clickscope.sinks.deltas import DeltaTable


def test_null_key_is_replaced_once(spark):
    old = spark.createDataFrame([(None, 1), (2, 5)], "ad_id long, click_count long")
    new = spark.createDataFrame([(None, 7)], "ad_id long, click_count long")
    for op in (ops.upsert_replace, ops.replace_group):
        assert {tuple(r) for r in op(old, new, ["ad_id"]).collect()} == {(None, 7), (2, 5)}


def test_blacklist_lists_a_null_user_once(spark):
    old = spark.createDataFrame([(None,), (1,)], "user_id long")
    got = ops.blacklist_insert(old, spark.createDataFrame([(None,), (2,)], "user_id long"))
    assert sorted((r[0] or 0) for r in got.collect()) == [0, 1, 2]


def test_null_day_adds_up(spark):
    schema = spark.createDataFrame([], "date_key string, click_count long").schema
    table = DeltaTable(spark, scratch_path(spark, "null-day"), schema, "add", ["date_key"], F.col("date_key"))
    for batch in (0, 1):
        delta = spark.createDataFrame([(None, 1), ("2024-01-01", 2)], schema)
        table.write(batch, delta)
        assert {tuple(r) for r in table.touched(delta, ["date_key"], table.span(delta)).collect()} == {
            (None, batch + 1), ("2024-01-01", 2 * batch + 2)}
    assert {tuple(r) for r in table.read().collect()} == {(None, 2), ("2024-01-01", 4)}


def test_null_keys_in_tables_that_replace(spark):
    schema = spark.createDataFrame([], "ad_id long, click_count long").schema
    for kind in ("replace", "group"):
        table = DeltaTable(spark, scratch_path(spark, f"null-{kind}"), schema, kind, ["ad_id"])
        table.write(1, spark.createDataFrame([(None, 1), (2, 5)], schema))
        table.write(2, spark.createDataFrame([(None, 7)], schema))
        assert {tuple(r) for r in table.read().collect()} == {(None, 7), (2, 5)}
