"""Sessions without lists, sample by histogram, semi join behind a bitmap, page links across ranges."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from clickscope.operators import category as CAT
from clickscope.operators import funnel as FUN
from clickscope.operators import session as S
from clickscope.params import DEFAULT_PARAMS, KEYWORD_PARAMS, PROFILE_PARAMS, TaskParams
from clickscope.plans import catalog as K
from tests.conftest import SF_SMALL, rows_of


def _plan(df, adaptive=False):
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", str(adaptive).lower())
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("params", [TaskParams(), DEFAULT_PARAMS, KEYWORD_PARAMS, PROFILE_PARAMS, TaskParams(keywords=("", "kw1,kw2")),
                                    TaskParams(category_ids=("x", "-1", "3"))])
def test_passing_sessions_equal_the_filter_over_lists(spark, params):
    t = K.fixtures(spark, SF_SMALL)
    columns = ["session_id", "user_id", "visit_length", "step_length", "start_time", *S.USER_COLUMNS]
    actions = K.actions_in_range(t)
    # keywords with commas, and empty ones
    actions = actions.withColumn("search_keyword", F.when(F.col("page_id") % 3 == 0, F.concat(F.col("search_keyword"), F.lit(",x")))
                                 .when(F.col("page_id") % 3 == 1, F.lit("")).otherwise(F.col("search_keyword")))
    want = S.session_filter(S.session_full_info(S.session_summary(actions), t.users), params)
    assert rows_of(S.session_passing(actions, t.users, params).select(*columns)) == rows_of(want.select(*columns))


def test_statistics_build_no_lists(spark):
    for key in ("session_aggr_stat", "session_aggr_stat_keywords", "session_aggr_stat_profile", "session_filtered_actions"):
        assert "collect_set" not in _plan(K.QUERIES[key](spark, SF_SMALL)), key


@pytest.mark.parametrize("total,seed", [(0, "0"), (1, "0"), (30, "7"), (150, "x"), (10_000, "0")])
def test_sample_equals_ranking_whole_hours(spark, total, seed):
    """One hour holds most sessions; equal starts, a null session and a null start among them."""
    rng = random.Random(total)
    rows = [(f"hot{i}", "2024-01-01 05:00:00") for i in range(400)]
    rows += [(f"s{i}", f"2024-01-0{rng.randint(1, 3)} {rng.randint(0, 23):02d}:10:00") for i in range(200)] + [("lost", None)]
    df = spark.createDataFrame(rows, "session_id string, start_time string").repartition(5)
    hours, days = {}, {}
    for sid, start in rows:
        if start:
            hours.setdefault((start[:10], start[11:13]), []).append(sid)
            days[start[:10]] = days.get(start[:10], 0) + 1
    want = []
    for (date, _), ids in hours.items():
        quota = min(len(ids), len(ids) * (total // len(days)) // days[date])
        want += sorted(ids, key=lambda x: hashlib.md5((x + seed).encode()).hexdigest())[:quota]
    assert sorted(r["session_id"] for r in S.session_sample(df, total, seed).collect()) == sorted(want)


def test_sample_ranks_only_what_the_histogram_lets_through(spark):
    """Of 20,000 sessions in an hour, the filter before the ranking passes the quota and what shares its last bin."""
    df = spark.range(20_000).select(F.col("id").cast("string").alias("session_id"),
                                    F.concat(F.lit("2024-01-01 05:00:0"), F.col("id") % 10).alias("start_time"))
    got = S.session_sample(df, 50)
    ids = sorted((hashlib.md5((str(i) + "0").encode()).hexdigest(), str(i)) for i in range(20_000))
    assert sorted(r["session_id"] for r in got.collect()) == sorted(i for _, i in ids[:50])
    node = got._jdf.queryExecution().executedPlan().toString()
    assert "_cut" in node and node.index("row_number") < node.index("BroadcastHashJoin")
    near = sum(1 for h, _ in ids if h[:4] <= ids[49][0][:4])
    assert near < 55


@pytest.mark.parametrize("bits", [1, 32768, 40_000, 1 << 20])
def test_bitmap_lets_every_kept_session_through(spark, bits):
    ids = [f"s{i}" for i in range(500)] + [None]
    actions = spark.createDataFrame([(s, i) for i, s in enumerate(ids * 2)], "session_id string, page_id long")
    kept = spark.createDataFrame([(s,) for s in ids[::5]], "session_id string")
    found = S.maybe_in(actions, S.session_bitmap(kept, bits), bits)
    inside = {r["session_id"] for r in found.collect()}
    assert found.columns == actions.columns and inside >= set(ids[::5])
    if bits == 1 << 20:
        assert len(inside) < 110
    assert S.session_bitmap(kept, bits).count() <= -(-bits // 32768)


def test_plan_prunes_before_the_shuffle_and_splits_a_hot_session(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        actions = spark.range(0, 60_000, numPartitions=4).select(
            F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 1000)).alias("session_id"),
            (F.col("id") % 9).alias("page_id"))
        kept = actions.groupBy("session_id").agg(F.count(F.lit(1)).alias("n")).where("n > 10")
        out = S.session_filtered_actions(actions, kept)
        assert out.count() == 60_000
        out.collect()
        final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in final and "bitmap_construct_agg" in final
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_matrix_of_kept_sessions_equals_counting_their_actions(spark):
    t = K.fixtures(spark, SF_SMALL)
    actions, kept = K.actions_in_range(t), K.passing(t)
    got = CAT.category_session_matrix(actions, kept).select("category_id", "session_id", "click_count", "order_count", "pay_count")
    want = CAT.category_session_matrix(S.session_filtered_actions(actions, kept)).select(*got.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_one_session_within_one_second_fills_many_tasks(spark, parts):
    rows = [("hot", "2024-01-01 10:00:00", i % 7, i) for i in range(300)] + [("hot", None, 3, 900 + i) for i in range(3)]
    rows += [(f"c{i}", "2024-01-01 10:00:00", i % 5, 1000 + i) for i in range(20)] + [(None, "2024-01-01 10:00:01", 2, i) for i in range(5)]
    rows += [("tail", "2024-01-02 00:00:00", None if i % 2 else i, 2000 + i) for i in range(9)]
    a = spark.createDataFrame(rows, "session_id string, action_time string, page_id long, event_id long").repartition(3)
    got = FUN.page_transitions(a, parts)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((tuple(r) for r in FUN.page_transitions_window(a).collect()), key=key)
    if parts == 40:
        keys = ["session_id", "t", "tie"]
        spread = (FUN._ordered(a).repartitionByRange(parts, *keys).where("session_id = 'hot'")
                  .groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect())
        assert len(spread) > 10 and max(r["n"] for r in spread) < 60
