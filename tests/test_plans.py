"""Plan checks: pushdown, pruning, partial aggregation, group limits, no row-at-a-time Python."""

import pytest

import __spark_entry__ as E
from clickscope.operators import category as CAT
from clickscope.sources import tables as SRC
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def action_table(spark, tmp_path_factory):
    """The fixture actions written as a date-partitioned parquet table (production layout)."""
    from clickscope.plans.catalog import fixtures
    path = str(tmp_path_factory.mktemp("uva") / "user_visit_action")
    fixtures(spark, SF_SMALL).actions.write.partitionBy("date").parquet(path)
    return spark.read.parquet(path)


def test_date_range_prunes_partitions_and_columns(spark, action_table):
    df = SRC.city_click_products(action_table, "2024-01-03", "2024-01-05")
    p = plan(df)
    assert "PartitionFilters" in p and "2024-01-03" in p
    assert "PushedFilters: [IsNotNull(click_product_id), Not(EqualTo(click_product_id,-1))]" in p
    assert "ReadSchema: struct<click_product_id:bigint,city_id:bigint>" in p


def test_no_python_udf_outside_funnel(spark):
    qs = E.queries()
    for name in ["session_summary", "session_aggr_stat", "top10_category", "area_top3_product",
                 "ad_province_top3", "ad_recent_hour", "scalar_functions"]:
        p = plan(qs[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_topn_uses_group_limit_and_take_ordered(spark):
    qs = E.queries()
    assert "TakeOrderedAndProject" in plan(qs["top10_category"](spark, SF_SMALL))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ["top10_active_session", "area_top3_product", "ad_province_top3"]:
            assert "WindowGroupLimit" in plan(qs[name](spark, SF_SMALL)), name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_single_pass_category_counts(spark):
    from clickscope.plans.catalog import filtered_actions, fixtures
    df = CAT.category_full_count(filtered_actions(fixtures(spark, SF_SMALL)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "partial_count" in p
    assert "SortMergeJoin(" not in p.split("Generate")[0]  # no join above the explode


def test_no_cross_products_or_row_udfs_anywhere(spark):
    bad = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]
    from clickscope.plans.catalog import QUERIES
    for name, fn in QUERIES.items():
        if name.startswith(("stream_", "sink_")):
            continue  # their batches run when the query is built; what is returned reads the tables
        p = plan(fn(spark, SF_SMALL))
        assert not [b for b in bad if b in p], name


def test_session_rollup_is_partially_aggregated(spark):
    p = plan(E.queries()["session_summary"](spark, SF_SMALL))
    assert "partial_collect_set" in p and "partial_min" in p


def test_hot_user_join_is_split_by_aqe(spark):
    """A user owning most sessions: AQE's skew join splits that partition of the user join."""
    from pyspark.sql import functions as F
    from clickscope.operators import session as S
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        summ = spark.range(0, 100000, numPartitions=4).select(
            F.concat(F.lit("s"), F.col("id").cast("string")).alias("session_id"),
            F.when(F.col("id") % 3 != 0, F.lit(7)).otherwise(F.col("id") % 1000).cast("bigint").alias("user_id"),
            F.lit(None).cast("string").alias("search_keywords"),
            F.lit(None).cast("string").alias("click_category_ids"),
            F.lit(1).cast("bigint").alias("visit_length"), F.lit(1).cast("bigint").alias("step_length"),
            F.lit("t").alias("start_time"))
        users = spark.range(0, 1000).select(F.col("id").alias("user_id"), F.lit(30).alias("age"),
                                            F.lit("p").alias("professional"), F.lit("male").alias("sex"),
                                            F.lit("c").alias("city"))
        out = S.session_full_info(summ, users)
        assert out.count() == 100000
        out.collect()
        final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_user_blacklist_anti_join_is_split_by_aqe(spark):
    """A user with most ad clicks: with the blacklist read from a table, AQE splits the anti join."""
    from pyspark.sql import functions as F
    from clickscope.operators import ads as ADS
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        clicks = spark.range(0, 100000, numPartitions=4).select(
            F.when(F.col("id") % 3 != 0, F.lit(7)).otherwise(F.col("id") % 1000).cast("bigint").alias("user_id"),
            (F.col("id") % 20).alias("ad_id"))
        black = spark.range(500, 1000).select(F.col("id").alias("user_id"))
        out = ADS.ad_blacklist_filter(clicks, black)
        assert out.count() == 83333
        out.collect()
        final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
