"""Registry of runnable queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry wires the fixture tables of one scale-factor folder into the operators with the
default task parameters. Nothing here triggers an action except the streaming and sink
entries, which must run their micro-batches before the resulting table can be read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.functions import columns as C
from clickscope.operators import ads as ADS
from clickscope.operators import area as AREA
from clickscope.operators import category as CAT
from clickscope.operators import funnel as FUN
from clickscope.operators import session as S
from clickscope.params import DEFAULT_PARAMS, KEYWORD_PARAMS, PROFILE_PARAMS, TaskParams
from clickscope.runtime import scratch_path, use_utc
from clickscope.sinks import ops as SINK
from clickscope.sinks.deltas import DeltaTable
from clickscope.sources import tables as SRC
from clickscope.sources.fixtures import FixtureTables, damaged_ad_log_lines
from clickscope.streaming import ad_stream as ST
from clickscope.streaming.ad_stream import StreamConfig

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def fixtures(spark: SparkSession, sf_dir: str) -> FixtureTables:
    use_utc(spark)
    return FixtureTables(spark, sf_dir)


# ---- session program -------------------------------------------------------------------

def actions_in_range(t: FixtureTables, p: TaskParams = DEFAULT_PARAMS) -> DataFrame:
    return SRC.visit_actions(t.actions, p.start_date, p.end_date)


def summary(t: FixtureTables, p: TaskParams = DEFAULT_PARAMS) -> DataFrame:
    return S.session_summary(actions_in_range(t, p))


def full_info(t: FixtureTables, p: TaskParams = DEFAULT_PARAMS) -> DataFrame:
    return S.session_full_info(summary(t, p), t.users)


def filtered(t: FixtureTables, p: TaskParams = DEFAULT_PARAMS) -> DataFrame:
    return S.session_filter(full_info(t, p), p)


def passing(t: FixtureTables, p: TaskParams = DEFAULT_PARAMS) -> DataFrame:
    """The same sessions as filtered(), without their lists."""
    return S.session_passing(actions_in_range(t, p), t.users, p)


@query("visit_actions")
def q_visit_actions(spark, sf_dir):
    return actions_in_range(fixtures(spark, sf_dir))


@query("session_summary")
def q_session_summary(spark, sf_dir):
    return summary(fixtures(spark, sf_dir))


@query("session_full_info")
def q_session_full_info(spark, sf_dir):
    return full_info(fixtures(spark, sf_dir))


@query("session_filter")
def q_session_filter(spark, sf_dir):
    return filtered(fixtures(spark, sf_dir))


@query("session_filter_keywords")
def q_session_filter_keywords(spark, sf_dir):
    return filtered(fixtures(spark, sf_dir), KEYWORD_PARAMS)


@query("session_filter_profile")
def q_session_filter_profile(spark, sf_dir):
    return filtered(fixtures(spark, sf_dir), PROFILE_PARAMS)


@query("session_aggr_stat")
def q_session_aggr_stat(spark, sf_dir):
    return S.session_aggr_stat(passing(fixtures(spark, sf_dir)))


@query("session_aggr_stat_keywords")
def q_session_aggr_stat_keywords(spark, sf_dir):
    return S.session_aggr_stat(passing(fixtures(spark, sf_dir), KEYWORD_PARAMS))


@query("session_aggr_stat_profile")
def q_session_aggr_stat_profile(spark, sf_dir):
    return S.session_aggr_stat(passing(fixtures(spark, sf_dir), PROFILE_PARAMS))


@query("session_hour_counts")
def q_session_hour_counts(spark, sf_dir):
    return S.session_hour_counts(passing(fixtures(spark, sf_dir)))


@query("session_sample_quotas")
def q_session_sample_quotas(spark, sf_dir):
    return S.sample_quotas(passing(fixtures(spark, sf_dir)))


def sample(t: FixtureTables, total: int = 100) -> DataFrame:
    return S.session_random_extract(passing(t), total, actions=actions_in_range(t))


@query("session_random_extract")
def q_session_random_extract(spark, sf_dir):
    return sample(fixtures(spark, sf_dir))


@query("session_extract_detail")
def q_session_extract_detail(spark, sf_dir):
    t = fixtures(spark, sf_dir)
    return S.session_extract_detail(S.session_sample(passing(t)), actions_in_range(t))


# Large enough that most hours of the generated data have a quota.
LARGE_SAMPLE = 700


@query("session_random_extract_large")
def q_session_random_extract_large(spark, sf_dir):
    return sample(fixtures(spark, sf_dir), LARGE_SAMPLE)


@query("session_extract_detail_large")
def q_session_extract_detail_large(spark, sf_dir):
    t = fixtures(spark, sf_dir)
    return S.session_extract_detail(S.session_sample(passing(t), LARGE_SAMPLE), actions_in_range(t))


@query("session_filtered_actions")
def q_session_filtered_actions(spark, sf_dir):
    return filtered_actions(fixtures(spark, sf_dir))


def filtered_actions(t: FixtureTables, p: TaskParams = DEFAULT_PARAMS) -> DataFrame:
    return S.session_filtered_actions(actions_in_range(t, p), passing(t, p))


# ---- categories ------------------------------------------------------------------------

def category_matrix(t: FixtureTables) -> DataFrame:
    return CAT.category_session_matrix(actions_in_range(t), passing(t))


@query("category_universe")
def q_category_universe(spark, sf_dir):
    return category_matrix(fixtures(spark, sf_dir)).select("category_id").distinct()


@query("category_click_count")
def q_category_click_count(spark, sf_dir):
    return CAT.single_count_from_matrix(category_matrix(fixtures(spark, sf_dir)), "click_count")


@query("category_order_count")
def q_category_order_count(spark, sf_dir):
    return CAT.single_count_from_matrix(category_matrix(fixtures(spark, sf_dir)), "order_count")


@query("category_pay_count")
def q_category_pay_count(spark, sf_dir):
    return CAT.single_count_from_matrix(category_matrix(fixtures(spark, sf_dir)), "pay_count")


@query("category_full_count")
def q_category_full_count(spark, sf_dir):
    return CAT.full_count_from_matrix(category_matrix(fixtures(spark, sf_dir)))


def top_categories(t: FixtureTables) -> DataFrame:
    return CAT.top10_category(CAT.full_count_from_matrix(category_matrix(t)))


@query("top10_category")
def q_top10_category(spark, sf_dir):
    return top_categories(fixtures(spark, sf_dir))


@query("category_session_count")
def q_category_session_count(spark, sf_dir):
    t = fixtures(spark, sf_dir)
    return CAT.session_count_from_matrix(category_matrix(t), top_categories(t))


@query("top10_active_session")
def q_top10_active_session(spark, sf_dir):
    t = fixtures(spark, sf_dir)
    return CAT.top10_active_session(CAT.session_count_from_matrix(category_matrix(t), top_categories(t)))


@query("category_session_count_direct")
def q_category_session_count_direct(spark, sf_dir):
    """The same counts computed directly from the actions (cross-check of the matrix form)."""
    t = fixtures(spark, sf_dir)
    return CAT.category_session_count(filtered_actions(t), top_categories(t))


# ---- page funnel -----------------------------------------------------------------------

@query("page_transitions")
def q_page_transitions(spark, sf_dir):
    return FUN.page_transitions(actions_in_range(fixtures(spark, sf_dir)))


@query("page_transitions_window")
def q_page_transitions_window(spark, sf_dir):
    return FUN.page_transitions_window(actions_in_range(fixtures(spark, sf_dir)))


@query("page_split_count")
def q_page_split_count(spark, sf_dir):
    a = actions_in_range(fixtures(spark, sf_dir))
    return FUN.page_split_count(FUN.page_transitions(a),
                                FUN.target_path(spark, DEFAULT_PARAMS.target_page_flow))


@query("start_page_count")
def q_start_page_count(spark, sf_dir):
    return FUN.start_page_count(actions_in_range(fixtures(spark, sf_dir)),
                                DEFAULT_PARAMS.target_page_flow[0])


@query("page_convert_rate")
def q_page_convert_rate(spark, sf_dir):
    return FUN.page_convert_rate(actions_in_range(fixtures(spark, sf_dir)),
                                 DEFAULT_PARAMS.target_page_flow)


@query("page_convert_rate_string")
def q_page_convert_rate_string(spark, sf_dir):
    return FUN.page_convert_rate_string(FUN.page_convert_rate(
        actions_in_range(fixtures(spark, sf_dir)), DEFAULT_PARAMS.target_page_flow))


# ---- area top products -----------------------------------------------------------------

def clicks(t: FixtureTables, p: TaskParams = DEFAULT_PARAMS) -> DataFrame:
    return SRC.city_click_products(t.actions, p.start_date, p.end_date)


def area_basic(t: FixtureTables) -> DataFrame:
    return AREA.area_click_basic(clicks(t), SRC.city_area(t.spark))


def area_info(t: FixtureTables) -> DataFrame:
    return AREA.area_product_info(AREA.area_product_click_count(area_basic(t)), t.products)


@query("city_click_products")
def q_city_click_products(spark, sf_dir):
    return clicks(fixtures(spark, sf_dir))


@query("area_click_basic")
def q_area_click_basic(spark, sf_dir):
    return area_basic(fixtures(spark, sf_dir))


@query("area_product_click_count")
def q_area_product_click_count(spark, sf_dir):
    return AREA.area_product_click_count(area_basic(fixtures(spark, sf_dir)))


@query("area_product_info")
def q_area_product_info(spark, sf_dir):
    return area_info(fixtures(spark, sf_dir))


@query("area_top3_product")
def q_area_top3_product(spark, sf_dir):
    return AREA.area_top3_product(area_info(fixtures(spark, sf_dir)))


@query("group_concat_distinct")
def q_group_concat_distinct(spark, sf_dir):
    basic = area_basic(fixtures(spark, sf_dir))
    return basic.groupBy("area").agg(
        C.group_concat_distinct(C.concat_long_string("city_id", "city_name", ":")).alias("city_infos"))


# ---- ad clicks (batch form) ------------------------------------------------------------

# Fixture threshold: the generated data holds at most a handful of clicks per (user, ad, day).
FIXTURE_BLACKLIST_THRESHOLD = 1


def ad_parsed(t: FixtureTables) -> DataFrame:
    return ADS.ad_log_parse(t.ad_lines)


def ad_filtered(t: FixtureTables) -> DataFrame:
    return ADS.ad_blacklist_filter(ad_parsed(t), t.blacklist)


@query("ad_log_parse")
def q_ad_log_parse(spark, sf_dir):
    return ad_parsed(fixtures(spark, sf_dir))


@query("ad_blacklist_filter")
def q_ad_blacklist_filter(spark, sf_dir):
    return ad_filtered(fixtures(spark, sf_dir))


@query("ad_user_click_count")
def q_ad_user_click_count(spark, sf_dir):
    return ADS.ad_user_click_count(ad_filtered(fixtures(spark, sf_dir)))


@query("ad_blacklist")
def q_ad_blacklist(spark, sf_dir):
    return ADS.ad_blacklist(ADS.ad_user_click_count(ad_filtered(fixtures(spark, sf_dir))),
                            FIXTURE_BLACKLIST_THRESHOLD)


@query("ad_stat")
def q_ad_stat(spark, sf_dir):
    return ADS.ad_stat(ad_filtered(fixtures(spark, sf_dir)))


@query("ad_province_count")
def q_ad_province_count(spark, sf_dir):
    return ADS.ad_province_count(ADS.ad_stat(ad_filtered(fixtures(spark, sf_dir))))


@query("ad_province_top3")
def q_ad_province_top3(spark, sf_dir):
    return ADS.ad_province_top3(ADS.ad_province_count(ADS.ad_stat(ad_filtered(fixtures(spark, sf_dir)))))


@query("ad_click_trend")
def q_ad_click_trend(spark, sf_dir):
    return ADS.ad_click_trend(ad_filtered(fixtures(spark, sf_dir)))


@query("ad_recent_hour")
def q_ad_recent_hour(spark, sf_dir):
    return ADS.ad_recent_hour(ad_filtered(fixtures(spark, sf_dir)))


# ---- ad lines that do not parse ------------------------------------------------------------

def damaged_lines(t: FixtureTables) -> DataFrame:
    """The fixture's ad lines, some cut short, some with a word for a number, some empty."""
    return damaged_ad_log_lines(t.raw("events"))


@query("ad_dead_letters")
def q_ad_dead_letters(spark, sf_dir):
    return ADS.ad_dead_letters(ADS.ad_log_checked(damaged_lines(fixtures(spark, sf_dir))))


@query("ad_stat_damaged")
def q_ad_stat_damaged(spark, sf_dir):
    t = fixtures(spark, sf_dir)
    return ADS.ad_stat(ADS.ad_blacklist_filter(ADS.ad_parsed(ADS.ad_log_checked(damaged_lines(t))), t.blacklist))


@query("stream_ad_dead_letters")
def q_stream_ad_dead_letters(spark, sf_dir):
    """The damaged lines as text files, replayed by the stream: one pass writes the totals and the dead letters."""
    t = fixtures(spark, sf_dir)
    root = ST.fresh_root(spark, "stream_dead_letters")
    damaged_lines(t).write.text(f"{root}/in")
    ST.run_ad_stat(spark, StreamConfig(source_dir=f"{root}/in", text_lines=True), f"{root}/out", blacklist=t.blacklist)
    return ST.read_table(spark, f"{root}/out", "dead_letters")


# ---- ad clicks (Structured Streaming replay; read back the sink tables) ------------------

def _stream_cfg(sf_dir: str):
    return StreamConfig(source_dir=sf_dir)


@query("stream_ad_blacklist")
def q_stream_ad_blacklist(spark, sf_dir):
    t = fixtures(spark, sf_dir)
    root = ST.fresh_root(spark, "stream_blacklist")
    ST.run_blacklist(spark, _stream_cfg(sf_dir), root, seed=t.blacklist,
                     threshold=FIXTURE_BLACKLIST_THRESHOLD)
    return ST.read_table(spark, root, "blacklist")


@query("stream_ad_user_click_count")
def q_stream_ad_user_click_count(spark, sf_dir):
    t = fixtures(spark, sf_dir)
    root = ST.fresh_root(spark, "stream_user_counts")
    ST.run_blacklist(spark, _stream_cfg(sf_dir), root, seed=t.blacklist,
                     threshold=FIXTURE_BLACKLIST_THRESHOLD)
    return ST.read_table(spark, root, "user_click_count")


@query("stream_ad_stat")
def q_stream_ad_stat(spark, sf_dir):
    t = fixtures(spark, sf_dir)
    root = ST.fresh_root(spark, "stream_ad_stat")
    ST.run_ad_stat(spark, _stream_cfg(sf_dir), root, blacklist=t.blacklist)
    return ST.read_table(spark, root, "ad_stat")


@query("stream_ad_province_top3")
def q_stream_ad_province_top3(spark, sf_dir):
    t = fixtures(spark, sf_dir)
    root = ST.fresh_root(spark, "stream_top3")
    ST.run_province_top3(spark, _stream_cfg(sf_dir), root, blacklist=t.blacklist)
    return ST.read_table(spark, root, "province_top3")


@query("stream_ad_click_trend")
def q_stream_ad_click_trend(spark, sf_dir):
    t = fixtures(spark, sf_dir)
    root = ST.fresh_root(spark, "stream_trend")
    ST.run_click_trend(spark, _stream_cfg(sf_dir), root, blacklist=t.blacklist)
    return ST.read_table(spark, root, "click_trend")


@query("stream_ad_recent_hour")
def q_stream_ad_recent_hour(spark, sf_dir):
    t = fixtures(spark, sf_dir)
    root = ST.fresh_root(spark, "stream_recent")
    ST.run_recent_hour(spark, _stream_cfg(sf_dir), root, blacklist=t.blacklist)
    return ST.read_table(spark, root, "recent_hour")


# ---- sinks: apply two batches (clicks before / from noon, UTC), return the table ---------

def _halves(t: FixtureTables):
    f = ad_filtered(t)
    am = F.expr("(timestamp_ms div 3600000) % 24 < 12")
    return f.where(am), f.where(~am)


@query("sink_append")
def q_sink_append(spark, sf_dir):
    b1, b2 = _halves(fixtures(spark, sf_dir))
    path = scratch_path(spark, "sink_append")
    SINK.append(ADS.ad_stat(b1), path)
    SINK.append(ADS.ad_stat(b2), path)
    return spark.read.parquet(path)


@query("sink_overwrite")
def q_sink_overwrite(spark, sf_dir):
    b1, b2 = _halves(fixtures(spark, sf_dir))
    path = scratch_path(spark, "sink_overwrite")
    SINK.overwrite(ADS.ad_stat(b1), path)
    SINK.overwrite(ADS.ad_stat(b2), path)
    return spark.read.parquet(path)


def _two_batches(spark, name, table, first, second):
    """Write two batches to one of the day-partitioned tables of the ad stream and return its current rows."""
    out = ST.open_table(spark, scratch_path(spark, name), table)
    out.write(1, first)
    out.write(2, second)
    return out.read()


@query("sink_upsert_add")
def q_sink_upsert_add(spark, sf_dir):
    b1, b2 = _halves(fixtures(spark, sf_dir))
    return _two_batches(spark, "sink_upsert_add", "user_click_count", ADS.ad_user_click_count(b1), ADS.ad_user_click_count(b2))


@query("sink_upsert_replace")
def q_sink_upsert_replace(spark, sf_dir):
    b1, b2 = _halves(fixtures(spark, sf_dir))
    table = DeltaTable(spark, scratch_path(spark, "sink_upsert_replace"), ST.AD_STAT_SCHEMA, "replace",
                       ["date_key", "province", "city", "ad_id"], F.col("date_key"))
    table.write(1, ADS.ad_stat(b1))
    table.write(2, ADS.ad_stat(b2))
    return table.read()


@query("sink_replace_group")
def q_sink_replace_group(spark, sf_dir):
    b1, b2 = _halves(fixtures(spark, sf_dir))

    def top3(b):
        return ADS.ad_province_top3(ADS.ad_province_count(ADS.ad_stat(b)))
    return _two_batches(spark, "sink_replace_group", "province_top3", top3(b1), top3(b2))


@query("sink_blacklist_insert")
def q_sink_blacklist_insert(spark, sf_dir):
    t = fixtures(spark, sf_dir)
    table = ST.open_table(spark, scratch_path(spark, "sink_blacklist"), "blacklist")
    table.seed(t.blacklist)
    for batch, clicks in enumerate(_halves(t), 1):
        table.write(batch, ADS.ad_blacklist(ADS.ad_user_click_count(clicks), FIXTURE_BLACKLIST_THRESHOLD))
    return table.read()


# ---- scalar functions (FN1-FN17, minus the clock-dependent today/yesterday) --------------

SCALAR_PIVOT_TIME = "2024-01-15 12:00:00"


@query("scalar_functions")
def q_scalar_functions(spark, sf_dir):
    a = actions_in_range(fixtures(spark, sf_dir))
    pivot = F.lit(SCALAR_PIVOT_TIME)
    ts = C.parse_time("action_time")
    record = F.concat(F.lit("sid="), F.col("session_id"), F.lit("|page="), F.col("page_id").cast("string"),
                      F.lit("|kw="), F.coalesce(F.col("search_keyword"), F.lit("")))
    key = C.format_date_key(ts)
    return a.select(
        "event_id",
        C.before("action_time", pivot).cast("int").alias("is_before"),
        C.after("action_time", pivot).cast("int").alias("is_after"),
        C.minus("action_time", pivot).alias("secs_from_pivot"),
        C.date_hour("action_time").alias("date_hour"),
        C.format_time(ts).alias("time_text"),
        key.alias("date_key"),
        C.format_date(C.parse_date_key(key)).alias("date_back"),
        C.format_time_minute(ts).alias("time_minute"),
        C.is_empty("search_keyword").cast("int").alias("kw_empty"),
        C.trim_comma(F.concat(F.lit(","), F.coalesce("order_category_ids", F.lit("")), F.lit(","))).alias("trimmed"),
        C.fulfill(F.col("page_id").cast("string")).alias("filled"),
        C.get_field(record, "kw").alias("kw_field"),
        C.get_field(record, "page").alias("page_field"),
        C.set_field(record, "page", "x").alias("record_set"),
        C.concat_long_string("city_id", "date", ":").alias("city_info"),
        C.get_json_field(F.concat(F.lit('{"k": '), F.col("page_id").cast("string"), F.lit("}")), "k").alias("json_k"),
        C.format_double(F.col("page_id") / F.lit(3.0), 2).alias("third"),
    )


# ---- dynamic blacklist for every branch (one stream, per-batch blacklist, table state) -----

def _dynamic_run(spark, sf_dir, output):
    """The whole events table as three arrivals by event_id, newest first; each is one micro-batch of the
    same checkpointed stream, so lists, totals and late rows carry over from batch to batch."""
    t = fixtures(spark, sf_dir)
    root = ST.fresh_root(spark, "stream_dynamic")
    events = t.raw("events")
    top = events.agg(F.max("event_id")).first()[0] or 0
    cfg = StreamConfig(source_dir=f"{root}/in", file_glob="part-*")
    for part in (2, 1, 0):
        events.where(F.expr(f"event_id * 3 div {top + 1}") == part).write.mode("append").parquet(f"{root}/in")
        ST.run_dynamic(spark, cfg, f"{root}/out", seed=t.blacklist, threshold=FIXTURE_BLACKLIST_THRESHOLD, outputs=(output,))
    return ST.read_table(spark, f"{root}/out", output)


def _dynamic_table(output):
    return lambda spark, sf_dir: _dynamic_run(spark, sf_dir, output)


for _output in ST.OUTPUTS:
    QUERIES[f"stream_dynamic_{_output}"] = _dynamic_table(_output)
