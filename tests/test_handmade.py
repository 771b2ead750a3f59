"""Hand-made rows per operator (FIXTURES.md section 7)."""

import pytest
from pyspark.sql import functions as F

from clickscope.functions import columns as C
from clickscope.operators import area as AREA
from clickscope.operators import category as CAT
from clickscope.operators import funnel as FUN
from clickscope.operators import session as S
from clickscope.params import TaskParams
from clickscope.schemas import USER_VISIT_ACTION
from clickscope.sinks import ops as SINK
from clickscope.streaming.ad_stream import AD_STAT_SCHEMA
from tests.conftest import rows_of

_DEFAULTS = dict(date="2024-01-01", user_id=1, session_id="s1", page_id=1, action_time="2024-01-01 00:00:00",
                 search_keyword=None, click_category_id=-1, click_product_id=-1, order_category_ids=None,
                 order_product_ids=None, pay_category_ids=None, pay_product_ids=None, city_id=0, event_id=0)


def actions(spark, *rows):
    out = []
    for i, r in enumerate(rows):
        d = dict(_DEFAULTS, event_id=i)
        d.update(r)
        out.append(tuple(d[f.name] for f in USER_VISIT_ACTION.fields))
    return spark.createDataFrame(out, USER_VISIT_ACTION)


def test_bucket_edges(spark):
    visits = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    steps = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61] + [0] * 7
    df = spark.createDataFrame(list(zip(visits, steps)), "visit_length long, step_length long")
    r = S.session_aggr_stat(df, "t").collect()[0].asDict()
    assert r["session_count"] == 18
    two, one = round(2 / 18, 2), round(1 / 18, 2)
    for n, *_ in S.VISIT_BUCKETS[:-1]:
        assert r[f"{n}_ratio"] == two, n
    assert r["visit_length_30m_ratio"] == one
    for n, *_ in S.STEP_BUCKETS[:-1]:
        assert r[f"{n}_ratio"] == two, n
    assert r["step_length_60_ratio"] == one


def test_unpadded_hour_sorts_by_time(spark):
    a = actions(spark, dict(action_time="2019-08-28 15:00:00", page_id=2),
                dict(action_time="2019-08-28 5:03:04", page_id=1))
    r = S.session_summary(a).collect()[0]
    assert r["start_time"] == "2019-08-28 05:03:04"
    assert r["visit_length"] == 9 * 3600 + 56 * 60 + 56
    pairs = rows_of(FUN.page_transitions(a, parts=60))
    assert pairs == [("s1", 1, 2)]


def test_keywords_and_categories_exact_sets(spark):
    a = actions(spark, dict(search_keyword="苹果手机"), dict(search_keyword="苹果"),
                dict(search_keyword=""), dict(click_category_id=44), dict(click_category_id=48),
                dict(click_category_id=57), dict(click_category_id=5), dict(click_category_id=44))
    r = S.session_summary(a).collect()[0]
    assert r["search_keywords"] == "苹果,苹果手机"
    assert r["click_category_ids"] == "5,44,48,57"
    assert r["step_length"] == 8


def test_empty_lists_are_null(spark):
    r = S.session_summary(actions(spark, {})).collect()[0]
    assert r["search_keywords"] is None and r["click_category_ids"] is None


def test_group_concat_distinct_exact(spark):
    df = spark.createDataFrame([("11:x",), ("1:x",), (None,), ("1:x",)], "c string")
    assert df.agg(C.group_concat_distinct("c").alias("g")).collect()[0]["g"] == "11:x,1:x"


def test_mixed_row_categories(spark):
    a = actions(spark, dict(click_category_id=1, order_category_ids="2,2", pay_category_ids="3"))
    assert rows_of(CAT.category_universe(a)) == [(1,), (2,), (3,)]
    full = {r["category_id"]: r for r in CAT.category_full_count(a).collect()}
    assert (full[1]["click_count"], full[2]["order_count"], full[3]["pay_count"]) == (1, 2, 1)
    assert full[2]["click_count"] == 0 and full[1]["pay_count"] == 0


def test_empty_list_item_dropped(spark):
    df = spark.createDataFrame([("1,,2",)], "s string")
    assert df.select(C.split_ids("s").alias("a")).collect()[0]["a"] == [1, 2]


def _session(spark, pages, sid="s1", start=0):
    return [dict(session_id=sid, page_id=p, action_time=f"2024-01-01 00:{(start + i) // 60:02d}:{(start + i) % 60:02d}")
            for i, p in enumerate(pages)]


def test_missing_pair_and_zero_start(spark):
    a = actions(spark, *_session(spark, [1, 2, 4]))
    r = {x["page_split"]: x for x in FUN.page_convert_rate(a, [1, 2, 3]).collect()}
    assert r["1_2"]["convert_rate"] == 1.0 and r["2_3"]["split_count"] == 0
    assert r["2_3"]["convert_rate"] == 0.0
    r2 = FUN.page_convert_rate(a, [9, 1]).collect()[0]
    assert r2["convert_rate"] is None


def test_repeated_path_pair(spark):
    a = actions(spark, *_session(spark, [1, 2, 1, 2]))
    rates = FUN.page_convert_rate(a, [1, 2, 1, 2])
    got = [(r["step"], r["page_split"], r["split_count"]) for r in rates.orderBy("step").collect()]
    assert got == [(1, "1_2", 2), (2, "2_1", 1), (3, "1_2", 2)]
    s = FUN.page_convert_rate_string(rates, "t").collect()[0]["convert_rate"]
    assert s == "1_2=1.0|2_1=0.5|1_2=2.0"


def test_ties_at_rank_three_lowest_ids(spark):
    df = spark.createDataFrame([("华北", p, 1, "c", "n", "Self") for p in (9, 4, 7, 5)],
                               "area string, product_id long, click_count long, city_infos string, "
                               "product_name string, product_status string")
    got = [r["product_id"] for r in AREA.area_top3_product(df).collect()]
    assert sorted(got) == [4, 5, 7]
    assert AREA.area_top3_product(df).collect()[0]["area_level"] == "A_Level"


def test_stratified_sample_quotas(spark):
    rows = []
    for d in range(3):
        for h in range(7):
            for i in range(10):
                rows.append((f"s{d}_{h}_{i}", f"2024-01-0{d + 1} {h:02d}:00:00", None, None))
    df = spark.createDataFrame(rows, "session_id string, start_time string, search_keywords string, "
                                     "click_category_ids string")
    out = S.session_random_extract(df, total=100, seed="7").collect()
    # per day 100 div 3 = 33; per hour 10 * 33 div 70 = 4; 3 days x 7 hours x 4
    assert len(out) == 84 and len({r["session_id"] for r in out}) == 84


def test_no_rows(spark):
    a = actions(spark, {}).limit(0)
    assert S.session_summary(a).count() == 0
    r = S.session_aggr_stat(S.session_summary(a), "t").collect()
    assert len(r) == 1 and r[0]["session_count"] == 0 and r[0]["visit_length_1s_3s_ratio"] == 0.0
    assert S.session_random_extract(S.session_summary(a)).count() == 0
    assert CAT.category_full_count(a).count() == 0
    assert FUN.page_transitions(a).count() == 0


def test_json_status(spark):
    counts = spark.createDataFrame([("华北", 1, 1, "c"), ("华北", 2, 1, "c"), ("华北", 3, 1, "c")],
                                   "area string, product_id long, click_count long, city_infos string")
    prods = spark.createDataFrame([(1, "a", '{"product_status": 0}'), (2, "b", '{"product_status": 1}'),
                                   (3, "c", '{"other": 0}')], "product_id long, product_name string, extend_info string")
    got = {r["product_id"]: r["product_status"] for r in AREA.area_product_info(counts, prods).collect()}
    assert got == {1: "Self", 2: "Third Party", 3: "Third Party"}


def test_only_start_age_means_no_age_filter(spark):
    df = spark.createDataFrame([("s", 1, None, None, 1, 1, "t", 99, "p", "male", "c")],
                               "session_id string, user_id long, search_keywords string, click_category_ids string, "
                               "visit_length long, step_length long, start_time string, age int, professional string, "
                               "sex string, city string")
    assert S.session_filter(df, TaskParams(start_age=20)).count() == 1
    assert S.session_filter(df, TaskParams(start_age=20, end_age=50)).count() == 0
    assert S.session_filter(df, TaskParams(keywords=("kw1",))).count() == 0


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_hot_session_transitions_match_window(spark, parts):
    hot = _session(spark, [i % 10 for i in range(1500)], sid="hot")
    cold = [r for k in range(20) for r in _session(spark, [k % 10, (k + 3) % 10, k % 7], sid=f"c{k}")]
    a = actions(spark, *(hot + cold))
    assert rows_of(FUN.page_transitions(a, parts=parts)) == rows_of(FUN.page_transitions_window(a))


def test_today_and_yesterday(spark):
    import datetime
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    r = spark.range(1).select(C.today().alias("t"), C.yesterday().alias("y")).collect()[0]
    now = datetime.datetime.now(datetime.timezone.utc).date()
    assert r["t"] in {str(now), str(now + datetime.timedelta(days=1))}  # midnight race
    assert datetime.date.fromisoformat(r["t"]) - datetime.date.fromisoformat(r["y"]) == datetime.timedelta(days=1)


def test_task_params_from_json_dict():
    p = TaskParams.from_dict({"startDate": "2024-01-01", "endDate": "2024-01-30", "startAge": "20",
                              "endAge": "", "professionals": "", "cities": "city1,city2", "sex": "",
                              "keywords": "kw1,kw2", "categoryIds": "", "targetPageFlow": "1,2,3"})
    assert p.start_age == 20 and p.end_age is None and p.sex is None
    assert p.cities == ("city1", "city2") and p.keywords == ("kw1", "kw2") and p.category_ids == ()
    assert p.target_page_flow == (1, 2, 3) and p.professionals == ()


@pytest.mark.parametrize("bits", [1, 100, 32768, 1 << 20])
def test_session_semi_join_behind_a_bitmap(spark, bits):
    """Few bits let more rows through to the join, none of them into the result."""
    hot = [dict(session_id="hot", page_id=i % 10, action_time=f"2024-01-01 00:{i // 60 % 60:02d}:{i % 60:02d}")
           for i in range(300)]
    cold = [dict(session_id=f"c{k}", page_id=k % 10) for k in range(30)]
    a = actions(spark, *(hot + cold))
    summ = S.session_summary(a).where(F.col("session_id") != "c3")  # c3 filtered out
    got = rows_of(S.session_filtered_actions(a, summ, bits=bits))
    want = rows_of(a.join(summ.select("session_id"), "session_id", "left_semi").select(*a.columns))
    assert got == want and len(got) == 329


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_read_table_formats(spark, tmp_path, fmt):
    from clickscope.schemas import USER_INFO
    from clickscope.sources import tables as SRC
    from clickscope.plans.catalog import fixtures
    from tests.conftest import SF_SMALL
    users = fixtures(spark, SF_SMALL).users
    path = str(tmp_path / f"users_{fmt}")
    writer = users.write.mode("overwrite")
    (writer.option("header", "true").csv(path) if fmt == "csv" else writer.format(fmt).save(path))
    back = SRC.read_table(spark, path, USER_INFO, fmt=fmt).select(*USER_INFO.fieldNames())
    assert rows_of(back) == rows_of(users)


def test_transitions_with_null_pages_sessions_and_no_event_id(spark):
    rows = [("a", "2024-01-01 00:59:59", 1), ("a", "2024-01-01 01:00:01", None), ("a", "2024-01-01 01:00:02", 3),
            ("a", "2024-01-01 05:00:00", 4), (None, "2024-01-01 00:00:00", 7), (None, "2024-01-01 09:00:00", 8)]
    a = spark.createDataFrame(rows, "session_id string, action_time string, page_id long")
    got = sorted(FUN.page_transitions(a).collect(), key=str)
    assert got == sorted(FUN.page_transitions_window(a).collect(), key=str)
    assert [tuple(r) for r in got] == sorted([("a", 3, 4), ("a", None, 3), (None, 7, 8)], key=lambda r: "Row(session_id=%r, from_page=%r, to_page=%r)" % r)
    summ = spark.createDataFrame([("a",)], "session_id string")
    assert S.session_filtered_actions(a, summ).count() == 4


def test_short_ad_lines_become_nulls(spark):
    from clickscope.operators import ads as ADS
    lines = spark.createDataFrame([("1700000000000 p c 5 6",), ("1700000000000 p",), ("x p c y z",), ("",), (None,)], "value string")
    parsed = ADS.ad_log_parse(lines)
    assert parsed.count() == 5 and parsed.where(ADS.parsable()).count() == 1
