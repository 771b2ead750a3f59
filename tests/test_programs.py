"""The end-to-end jobs write the same rows as the registered queries."""

import __spark_entry__ as E
from clickscope.plans import programs as PG
from clickscope.plans.catalog import fixtures
from clickscope.params import DEFAULT_PARAMS
from tests.conftest import SF_SMALL, rows_of


def test_batch_programs_match_queries(spark, tmp_path):
    t = fixtures(spark, SF_SMALL)
    out = str(tmp_path / "out")
    PG.run_session_program(t.actions, t.users, DEFAULT_PARAMS, out)
    PG.run_page_program(t.actions, DEFAULT_PARAMS, out)
    PG.run_area_program(t.actions, t.products, DEFAULT_PARAMS, out)
    q = E.queries()
    for table, key in [("session_stat_ratio", "session_aggr_stat"), ("session_extract", "session_random_extract"),
                       ("session_detail", "session_extract_detail"), ("top10_category", "top10_category"),
                       ("top10_session", "top10_active_session"), ("page_split_convert_rate", "page_convert_rate_string"),
                       ("area_top3_product", "area_top3_product")]:
        want = q[key](spark, SF_SMALL)
        got = spark.read.parquet(f"{out}/{table}").select(*want.columns)
        assert rows_of(got) == rows_of(want), table


def test_ad_program_drains_one_batch_filtered_by_the_seed(spark, tmp_path):
    """The list that a batch builds holds from the next batch on; one batch sees the seed alone."""
    from clickscope.plans.catalog import FIXTURE_BLACKLIST_THRESHOLD
    from clickscope.streaming import ad_stream as ST
    t = fixtures(spark, SF_SMALL)
    root = str(tmp_path / "ads")
    PG.run_ad_program(spark, ST.StreamConfig(source_dir=SF_SMALL), root, seed_blacklist=t.blacklist,
                      threshold=FIXTURE_BLACKLIST_THRESHOLD)
    got = ST.read_table(spark, f"{root}/stats", "ad_stat")
    assert rows_of(got) == rows_of(E.queries()["ad_stat"](spark, SF_SMALL))
    listed = ST.read_table(spark, f"{root}/stats", "blacklist")
    assert rows_of(listed) == rows_of(E.queries()["stream_ad_blacklist"](spark, SF_SMALL))


def test_params_from_json():
    from clickscope.params import TaskParams
    p = TaskParams.from_json('{"startDate": "2024-01-01", "endDate": "2024-01-30", "sex": "male", '
                             '"targetPageFlow": "1,2"}')
    assert p.sex == "male" and p.target_page_flow == (1, 2) and p.start_age is None
