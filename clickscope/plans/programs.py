"""The four end-to-end jobs, composed from the operators and appended to output tables.

Each ``run_*`` function takes input DataFrames (any source: parquet folders, catalog tables,
the fixtures) and appends its result tables under ``out`` (a folder, one sub-folder per
table) or, with ``jdbc`` options, to database tables of the same names. A task id tags
every row, as in the original output schemas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickscope.operators import area as AREA
from clickscope.operators import category as CAT
from clickscope.operators import funnel as FUN
from clickscope.operators import session as S
from clickscope.params import DEFAULT_TASK_ID, TaskParams
from clickscope.sinks import ops as SINK
from clickscope.sources import tables as SRC
from clickscope.streaming import ad_stream as ST


def _write(df: DataFrame, out: str, table: str, jdbc: dict | None) -> None:
    if jdbc:
        SINK.append(df, table, fmt="jdbc", options={**jdbc, "dbtable": table})
    else:
        SINK.append(df, f"{out.rstrip('/')}/{table}")


def run_session_program(actions: DataFrame, users: DataFrame, params: TaskParams, out: str,
                        taskid: str = DEFAULT_TASK_ID, sample_total: int = 100, seed: str = "0",
                        jdbc: dict | None = None) -> None:
    """Length distribution, stratified sample (+ its actions), top-10 categories and the
    top-10 sessions of each. The sessions that pass feed four outputs, so they are persisted
    for the duration of the job; they hold no lists."""
    in_range = SRC.visit_actions(actions, params.start_date, params.end_date)
    filtered = S.session_passing(in_range, users, params).persist()
    try:
        _write(S.session_aggr_stat(filtered, taskid), out, "session_stat_ratio", jdbc)
        sample = S.session_random_extract(filtered, sample_total, seed, taskid, actions=in_range)
        _write(sample, out, "session_extract", jdbc)
        _write(S.session_extract_detail(sample, in_range, taskid), out, "session_detail", jdbc)
        matrix = CAT.category_session_matrix(in_range, filtered)
        top = CAT.top10_category(CAT.full_count_from_matrix(matrix), 10, taskid)
        _write(top, out, "top10_category", jdbc)
        sessions = CAT.top10_active_session(CAT.session_count_from_matrix(matrix, top), 10, taskid)
        _write(sessions, out, "top10_session", jdbc)
    finally:
        filtered.unpersist()


def run_page_program(actions: DataFrame, params: TaskParams, out: str,
                     taskid: str = DEFAULT_TASK_ID, jdbc: dict | None = None) -> None:
    """One-step conversion rates along the target page flow, as a 'a_b=rate|...' row."""
    in_range = SRC.visit_actions(actions, params.start_date, params.end_date)
    rates = FUN.page_convert_rate(in_range, params.target_page_flow)
    _write(FUN.page_convert_rate_string(rates, taskid), out, "page_split_convert_rate", jdbc)


def run_area_program(actions: DataFrame, products: DataFrame, params: TaskParams, out: str,
                     city_area: DataFrame | None = None, taskid: str = DEFAULT_TASK_ID,
                     jdbc: dict | None = None) -> None:
    """Top-3 clicked products per area with their city list, level and product status."""
    clicks = SRC.city_click_products(actions, params.start_date, params.end_date)
    small = city_area is None
    dim = SRC.city_area(actions.sparkSession) if small else city_area
    basic = AREA.area_click_basic(clicks, dim, dimension_is_small=small)
    info = AREA.area_product_info(AREA.area_product_click_count(basic), products)
    _write(AREA.area_top3_product(info, 3, taskid), out, "area_top3_product", jdbc)


def run_ad_program(spark, cfg: ST.StreamConfig, root: str, seed_blacklist: DataFrame | None = None,
                   threshold: int = 100):
    """The ad-click stream: every batch is filtered by the blacklist as it stood before it, feeds all
    outputs and extends the list (tables under ``root``/stats). With a processing-time trigger the query
    keeps running and is returned; with availableNow it drains and stops."""
    return ST.run_dynamic(spark, cfg, f"{root}/stats", seed=seed_blacklist, threshold=threshold)
