"""Independent DuckDB SQL for every registered query (the correctness oracle).

The fixture tables are re-derived here from the raw views (events, customer, part) with the
same integer rules as ``sources.fixtures``; each query is ``WITH <shared CTEs> <select>``.
Rounding uses exact integer HALF_UP, epoch milliseconds use ``epoch_us(ts) // 1000``.
"""

from __future__ import annotations

from clickscope.params import DEFAULT_PARAMS, DEFAULT_TASK_ID, KEYWORD_PARAMS, PROFILE_PARAMS, TaskParams

P = DEFAULT_PARAMS
TASK = DEFAULT_TASK_ID

FIXTURE_CTES = [
    ("ev", """SELECT event_id, user_id, event_type, ts,
       TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
       CAST(floor(epoch(ts)) AS BIGINT) AS e
  FROM events"""),
    ("ev2", """SELECT *,
       CASE user_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 7 ELSE 30 END AS blk,
       CASE (user_id // 4) % 6 WHEN 0 THEN 10 WHEN 1 THEN 100 WHEN 2 THEN 400
            WHEN 3 THEN 1000 WHEN 4 THEN 4000 ELSE 10000 END AS dv
  FROM ev"""),
    ("ev3", "SELECT *, (e - 1704067200) // (blk * 86400) AS bi FROM ev2"),
    ("ev4", """SELECT *, 1704067200 + bi * blk * 86400 + (e - 1704067200 - bi * blk * 86400) // dv
       + (user_id % 20) * 3600 AS tsec FROM ev3"""),
    ("uva", """SELECT strftime(make_timestamp(tsec * 1000000), '%Y-%m-%d') AS date,
       CAST(user_id AS BIGINT) AS user_id,
       CAST(user_id AS VARCHAR) || '_' || CAST(bi AS VARCHAR) AS session_id,
       CAST(k % 10 AS BIGINT) AS page_id,
       strftime(make_timestamp(tsec * 1000000), '%Y-%m-%d %H:%M:%S') AS action_time,
       CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
       CAST(CASE WHEN event_type = 'click' THEN k ELSE -1 END AS BIGINT) AS click_category_id,
       CAST(CASE WHEN event_type = 'click' THEN event_id % 100 ELSE -1 END AS BIGINT) AS click_product_id,
       CASE WHEN event_type = 'purchase' AND event_id % 2 = 0
            THEN CAST(k AS VARCHAR) || ',' || CAST((k + 7) % 100 AS VARCHAR) END AS order_category_ids,
       CASE WHEN event_type = 'purchase' AND event_id % 2 = 0
            THEN CAST(event_id % 100 AS VARCHAR) END AS order_product_ids,
       CASE WHEN event_type = 'purchase' AND event_id % 2 = 1 THEN CAST(k AS VARCHAR) END AS pay_category_ids,
       CASE WHEN event_type = 'purchase' AND event_id % 2 = 1
            THEN CAST(event_id % 100 AS VARCHAR) END AS pay_product_ids,
       CAST(event_id % 10 AS BIGINT) AS city_id,
       CAST(event_id AS BIGINT) AS event_id
  FROM ev4"""),
    ("users", """SELECT CAST(c_custkey AS BIGINT) AS user_id,
       'user' || CAST(c_custkey AS VARCHAR) AS username,
       c_name AS name,
       CAST((c_custkey * 7) % 60 AS INTEGER) AS age,
       'professional' || CAST(c_custkey % 100 AS VARCHAR) AS professional,
       'city' || CAST(c_nationkey AS VARCHAR) AS city,
       CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer"""),
    ("products", """SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS product_name,
       '{"product_status": ' || CAST(p_partkey % 2 AS VARCHAR) || '}' AS extend_info
  FROM part"""),
]


def _in_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def _session_ctes(params: TaskParams, suffix: str = "") -> list[tuple[str, str]]:
    """va, summ, full, filt (names get ``suffix``) for one parameter set."""
    va, summ, full, filt = (f"va{suffix}", f"summ{suffix}", f"sfull{suffix}", f"filt{suffix}")
    conds = ["TRUE"]
    if params.start_age is not None and params.end_age is not None:
        conds.append(f"age BETWEEN {params.start_age} AND {params.end_age}")
    if params.professionals:
        conds.append(f"professional IN ({_in_list(params.professionals)})")
    if params.cities:
        conds.append(f"city IN ({_in_list(params.cities)})")
    if params.sex:
        conds.append(f"sex = '{params.sex}'")
    if params.keywords:
        conds.append(f"coalesce(list_has_any(string_split(search_keywords, ','), "
                     f"[{_in_list(params.keywords)}]), FALSE)")
    if params.category_ids:
        conds.append(f"coalesce(list_has_any(string_split(click_category_ids, ','), "
                     f"[{_in_list(params.category_ids)}]), FALSE)")
    return [
        (va, f"SELECT * FROM uva WHERE date BETWEEN '{params.start_date}' AND '{params.end_date}'"),
        (summ, f"""SELECT session_id, min(user_id) AS user_id,
       NULLIF(array_to_string(list_sort(list_distinct(
           list(search_keyword) FILTER (WHERE search_keyword <> ''))), ','), '') AS search_keywords,
       NULLIF(array_to_string(list_sort(list_distinct(
           list(click_category_id) FILTER (WHERE click_category_id <> -1))), ','), '') AS click_category_ids,
       date_diff('second', min(strptime(action_time, '%Y-%m-%d %H:%M:%S')),
                 max(strptime(action_time, '%Y-%m-%d %H:%M:%S'))) AS visit_length,
       count(*) AS step_length,
       strftime(min(strptime(action_time, '%Y-%m-%d %H:%M:%S')), '%Y-%m-%d %H:%M:%S') AS start_time
  FROM {va} GROUP BY session_id"""),
        (full, f"""SELECT s.session_id, s.user_id, s.search_keywords, s.click_category_ids,
       s.visit_length, s.step_length, s.start_time, u.age, u.professional, u.sex, u.city
  FROM {summ} s JOIN users u ON s.user_id = u.user_id"""),
        (filt, f"SELECT * FROM {full} WHERE {' AND '.join(conds)}"),
    ]


# The length buckets, stated here on their own.
LENGTH_BUCKETS = [
    ("visit_length_1s_3s", "visit_length BETWEEN 1 AND 3"), ("visit_length_4s_6s", "visit_length BETWEEN 4 AND 6"),
    ("visit_length_7s_9s", "visit_length BETWEEN 7 AND 9"), ("visit_length_10s_30s", "visit_length BETWEEN 10 AND 30"),
    ("visit_length_30s_60s", "visit_length > 30 AND visit_length <= 60"), ("visit_length_1m_3m", "visit_length > 60 AND visit_length <= 180"),
    ("visit_length_3m_10m", "visit_length > 180 AND visit_length <= 600"), ("visit_length_10m_30m", "visit_length > 600 AND visit_length <= 1800"),
    ("visit_length_30m", "visit_length > 1800"),
    ("step_length_1_3", "step_length BETWEEN 1 AND 3"), ("step_length_4_6", "step_length BETWEEN 4 AND 6"),
    ("step_length_7_9", "step_length BETWEEN 7 AND 9"), ("step_length_10_30", "step_length BETWEEN 10 AND 30"),
    ("step_length_30_60", "step_length > 30 AND step_length <= 60"), ("step_length_60", "step_length > 60")]


def _ratio_sql(n: str, d: str) -> str:
    # exact HALF_UP to 2 decimals of n/d, d >= 1
    return f"CAST(((200 * {n} + {d}) // (2 * {d})) AS DOUBLE) / 100.0"


def _aggr_stat_sql(filt: str) -> str:
    counts = ",\n       ".join(f"count(*) FILTER (WHERE {cond}) AS {n}" for n, cond in LENGTH_BUCKETS)
    ratios = ",\n       ".join(f"{_ratio_sql(n, 'greatest(session_count, 1)')} AS {n}_ratio" for n, _ in LENGTH_BUCKETS)
    return f"""SELECT '{TASK}' AS taskid, session_count,
       {ratios}
  FROM (SELECT count(*) AS session_count,
       {counts}
  FROM {filt}) c"""


def _hour_counts_sql(filt: str) -> str:
    return f"""SELECT split_part(start_time, ' ', 1) AS date,
       split_part(split_part(start_time, ' ', 2), ':', 1) AS hour, count(*) AS session_count
  FROM {filt} GROUP BY 1, 2"""


def _extract_sql(filt: str, total: int = 100, seed: str = "0") -> str:
    return f"""SELECT '{TASK}' AS taskid, session_id, start_time, search_keywords, click_category_ids
  FROM (SELECT f.*, row_number() OVER (PARTITION BY date, hour ORDER BY md5(session_id || '{seed}')) AS rk
          FROM (SELECT *, split_part(start_time, ' ', 1) AS date,
                       split_part(split_part(start_time, ' ', 2), ':', 1) AS hour FROM {filt}) f) r
  JOIN (SELECT date, hour,
               least(session_count, session_count * ({total} // days) // day_count) AS quota
          FROM (SELECT *, sum(session_count) OVER (PARTITION BY date) AS day_count,
                       count(DISTINCT date) OVER () AS days
                  FROM ({_hour_counts_sql(filt)}) h) h2) q
    USING (date, hour)
 WHERE rk <= quota"""


# The columns of a sampled action.
DETAIL_COLUMNS = ("user_id, session_id, page_id, action_time, search_keyword, click_category_id, click_product_id, "
                  "order_category_ids, order_product_ids, pay_category_ids, pay_product_ids")
SESSION_CTES = _session_ctes(P) + _session_ctes(PROFILE_PARAMS, "_profile") + _session_ctes(KEYWORD_PARAMS, "_kw")
BASE_CTES = FIXTURE_CTES + SESSION_CTES

# Final SELECTs per query key; each runs with every CTE above in scope.
FINAL: dict[str, str] = {
    "visit_actions": "SELECT * FROM va",
    "session_summary": "SELECT * FROM summ",
    "session_full_info": "SELECT * FROM sfull",
    "session_filter": "SELECT * FROM filt",
    "session_filter_keywords": "SELECT * FROM filt_kw",
    "session_filter_profile": "SELECT * FROM filt_profile",
    "session_aggr_stat_profile": _aggr_stat_sql("filt_profile"),
    "session_random_extract_large": _extract_sql("filt", 700),
    "session_extract_detail_large": f"""SELECT '{TASK}' AS taskid, {DETAIL_COLUMNS}
  FROM va WHERE session_id IN (SELECT session_id FROM ({_extract_sql('filt', 700)}) x)""",
    "session_aggr_stat": _aggr_stat_sql("filt"),
    "session_aggr_stat_keywords": _aggr_stat_sql("filt_kw"),
    "session_hour_counts": _hour_counts_sql("filt"),
    "session_random_extract": _extract_sql("filt"),
    "session_sample_quotas": f"""SELECT date, hour, hour_count, day_count, days,
       least(hour_count, hour_count * (100 // days) // day_count) AS quota, 100 // days AS per_day
  FROM (SELECT date, hour, session_count AS hour_count,
               CAST(sum(session_count) OVER (PARTITION BY date) AS BIGINT) AS day_count,
               count(DISTINCT date) OVER () AS days
          FROM ({_hour_counts_sql('filt')}) h) q""",
    "session_extract_detail": f"""SELECT '{TASK}' AS taskid, {DETAIL_COLUMNS}
  FROM va WHERE session_id IN (SELECT session_id FROM ({_extract_sql('filt')}) x)""",
    "session_filtered_actions": "SELECT * FROM va WHERE session_id IN (SELECT session_id FROM filt)",
}


def _with(ctes: list[tuple[str, str]], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{body}\n)" for n, body in ctes) + "\n" + final


EXTRA_CTES: dict[str, list[tuple[str, str]]] = {}


def register(name: str, final: str, extra_ctes: list[tuple[str, str]] | None = None) -> None:
    FINAL[name] = final
    if extra_ctes:
        EXTRA_CTES[name] = extra_ctes


def oracle_sql() -> dict[str, str]:
    return {k: _with(BASE_CTES + EXTRA_CTES.get(k, []), v) for k, v in FINAL.items()}


# ---- categories ------------------------------------------------------------------------

_FA = ("fa", "SELECT * FROM va WHERE session_id IN (SELECT session_id FROM filt)")
_CEV = ("cev", """SELECT click_category_id AS category_id, 0 AS kind FROM fa WHERE click_category_id <> -1
UNION ALL
SELECT TRY_CAST(x AS BIGINT), 1 FROM (SELECT unnest(string_split(order_category_ids, ',')) AS x
  FROM fa WHERE order_category_ids IS NOT NULL) o WHERE TRY_CAST(x AS BIGINT) IS NOT NULL
UNION ALL
SELECT TRY_CAST(x AS BIGINT), 2 FROM (SELECT unnest(string_split(pay_category_ids, ',')) AS x
  FROM fa WHERE pay_category_ids IS NOT NULL) p WHERE TRY_CAST(x AS BIGINT) IS NOT NULL""")
_CFC = ("cfc", """SELECT category_id, count(*) FILTER (WHERE kind = 0) AS click_count,
       count(*) FILTER (WHERE kind = 1) AS order_count, count(*) FILTER (WHERE kind = 2) AS pay_count
  FROM cev GROUP BY category_id""")
_TOP = ("top10", f"""SELECT '{TASK}' AS taskid, category_id, click_count, order_count, pay_count FROM cfc
 ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id ASC LIMIT 10""")
_CSC = ("csc", """SELECT click_category_id AS category_id, session_id, count(*) AS click_count FROM fa
 WHERE click_category_id IN (SELECT category_id FROM top10) GROUP BY 1, 2""")
CAT_CTES = [_FA, _CEV, _CFC, _TOP, _CSC]

for _k, _sql in {
    "category_universe": "SELECT DISTINCT category_id FROM cev",
    "category_click_count": "SELECT category_id, count(*) AS click_count FROM cev WHERE kind = 0 GROUP BY 1",
    "category_order_count": "SELECT category_id, count(*) AS order_count FROM cev WHERE kind = 1 GROUP BY 1",
    "category_pay_count": "SELECT category_id, count(*) AS pay_count FROM cev WHERE kind = 2 GROUP BY 1",
    "category_full_count": "SELECT * FROM cfc",
    "top10_category": "SELECT * FROM top10",
    "category_session_count": "SELECT * FROM csc",
    "category_session_count_direct": "SELECT * FROM csc",
    "top10_active_session": f"""SELECT '{TASK}' AS taskid, category_id, session_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id ASC) AS rn
    FROM csc) r WHERE rn <= 10""",
}.items():
    register(_k, _sql, CAT_CTES)


# ---- page funnel -----------------------------------------------------------------------

def _path_values(flow) -> str:
    flow = [int(p) for p in flow]
    rows = [f"({i + 1}, CAST({a} AS BIGINT), CAST({b} AS BIGINT), '{a}_{b}')"
            for i, (a, b) in enumerate(zip(flow[:-1], flow[1:]))]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") v(step, from_page, to_page, page_split)"


FUNNEL_CTES = [
    ("trans", """SELECT session_id, from_page, to_page FROM (
  SELECT session_id, page_id AS from_page,
         lead(page_id) OVER (PARTITION BY session_id
                             ORDER BY strptime(action_time, '%Y-%m-%d %H:%M:%S'), event_id) AS to_page
    FROM va) x WHERE to_page IS NOT NULL"""),
    ("tpath", _path_values(P.target_page_flow)),
    ("psc", """SELECT p.step, p.page_split, CAST(coalesce(c.n, 0) AS BIGINT) AS split_count
  FROM tpath p LEFT JOIN (SELECT from_page, to_page, count(*) AS n FROM trans GROUP BY 1, 2) c
    ON p.from_page = c.from_page AND p.to_page = c.to_page"""),
    ("spc", f"SELECT count(*) FILTER (WHERE page_id = {int(P.target_page_flow[0])}) AS start_page_count FROM va"),
    ("pcr", """SELECT step, page_split, split_count, convert_rate FROM (
  SELECT step, page_split, split_count,
         CAST(split_count AS DOUBLE) / NULLIF(CAST(lag(split_count) OVER (ORDER BY step) AS DOUBLE), 0)
           AS convert_rate
    FROM (SELECT step, page_split, split_count FROM psc
          UNION ALL SELECT 0, 'start', start_page_count FROM spc) u) r WHERE step > 0"""),
]
for _k, _sql in {
    "page_transitions": "SELECT * FROM trans",
    "page_transitions_window": "SELECT * FROM trans",
    "page_split_count": "SELECT * FROM psc",
    "start_page_count": "SELECT * FROM spc",
    "page_convert_rate": "SELECT * FROM pcr",
    "page_convert_rate_string": f"""SELECT '{TASK}' AS taskid,
       string_agg(page_split || '=' || coalesce(CAST(convert_rate AS VARCHAR), 'null'), '|' ORDER BY step)
         AS convert_rate FROM pcr""",
}.items():
    register(_k, _sql, FUNNEL_CTES)


# ---- area top products -----------------------------------------------------------------

def _city_area_values() -> str:
    from clickscope.schemas import CITY_AREA_ROWS
    rows = ", ".join(f"(CAST({a} AS BIGINT), '{b}', '{c}')" for a, b, c in CITY_AREA_ROWS)
    return f"SELECT * FROM (VALUES {rows}) v(city_id, city_name, area)"


def _area_level_sql(col: str) -> str:
    from clickscope.schemas import AREA_LEVEL_DEFAULT, AREA_LEVELS
    whens = " ".join(f"WHEN {col} = '{a}' THEN '{lvl}'" for a, lvl in AREA_LEVELS)
    return f"CASE {whens} ELSE '{AREA_LEVEL_DEFAULT}' END"


AREA_CTES = [
    ("ccp", "SELECT city_id, click_product_id FROM va WHERE click_product_id <> -1"),
    ("city_area", _city_area_values()),
    ("acb", """SELECT c.city_id, a.city_name, a.area, c.click_product_id AS product_id
  FROM ccp c JOIN city_area a ON c.city_id = a.city_id"""),
    ("apcc", """SELECT area, product_id, count(*) AS click_count,
       NULLIF(array_to_string(list_sort(list_distinct(
           list(CAST(city_id AS VARCHAR) || ':' || city_name))), ','), '') AS city_infos
  FROM acb GROUP BY area, product_id"""),
    ("api", """SELECT c.area, c.product_id, c.click_count, c.city_infos, p.product_name,
       CASE WHEN json_extract_string(p.extend_info, '$.product_status') = '0' THEN 'Self'
            ELSE 'Third Party' END AS product_status
  FROM apcc c JOIN products p ON c.product_id = p.product_id"""),
]
for _k, _sql in {
    "city_click_products": "SELECT * FROM ccp",
    "area_click_basic": "SELECT * FROM acb",
    "area_product_click_count": "SELECT * FROM apcc",
    "area_product_info": "SELECT * FROM api",
    "area_top3_product": f"""SELECT '{TASK}' AS taskid, area, {_area_level_sql('area')} AS area_level,
       product_id, city_infos, click_count, product_name, product_status FROM (
  SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id ASC) AS rn
    FROM api) r WHERE rn <= 3""",
    "group_concat_distinct": """SELECT area,
       NULLIF(array_to_string(list_sort(list_distinct(
           list(CAST(city_id AS VARCHAR) || ':' || city_name))), ','), '') AS city_infos
  FROM acb GROUP BY area""",
}.items():
    register(_k, _sql, AREA_CTES)


# ---- ad clicks -------------------------------------------------------------------------

AD_THRESHOLD = 1
AD_CTES = [
    ("adlines", """SELECT CAST(epoch_us(ts) // 1000 AS VARCHAR) || ' ' || CAST(user_id % 10 AS VARCHAR)
       || ' c_' || CAST(event_id % 3 AS VARCHAR) || ' ' || CAST(user_id AS VARCHAR)
       || ' ' || CAST(k % 20 AS VARCHAR) AS value FROM ev"""),
    ("adp0", """SELECT TRY_CAST(split_part(value, ' ', 1) AS BIGINT) AS timestamp_ms,
       split_part(value, ' ', 2) AS province, split_part(value, ' ', 3) AS city,
       TRY_CAST(split_part(value, ' ', 4) AS BIGINT) AS user_id,
       TRY_CAST(split_part(value, ' ', 5) AS BIGINT) AS ad_id FROM adlines"""),
    ("adp", "SELECT *, strftime(make_timestamp(timestamp_ms * 1000), '%Y%m%d') AS date_key FROM adp0"),
    ("bl", "SELECT DISTINCT CAST(user_id AS BIGINT) AS user_id FROM events WHERE user_id % 7 = 0"),
    ("adf", "SELECT * FROM adp WHERE user_id NOT IN (SELECT user_id FROM bl)"),
    ("aucc", "SELECT date_key, user_id, ad_id, count(*) AS click_count FROM adf GROUP BY 1, 2, 3"),
    ("astat", "SELECT date_key, province, city, ad_id, count(*) AS click_count FROM adf GROUP BY 1, 2, 3, 4"),
    ("aprov", """SELECT date_key, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
  FROM astat GROUP BY 1, 2, 3"""),
    ("atop3", """SELECT date_key, province, ad_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY date_key, province ORDER BY click_count DESC, ad_id ASC) AS rn
    FROM aprov) r WHERE rn <= 3"""),
    ("amin", "SELECT timestamp_ms // 60000 AS m, ad_id, count(*) AS n FROM adf GROUP BY 1, 2"),
    ("atrend", """SELECT strftime(make_timestamp(m * 60000000), '%Y%m%d') AS date,
       strftime(make_timestamp(m * 60000000), '%H') AS hour,
       strftime(make_timestamp(m * 60000000), '%M') AS minute, ad_id, n AS click_count FROM amin"""),
    ("ahour", """SELECT strftime(make_timestamp(s * 60000000), '%Y-%m-%d %H:%M') AS window_start,
       strftime(make_timestamp((s + 60) * 60000000), '%Y-%m-%d %H:%M') AS window_end,
       ad_id, CAST(sum(n) AS BIGINT) AS click_count
  FROM (SELECT m - j.range AS s, ad_id, n FROM amin CROSS JOIN range(0, 60) j) w
 GROUP BY s, ad_id"""),
    ("ablack", f"SELECT DISTINCT user_id FROM aucc WHERE click_count > {AD_THRESHOLD}"),
]
for _k, _sql in {
    "ad_log_parse": "SELECT * FROM adp",
    "ad_blacklist_filter": "SELECT * FROM adf",
    "ad_user_click_count": "SELECT * FROM aucc",
    "ad_blacklist": "SELECT * FROM ablack",
    "ad_stat": "SELECT * FROM astat",
    "ad_province_count": "SELECT * FROM aprov",
    "ad_province_top3": "SELECT * FROM atop3",
    "ad_click_trend": "SELECT * FROM atrend",
    "ad_recent_hour": "SELECT * FROM ahour",
}.items():
    register(_k, _sql, AD_CTES)


# ---- ad lines that do not parse: the damage is made again from the events -------------------

_DAMAGED = ("dmg", """SELECT CASE event_id % 16 WHEN 3 THEN concat_ws(' ', ms, prov, city)
            WHEN 6 THEN concat_ws(' ', ms, prov, city, 'u' || uid, ad) WHEN 9 THEN concat_ws(' ', 'now', prov, city, uid, ad)
            WHEN 12 THEN '' ELSE concat_ws(' ', ms, prov, city, uid, ad) END AS value,
       CASE event_id % 16 WHEN 3 THEN 'short' WHEN 12 THEN 'short' WHEN 6 THEN 'number' WHEN 9 THEN 'number' END AS fault,
       CAST(ms AS BIGINT) AS timestamp_ms, prov, city, CAST(uid AS BIGINT) AS user_id, CAST(ad AS BIGINT) AS ad_id
  FROM (SELECT event_id, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ms, CAST(user_id % 10 AS VARCHAR) AS prov,
               'c_' || CAST(event_id % 3 AS VARCHAR) AS city, CAST(user_id AS VARCHAR) AS uid, CAST(k % 20 AS VARCHAR) AS ad FROM ev) x""")
register("ad_dead_letters", "SELECT value, fault, count(*) AS line_count FROM dmg WHERE fault IS NOT NULL GROUP BY 1, 2", [_DAMAGED])
register("stream_ad_dead_letters", "SELECT value, fault, count(*) AS line_count FROM dmg WHERE fault IS NOT NULL GROUP BY 1, 2", [_DAMAGED])
register("ad_stat_damaged", """SELECT strftime(make_timestamp(timestamp_ms * 1000), '%Y%m%d') AS date_key, prov AS province, city, ad_id,
       count(*) AS click_count FROM dmg WHERE fault IS NULL AND user_id % 7 <> 0 GROUP BY 1, 2, 3, 4""", [_DAMAGED])


# ---- streaming replay: the oracle is the batch SQL ------------------------------------------

for _k, _sql in {
    "stream_ad_blacklist": "SELECT user_id FROM bl UNION SELECT user_id FROM ablack",
    "stream_ad_user_click_count": "SELECT * FROM aucc",
    "stream_ad_stat": "SELECT * FROM astat",
    "stream_ad_province_top3": "SELECT * FROM atop3",
    "stream_ad_click_trend": "SELECT * FROM atrend",
    "stream_ad_recent_hour": "SELECT * FROM ahour",
}.items():
    register(_k, _sql, AD_CTES)


# ---- sinks: two batches split at noon (UTC) ------------------------------------------------

SINK_CTES = AD_CTES + [
    ("adf1", "SELECT * FROM adf WHERE (timestamp_ms // 3600000) % 24 < 12"),
    ("adf2", "SELECT * FROM adf WHERE (timestamp_ms // 3600000) % 24 >= 12"),
    ("st1", "SELECT date_key, province, city, ad_id, count(*) AS click_count FROM adf1 GROUP BY 1, 2, 3, 4"),
    ("st2", "SELECT date_key, province, city, ad_id, count(*) AS click_count FROM adf2 GROUP BY 1, 2, 3, 4"),
    ("uc1", "SELECT date_key, user_id, ad_id, count(*) AS click_count FROM adf1 GROUP BY 1, 2, 3"),
    ("uc2", "SELECT date_key, user_id, ad_id, count(*) AS click_count FROM adf2 GROUP BY 1, 2, 3"),
    ("tp1", """SELECT date_key, province, ad_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY date_key, province ORDER BY click_count DESC, ad_id) AS rn
    FROM (SELECT date_key, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
            FROM st1 GROUP BY 1, 2, 3) a) r WHERE rn <= 3"""),
    ("tp2", """SELECT date_key, province, ad_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY date_key, province ORDER BY click_count DESC, ad_id) AS rn
    FROM (SELECT date_key, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
            FROM st2 GROUP BY 1, 2, 3) a) r WHERE rn <= 3"""),
]
for _k, _sql in {
    "sink_append": "SELECT * FROM st1 UNION ALL SELECT * FROM st2",
    "sink_overwrite": "SELECT * FROM st2",
    "sink_upsert_add": """SELECT date_key, user_id, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
  FROM (SELECT * FROM uc1 UNION ALL SELECT * FROM uc2) u GROUP BY 1, 2, 3""",
    "sink_upsert_replace": """SELECT * FROM st2 UNION ALL
SELECT * FROM st1 WHERE (date_key, province, city, ad_id) NOT IN (SELECT (date_key, province, city, ad_id) FROM st2)""",
    "sink_replace_group": """SELECT * FROM tp2 UNION ALL
SELECT * FROM tp1 WHERE (date_key, province) NOT IN (SELECT (date_key, province) FROM tp2)""",
    "sink_blacklist_insert": f"""SELECT user_id FROM bl UNION
SELECT user_id FROM uc1 WHERE click_count > {AD_THRESHOLD} UNION
SELECT user_id FROM uc2 WHERE click_count > {AD_THRESHOLD}""",
}.items():
    register(_k, _sql, SINK_CTES)


# ---- scalar functions ------------------------------------------------------------------

_PIV = "TIMESTAMP '2024-01-15 12:00:00'"
_TS = "strptime(action_time, '%Y-%m-%d %H:%M:%S')"
_REC = "('sid=' || session_id || '|page=' || CAST(page_id AS VARCHAR) || '|kw=' || coalesce(search_keyword, ''))"
register("scalar_functions", f"""SELECT event_id,
       CAST({_TS} < {_PIV} AS INTEGER) AS is_before,
       CAST({_TS} > {_PIV} AS INTEGER) AS is_after,
       CAST(date_diff('second', {_PIV}, {_TS}) AS INTEGER) AS secs_from_pivot,
       split_part(action_time, ' ', 1) || '_' || split_part(split_part(action_time, ' ', 2), ':', 1) AS date_hour,
       strftime({_TS}, '%Y-%m-%d %H:%M:%S') AS time_text,
       strftime({_TS}, '%Y%m%d') AS date_key,
       strftime(strptime(strftime({_TS}, '%Y%m%d'), '%Y%m%d'), '%Y-%m-%d') AS date_back,
       strftime({_TS}, '%Y%m%d%H%M') AS time_minute,
       CAST(coalesce(search_keyword, '') = '' AS INTEGER) AS kw_empty,
       regexp_replace(',' || coalesce(order_category_ids, '') || ',', '^,|,$', '', 'g') AS trimmed,
       CASE WHEN length(CAST(page_id AS VARCHAR)) = 2 THEN CAST(page_id AS VARCHAR)
            ELSE '0' || CAST(page_id AS VARCHAR) END AS filled,
       NULLIF(regexp_extract({_REC}, '(^|[|])kw=([^|=]+)([|]|$)', 2), '') AS kw_field,
       NULLIF(regexp_extract({_REC}, '(^|[|])page=([^|=]+)([|]|$)', 2), '') AS page_field,
       regexp_replace({_REC}, '(^|[|])page=[^|]*', '\\1page=x') AS record_set,
       CAST(city_id AS VARCHAR) || ':' || date AS city_info,
       json_extract_string('{{"k": ' || CAST(page_id AS VARCHAR) || '}}', '$.k') AS json_k,
       CAST((200 * page_id + 3) // 6 AS DOUBLE) / 100.0 AS third
  FROM va""")


# ---- dynamic blacklist: three batches by event_id, newest first; each is filtered by the list as it
# stood before the batch, then adds the users whose running count passes the threshold

_BATCH = "2 - event_id * 3 // ((SELECT max(event_id) FROM events) + 1)"
_NEXT = """SELECT user_id FROM {old} UNION
SELECT user_id FROM (SELECT strftime(make_timestamp(timestamp_ms * 1000), '%Y%m%d') AS d, user_id, ad_id, count(*) AS n
                       FROM ({kept}) k GROUP BY 1, 2, 3) c WHERE n > {limit}"""
DYN_CTES = AD_CTES + [
    ("arrived", f"""SELECT {_BATCH} AS batch, epoch_us(ts) // 1000 AS timestamp_ms, CAST(user_id % 10 AS VARCHAR) AS province,
       'c_' || CAST(event_id % 3 AS VARCHAR) AS city, CAST(user_id AS BIGINT) AS user_id, CAST(k % 20 AS BIGINT) AS ad_id,
       strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y%m%d') AS date_key FROM ev"""),
    ("k0", "SELECT * FROM arrived WHERE batch = 0 AND user_id NOT IN (SELECT user_id FROM bl)"),
    ("l1", _NEXT.format(old="bl", kept="SELECT * FROM k0", limit=AD_THRESHOLD)),
    ("k1", "SELECT * FROM arrived WHERE batch = 1 AND user_id NOT IN (SELECT user_id FROM l1)"),
    ("l2", _NEXT.format(old="l1", kept="SELECT * FROM k0 UNION ALL SELECT * FROM k1", limit=AD_THRESHOLD)),
    ("k2", "SELECT * FROM arrived WHERE batch = 2 AND user_id NOT IN (SELECT user_id FROM l2)"),
    ("dadf", "SELECT * FROM k0 UNION ALL SELECT * FROM k1 UNION ALL SELECT * FROM k2"),
    ("dstat", "SELECT date_key, province, city, ad_id, count(*) AS click_count FROM dadf GROUP BY 1, 2, 3, 4"),
    ("dmin", "SELECT timestamp_ms // 60000 AS m, ad_id, count(*) AS n FROM dadf GROUP BY 1, 2"),
]
for _k, _sql in {
    "stream_dynamic_ad_stat": "SELECT * FROM dstat",
    "stream_dynamic_province_top3": """SELECT date_key, province, ad_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY date_key, province ORDER BY click_count DESC, ad_id) AS rn
    FROM (SELECT date_key, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
            FROM dstat GROUP BY 1, 2, 3) a) r WHERE rn <= 3""",
    "stream_dynamic_click_trend": """SELECT strftime(make_timestamp(m * 60000000), '%Y%m%d') AS date,
       strftime(make_timestamp(m * 60000000), '%H') AS hour,
       strftime(make_timestamp(m * 60000000), '%M') AS minute, ad_id, n AS click_count FROM dmin""",
    "stream_dynamic_recent_hour": """SELECT strftime(make_timestamp(s * 60000000), '%Y-%m-%d %H:%M') AS window_start,
       strftime(make_timestamp((s + 60) * 60000000), '%Y-%m-%d %H:%M') AS window_end,
       ad_id, CAST(sum(n) AS BIGINT) AS click_count
  FROM (SELECT m - j.range AS s, ad_id, n FROM dmin CROSS JOIN range(0, 60) j) w
 GROUP BY s, ad_id""",
}.items():
    register(_k, _sql, DYN_CTES)
