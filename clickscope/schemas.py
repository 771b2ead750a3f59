"""Declared schemas of the clickstream tables and the ad log, plus the city dimension."""

from __future__ import annotations

from pyspark.sql import types as T

USER_VISIT_ACTION = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.StringType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
    # Not in the original schema: a tie-break for actions with equal time in a session.
    T.StructField("event_id", T.LongType()),
])

USER_INFO = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("professional", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("sex", T.StringType()),
])

PRODUCT_INFO = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("extend_info", T.StringType()),
])

CITY_AREA = T.StructType([
    T.StructField("city_id", T.LongType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("area", T.StringType()),
])

AD_LOG = T.StructType([
    T.StructField("timestamp_ms", T.LongType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("ad_id", T.LongType()),
])

# The default city -> area dimension (city_id, city_name, area), kept as in
# the original program. Callers may pass their own dimension instead.
CITY_AREA_ROWS = [
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
]

# Area -> level mapping (A: 华北 华东, B: 华中 华南, C: 西南 西北, else D).
AREA_LEVELS = [
    ("华北", "A_Level"),
    ("华东", "A_Level"),
    ("华中", "B_Level"),
    ("华南", "B_Level"),
    ("西南", "C_Level"),
    ("西北", "C_Level"),
]
AREA_LEVEL_DEFAULT = "D_Level"
