"""Top clicked products per area.

Scale notes
- The default city dimension has a fixed 10 rows, so it is broadcast; a caller-supplied
  dimension is joined without a hint and the optimizer/AQE pick the strategy from its size.
- (area, product) counts are a partial + final hash aggregate; ``collect_set`` of city
  labels is bounded by the number of cities per area.
- The product dimension grows with the data: no broadcast hint.
- ``row_number() <= n`` per area gets a partial ``WindowGroupLimit`` before the shuffle,
  so a hot area never ships more than n rows per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.functions import columns as C
from clickscope.params import DEFAULT_TASK_ID
from clickscope.schemas import AREA_LEVEL_DEFAULT, AREA_LEVELS


def area_click_basic(clicks: DataFrame, city_area: DataFrame, dimension_is_small: bool = True) -> DataFrame:
    """JN6: (city_id, click_product_id) clicks joined with the city -> area dimension."""
    dim = F.broadcast(city_area) if dimension_is_small else city_area
    return clicks.join(dim, "city_id", "inner").select(
        "city_id", "city_name", "area", F.col("click_product_id").alias("product_id"))


def area_product_click_count(basic: DataFrame) -> DataFrame:
    """AGG16/AGG17: clicks per (area, product) and the distinct 'city_id:city_name' list."""
    return basic.groupBy("area", "product_id").agg(
        F.count(F.lit(1)).alias("click_count"),
        C.group_concat_distinct(C.concat_long_string("city_id", "city_name", ":")).alias("city_infos"),
    )


def area_product_info(counts: DataFrame, products: DataFrame) -> DataFrame:
    """JN7 + PRJ8: add product name and status ('Self' when extend_info.product_status = '0')."""
    status = F.when(C.get_json_field("extend_info", "product_status") == "0", F.lit("Self")) \
        .otherwise(F.lit("Third Party"))
    return counts.join(products, counts["product_id"] == products["product_id"], "inner").select(
        counts["area"], counts["product_id"], counts["click_count"], counts["city_infos"],
        products["product_name"], status.alias("product_status"))


def area_level(area_col) -> F.Column:
    """PRJ7: area -> A/B/C/D level."""
    return reduce(lambda acc, kv: acc.when(area_col == kv[0], F.lit(kv[1])),
                  AREA_LEVELS[1:], F.when(area_col == AREA_LEVELS[0][0], F.lit(AREA_LEVELS[0][1]))
                  ).otherwise(F.lit(AREA_LEVEL_DEFAULT))


def area_top3_product(info: DataFrame, n: int = 3, taskid: str = DEFAULT_TASK_ID) -> DataFrame:
    """WIN1 + FLT16: per area the n products with most clicks; ties by product id."""
    w = Window.partitionBy("area").orderBy(F.col("click_count").desc(), F.col("product_id").asc())
    return (info.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= int(n))
            .select(F.lit(taskid).alias("taskid"), "area", area_level(F.col("area")).alias("area_level"),
                    "product_id", "city_infos", "click_count", "product_name", "product_status"))
