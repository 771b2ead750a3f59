"""Scans of the clickstream tables (SRC1-SRC6).

Production tables are parquet folders or catalog tables; when ``user_visit_action`` is
written partitioned by ``date`` the date predicate below prunes partitions, otherwise it is
pushed into the parquet reader as a row-group filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope import schemas


def read_table(spark: SparkSession, source: str, schema=None, fmt: str = "parquet") -> DataFrame:
    """A path (parquet/orc/json/csv) or a catalog table name."""
    if "/" not in source and ":" not in source:
        return spark.table(source)
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "parquet":
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.load(source)


def visit_actions(actions: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """SRC1/SRC2: actions whose ``date`` string lies in [start_date, end_date] (inclusive)."""
    return actions.where(F.col("date").between(F.lit(start_date), F.lit(end_date)))


def city_click_products(actions: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """SRC3: click actions in the date range, pruned to (city_id, click_product_id)."""
    return (visit_actions(actions, start_date, end_date)
            .where(F.col("click_product_id") != -1)
            .select("city_id", "click_product_id"))


def city_area(spark: SparkSession, rows=None) -> DataFrame:
    """SRC6: the city -> area dimension; the default is the fixed 10-row list."""
    rows = schemas.CITY_AREA_ROWS if rows is None else rows
    return spark.createDataFrame([(int(a), b, c) for a, b, c in rows], schemas.CITY_AREA)
