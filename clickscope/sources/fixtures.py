"""Clickstream tables derived from the generated test tables in ``<sf_dir>/*.parquet``.

``user_visit_action`` comes from ``events``, ``user_info`` from ``customer``,
``product_info`` from ``part`` and the ad log lines from ``events`` again. All derivations
are narrow projections (no shuffle), so they scale with the input. Integer arithmetic only;
the session time zone must be UTC (``runtime.use_utc``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The epoch (2024-01-01 00:00:00 UTC) that anchors session blocks.
EPOCH0 = 1704067200


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _event_keys(events: DataFrame) -> DataFrame:
    """Add k (number in props) and e (event epoch seconds)."""
    return events.select(
        "event_id", "user_id", "event_type", "ts",
        F.expr("try_cast(regexp_extract(props, '([0-9]+)', 1) as bigint)").alias("k"),
        F.expr("unix_seconds(cast(ts as timestamp))").alias("e"),
    )


def user_visit_action(events: DataFrame) -> DataFrame:
    """events -> user_visit_action (one action per event; sessions are user x time block)."""
    # span = block length in seconds (1, 3, 7 or 30 days by user); dv = time compression.
    base = _event_keys(events).select(
        "*",
        F.expr("case user_id % 4 when 0 then 86400 when 1 then 259200 when 2 then 604800 "
               "else 2592000 end").alias("span"),
        F.expr("case (user_id div 4) % 6 when 0 then 10 when 1 then 100 when 2 then 400 "
               "when 3 then 1000 when 4 then 4000 else 10000 end").alias("dv"),
    )
    # bi = block number; r = seconds into the block; tsec = block start + r div dv + hour shift.
    # (same values as EPOCH0 + bi*span + (e - EPOCH0 - bi*span) div dv + ..., written compactly so
    # that a date predicate pushed below this projection stays a small expression)
    blocks = base.select(
        "*",
        F.expr(f"(e - {EPOCH0}) div span").alias("bi"),
        F.expr(f"pmod(e - {EPOCH0}, span)").alias("r"),
    )
    timed = blocks.select(
        "*", F.expr("e - r + r div dv + (user_id % 20) * 3600").alias("tsec"))
    is_click = F.col("event_type") == "click"
    is_buy = F.col("event_type") == "purchase"
    even = F.col("event_id") % 2 == 0
    prod = (F.col("event_id") % 100)
    return timed.select(
        F.date_format(F.timestamp_seconds("tsec"), "yyyy-MM-dd").alias("date"),
        F.col("user_id").cast("bigint").alias("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("_"), F.col("bi").cast("string")).alias("session_id"),
        (F.col("k") % 10).cast("bigint").alias("page_id"),
        F.date_format(F.timestamp_seconds("tsec"), "yyyy-MM-dd HH:mm:ss").alias("action_time"),
        F.when(F.col("event_type") == "view",
               F.concat(F.lit("kw"), (F.col("k") % 10).cast("string"))).alias("search_keyword"),
        F.when(is_click, F.col("k")).otherwise(F.lit(-1)).cast("bigint").alias("click_category_id"),
        F.when(is_click, prod).otherwise(F.lit(-1)).cast("bigint").alias("click_product_id"),
        F.when(is_buy & even, F.concat(F.col("k").cast("string"), F.lit(","),
                                       ((F.col("k") + 7) % 100).cast("string"))).alias("order_category_ids"),
        F.when(is_buy & even, prod.cast("string")).alias("order_product_ids"),
        F.when(is_buy & ~even, F.col("k").cast("string")).alias("pay_category_ids"),
        F.when(is_buy & ~even, prod.cast("string")).alias("pay_product_ids"),
        (F.col("event_id") % 10).cast("bigint").alias("city_id"),
        F.col("event_id").cast("bigint").alias("event_id"),
    )


def user_info(customer: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    return customer.select(
        c.cast("bigint").alias("user_id"),
        F.concat(F.lit("user"), c.cast("string")).alias("username"),
        F.col("c_name").alias("name"),
        ((c * 7) % 60).cast("int").alias("age"),
        F.concat(F.lit("professional"), (c % 100).cast("string")).alias("professional"),
        F.concat(F.lit("city"), F.col("c_nationkey").cast("string")).alias("city"),
        F.when(c % 2 == 0, F.lit("male")).otherwise(F.lit("female")).alias("sex"),
    )


def product_info(part: DataFrame) -> DataFrame:
    p = F.col("p_partkey")
    return part.select(
        p.cast("bigint").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), (p % 2).cast("string"), F.lit("}")).alias("extend_info"),
    )


def ad_log_lines(events: DataFrame, *keep: str) -> DataFrame:
    """events -> ``value`` lines ``timestamp_ms province city userid adid`` (space separated)."""
    keyed = events.select(
        "event_id", "user_id",
        F.expr("try_cast(regexp_extract(props, '([0-9]+)', 1) as bigint)").alias("k"),
        F.expr("unix_millis(cast(ts as timestamp))").alias("ms"),
    )
    return keyed.select(*keep, F.concat_ws(
        " ",
        F.col("ms").cast("string"),
        (F.col("user_id") % 10).cast("string"),
        F.concat(F.lit("c_"), (F.col("event_id") % 3).cast("string")),
        F.col("user_id").cast("string"),
        (F.col("k") % 20).cast("string"),
    ).alias("value"))


def damaged_ad_log_lines(events: DataFrame) -> DataFrame:
    """The lines of ad_log_lines(); of every 16 events one is cut after three fields, one has a user that is no
    number, one a time that is none, and one is empty."""
    kind = F.col("event_id") % 16
    line = ad_log_lines(events.select("event_id", "user_id", "props", "ts"), "event_id")
    parts = F.split("value", " ")
    part = lambda i: F.get(parts, F.lit(i))
    return line.select(
        F.when(kind == 3, F.concat_ws(" ", part(0), part(1), part(2)))
        .when(kind == 6, F.concat_ws(" ", part(0), part(1), part(2), F.concat(F.lit("u"), part(3)), part(4)))
        .when(kind == 9, F.concat_ws(" ", F.lit("now"), part(1), part(2), part(3), part(4)))
        .when(kind == 12, F.lit("")).otherwise(F.col("value")).alias("value"))


def ad_blacklist_seed(events: DataFrame) -> DataFrame:
    """Fixture blacklist: every event user whose id is a multiple of 7."""
    return events.where(F.col("user_id") % 7 == 0).select(
        F.col("user_id").cast("bigint").alias("user_id")).distinct()


class FixtureTables:
    """Lazily built fixture DataFrames for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return read(self.spark, self.sf_dir, name)

    @property
    def actions(self) -> DataFrame:
        return user_visit_action(self.raw("events"))

    @property
    def users(self) -> DataFrame:
        return user_info(self.raw("customer"))

    @property
    def products(self) -> DataFrame:
        return product_info(self.raw("part"))

    @property
    def ad_lines(self) -> DataFrame:
        return ad_log_lines(self.raw("events"))

    @property
    def blacklist(self) -> DataFrame:
        return ad_blacklist_seed(self.raw("events"))
