"""Structured Streaming form of the ad-click statistics (STR1-STR9).

Source: Kafka when ``kafka_options`` are given (needs the Kafka connector on the
classpath), otherwise a file-source replay of ``events`` parquet files turned into ad log
lines. Each output is its own streaming query with its own checkpoint folder under the
shared checkpoint root, so offsets and state survive a restart and a lost executor.

Sinks are tables of batch deltas (``sinks.deltas``) written from ``foreachBatch``; a delta is a
folder named by the batch id, so a retried batch rewrites instead of adding twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscope.operators import ads as ADS
from clickscope.runtime import scratch_path
from clickscope.sinks.deltas import DeltaTable
from clickscope.sources.fixtures import ad_log_lines

USER_COUNT_SCHEMA = T.StructType([
    T.StructField("date_key", T.StringType()), T.StructField("user_id", T.LongType()),
    T.StructField("ad_id", T.LongType()), T.StructField("click_count", T.LongType())])
BLACKLIST_SCHEMA = T.StructType([T.StructField("user_id", T.LongType())])
AD_STAT_SCHEMA = T.StructType([
    T.StructField("date_key", T.StringType()), T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()), T.StructField("ad_id", T.LongType()),
    T.StructField("click_count", T.LongType())])
TOP3_SCHEMA = T.StructType([
    T.StructField("date_key", T.StringType()), T.StructField("province", T.StringType()),
    T.StructField("ad_id", T.LongType()), T.StructField("click_count", T.LongType())])
TREND_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()), T.StructField("hour", T.StringType()),
    T.StructField("minute", T.StringType()), T.StructField("ad_id", T.LongType()),
    T.StructField("click_count", T.LongType())])
MINUTE_SCHEMA = T.StructType([
    T.StructField("minute", T.LongType()), T.StructField("ad_id", T.LongType()),
    T.StructField("click_count", T.LongType())])
DEAD_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()), T.StructField("fault", T.StringType()),
    T.StructField("line_count", T.LongType())])
RECENT_SCHEMA = T.StructType([
    T.StructField("window_start", T.StringType()), T.StructField("window_end", T.StringType()),
    T.StructField("ad_id", T.LongType()), T.StructField("click_count", T.LongType())])



def _minute_day(minute):
    return F.date_format(F.timestamp_seconds(minute * 60), "yyyy-MM-dd")


# schema, kind, key columns and day of every output table
TABLES = {
    "blacklist": (BLACKLIST_SCHEMA, "rows", ["user_id"], None),
    "user_click_count": (USER_COUNT_SCHEMA, "add", ["date_key", "user_id", "ad_id"], lambda: F.col("date_key")),
    "ad_stat": (AD_STAT_SCHEMA, "add", ["date_key", "province", "city", "ad_id"], lambda: F.col("date_key")),
    "province_top3": (TOP3_SCHEMA, "group", ["date_key", "province"], lambda: F.col("date_key")),
    "click_trend": (TREND_SCHEMA, "add", ["date", "hour", "minute", "ad_id"], lambda: F.col("date")),
    "recent_minutes": (MINUTE_SCHEMA, "add", ["minute", "ad_id"], lambda: _minute_day(F.col("minute"))),
    "dead_letters": (DEAD_SCHEMA, "add", ["value", "fault"], None),
    "recent_hour": (RECENT_SCHEMA, "replace", ["window_start", "window_end", "ad_id"], lambda: F.substring("window_start", 1, 10)),
}


def open_table(spark: SparkSession, root: str, name: str) -> DeltaTable:
    schema, kind, keys, day = TABLES[name]
    return DeltaTable(spark, f"{root}/{name}", schema, kind, keys, day and day())


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current rows of an output table."""
    return open_table(spark, root, name).read()


@dataclass
class StreamConfig:
    """Where the stream comes from and how it is triggered."""
    source_dir: str | None = None            # file replay: folder holding events parquet
    file_glob: str = "events.parquet"
    kafka_options: dict | None = None        # e.g. {"kafka.bootstrap.servers": ..., "subscribe": ...}
    processing_time: str | None = None       # e.g. "5 seconds"; None -> availableNow (drain and stop)
    max_files_per_trigger: int | None = None
    text_lines: bool = False                 # file replay of text files that hold the log lines themselves


def ad_line_stream(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    """SRC7: streaming DataFrame with one string column ``value`` per ad log line."""
    if cfg.kafka_options:
        return (spark.readStream.format("kafka").options(**cfg.kafka_options).load()
                .selectExpr("CAST(value AS STRING) AS value"))
    if cfg.text_lines:
        reader = spark.readStream.schema("value string")
        if cfg.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
        return reader.text(cfg.source_dir)
    schema = spark.read.parquet(f"{cfg.source_dir.rstrip('/')}/{cfg.file_glob}").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", cfg.file_glob)
    if cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    return ad_log_lines(reader.parquet(cfg.source_dir))


def checked_stream(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    """PRJ3: every line with its typed columns, the raw text and its fault, if any."""
    return ADS.with_event_time(ADS.ad_log_checked(ad_line_stream(spark, cfg)))


def _each_batch(batch_fn, dead: DeltaTable, blacklist: DataFrame | None):
    """One pass over a micro-batch with two branches: good lines, less those of listed users, go to ``batch_fn``,
    the others to the dead letters. The batch is persisted, since its sinks read it several times; batches
    without rows are skipped."""
    def run(df: DataFrame, batch: int) -> None:
        df.persist()
        try:
            if not df.isEmpty():
                dead.write(batch, ADS.ad_dead_letters(df))
                good = ADS.ad_parsed(df)
                batch_fn(good if blacklist is None else ADS.ad_blacklist_filter(good, blacklist), batch)
        finally:
            df.unpersist()
    return run


def _run(spark: SparkSession, cfg: StreamConfig, root: str, batch_fn, checkpoint: str, blacklist: DataFrame | None = None):
    """Run ``batch_fn(good clicks, batch id)`` per micro-batch; ``blacklist`` is a list that stands for the whole run."""
    run = _each_batch(batch_fn, open_table(spark, root, "dead_letters"), blacklist)
    writer = (checked_stream(spark, cfg).writeStream.outputMode("append").foreachBatch(run)
              .option("checkpointLocation", checkpoint))
    if cfg.processing_time:
        writer = writer.trigger(processingTime=cfg.processing_time)
    else:
        writer = writer.trigger(availableNow=True)
    q = writer.start()
    if cfg.processing_time:
        return q
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return None


# ---- what one batch does to the tables; ``batch`` is the batch id, ``df`` its kept clicks -----

def _extend_blacklist(counts: DeltaTable, black: DeltaTable, batch: int, kept: DataFrame, threshold: int) -> None:
    """STR3: add the batch's clicks to the running counts; list every user whose count now passes the threshold."""
    delta = ADS.ad_user_click_count(kept).persist()
    try:
        counts.write(batch, delta)
        totals = counts.touched(delta, counts.keys, counts.span(delta))
        black.write(batch, ADS.ad_blacklist(totals, threshold))
    finally:
        delta.unpersist()


def _add_ad_stat(stat: DeltaTable, batch: int, kept: DataFrame) -> None:
    """STR4: cumulative clicks per (date, province, city, ad)."""
    stat.write(batch, ADS.ad_stat(kept))


def _rank_provinces(stat: DeltaTable, top: DeltaTable, batch: int, kept: DataFrame, n: int = 3) -> None:
    """STR7: rank cannot run on a streaming DataFrame, so the batch ranks the (date, province) groups it touched from
    their totals and replaces those groups."""
    groups = kept.select(*top.keys).distinct().persist()
    try:
        totals = stat.touched(groups, top.keys, stat.span(groups))
        top.write(batch, ADS.ad_province_top3(ADS.ad_province_count(totals), n))
    finally:
        groups.unpersist()


def _add_trend(trend: DeltaTable, batch: int, kept: DataFrame) -> None:
    """STR6: clicks per minute and ad; late rows add to their minute."""
    trend.write(batch, ADS.ad_click_trend(kept))


def _slide_windows(minutes: DeltaTable, recent: DeltaTable, batch: int, kept: DataFrame, window_minutes: int,
                   slide_minutes: int) -> None:
    """STR5: add the batch's minutes to the stored ones and write the windows that hold one of them anew, from the
    stored minutes of the days within a window length. The flagged minutes of the batch are found by a join on
    (minute, ad)."""
    rows = (kept.groupBy(F.expr("timestamp_ms div 60000").alias("minute"), "ad_id")
            .agg(F.count(F.lit(1)).alias("click_count")).persist())
    try:
        minutes.write(batch, rows)
        days = minutes.span(rows, early=_minute_day(F.col("minute") - window_minutes), late=_minute_day(F.col("minute") + window_minutes))
        updated = rows.select("minute", "ad_id", F.lit(1).alias("updated"))
        near = minutes.touched(rows, ["ad_id"], days).withColumnRenamed("click_count", "n").join(updated, ["minute", "ad_id"], "left")
        recent.write(batch, ADS.windows_from_minutes(near, window_minutes, slide_minutes, only_flagged="updated"))
    finally:
        rows.unpersist()


# ---- one stream per output ------------------------------------------------------------------

def run_blacklist(spark: SparkSession, cfg: StreamConfig, root: str, seed: DataFrame | None = None,
                  threshold: int = 100, checkpoint: str | None = None):
    """Per batch: drop users listed before this batch, add the batch's clicks to the running
    (date, user, ad) counts, and list every user whose running count exceeds ``threshold``.
    Tables: ``user_click_count`` and ``blacklist``, which starts as the seed."""
    return run_dynamic(spark, cfg, root, seed, threshold, checkpoint=checkpoint or f"{root}/_ckpt_blacklist", outputs=())


def run_ad_stat(spark, cfg: StreamConfig, root: str, blacklist: DataFrame | None = None,
                checkpoint: str | None = None):
    """Running totals kept in ``<root>/ad_stat``: each batch adds its counts. No state store, no
    watermark: rows of any age count."""
    stat = open_table(spark, root, "ad_stat")
    return _run(spark, cfg, root, lambda df, b: _add_ad_stat(stat, b, df), checkpoint or f"{root}/_ckpt_ad_stat", blacklist)


def run_province_top3(spark, cfg: StreamConfig, root: str, blacklist: DataFrame | None = None,
                      n: int = 3, checkpoint: str | None = None):
    """Top ``n`` ads per (date, province), from the running totals in ``<root>/ad_stat``."""
    stat, top = open_table(spark, root, "ad_stat"), open_table(spark, root, "province_top3")

    def batch(df, b):
        _add_ad_stat(stat, b, df)
        _rank_provinces(stat, top, b, df, n)

    return _run(spark, cfg, root, batch, checkpoint or f"{root}/_ckpt_top3", blacklist)


def run_click_trend(spark, cfg: StreamConfig, root: str, blacklist: DataFrame | None = None,
                    checkpoint: str | None = None):
    """Clicks per minute and ad kept in ``<root>/click_trend``."""
    trend = open_table(spark, root, "click_trend")
    return _run(spark, cfg, root, lambda df, b: _add_trend(trend, b, df), checkpoint or f"{root}/_ckpt_trend", blacklist)


def run_recent_hour(spark, cfg: StreamConfig, root: str, blacklist: DataFrame | None = None,
                    window_minutes: int = 60, slide_minutes: int = 1, checkpoint: str | None = None):
    """Sliding windows from per-minute totals in ``<root>/recent_minutes``; rows of any age."""
    minutes, recent = open_table(spark, root, "recent_minutes"), open_table(spark, root, "recent_hour")
    return _run(spark, cfg, root, lambda df, b: _slide_windows(minutes, recent, b, df, window_minutes, slide_minutes),
                checkpoint or f"{root}/_ckpt_recent", blacklist)


# ---- STR2 for every branch: per-batch blacklist, totals kept in the sink tables --------------

OUTPUTS = ("ad_stat", "province_top3", "click_trend", "recent_hour")


def run_dynamic(spark, cfg: StreamConfig, root: str, seed: DataFrame | None = None, threshold: int = 100,
                window_minutes: int = 60, slide_minutes: int = 1, checkpoint: str | None = None,
                outputs: tuple[str, ...] = OUTPUTS):
    """The original layout: one stream. Each micro-batch is filtered by the blacklist as it stood before the
    batch, feeds the wanted ``outputs``, and then extends the list. Running totals live in the delta tables, so
    there is no state store and no watermark.

    Tables under ``root``: blacklist, user_click_count and dead_letters always; ad_stat (also for province_top3), province_top3,
    click_trend, recent_minutes and recent_hour as wanted.
    """
    if set(outputs) - set(OUTPUTS):
        raise ValueError(f"unknown outputs: {sorted(set(outputs) - set(OUTPUTS))}")
    needs = {"blacklist", "user_click_count", *outputs}
    needs |= {"ad_stat"} if "province_top3" in needs else set()
    needs |= {"recent_minutes"} if "recent_hour" in needs else set()
    t = {name: open_table(spark, root, name) for name in sorted(needs)}
    t["blacklist"].seed(None if seed is None else seed.select("user_id"))

    def batch(df, b):
        kept = ADS.ad_blacklist_filter(df, t["blacklist"].before(b)).persist()
        try:
            if "ad_stat" in t:
                _add_ad_stat(t["ad_stat"], b, kept)
            if "province_top3" in t:
                _rank_provinces(t["ad_stat"], t["province_top3"], b, kept)
            if "click_trend" in t:
                _add_trend(t["click_trend"], b, kept)
            if "recent_hour" in t:
                _slide_windows(t["recent_minutes"], t["recent_hour"], b, kept, window_minutes, slide_minutes)
            _extend_blacklist(t["user_click_count"], t["blacklist"], b, kept, threshold)
        finally:
            kept.unpersist()

    return _run(spark, cfg, root, batch, checkpoint or f"{root}/_ckpt_dynamic")


def fresh_root(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)
