"""Ad-click statistics as DataFrame -> DataFrame functions, shared by batch and streaming.

Scale notes
- Every count is a partial + final hash aggregate, so a hot user, ad or province is
  combined map-side before the shuffle.
- The blacklist grows with the number of users, so the anti join carries no broadcast
  hint; the optimizer and AQE choose from its measured size.
- The 60-minute sliding window is computed from per-minute counts: raw rows are first
  reduced to one row per (minute, ad), those are shuffled once by (ad, day), and windows
  come into being only after that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def ad_log_parse(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """PRJ3/PRJ4: 'timestamp_ms province city userid adid' -> typed columns + yyyyMMdd date key.

    A missing or non-numeric field is null; ``parsable`` tells such rows apart."""
    columns = _parsed_columns(F.col(value_col))
    return lines.select(*[c.alias(name) for name, c in columns.items()])


def _parsed_columns(value: F.Column) -> dict[str, F.Column]:
    parts = F.split(value, " ")
    number = lambda i: F.get(parts, F.lit(i)).try_cast("bigint")
    return {"timestamp_ms": number(0), "province": F.get(parts, F.lit(1)), "city": F.get(parts, F.lit(2)), "user_id": number(3),
            "ad_id": number(4), "date_key": F.date_format(F.timestamp_millis(number(0)), "yyyyMMdd")}


def parsable() -> F.Column:
    """True where every field of a parsed line is present."""
    return F.array_position(F.array(*[F.col(c).isNull() for c in (
        "timestamp_ms", "province", "city", "user_id", "ad_id")]), True) == 0


def ad_log_checked(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """The parsed columns of ``ad_log_parse`` beside the raw line and ``fault``: null for a good line, else
    ``short`` (fewer than five fields, or none) or ``number`` (a field that must be a number is not)."""
    raw = lines.select(F.col(value_col).alias("value"))
    fields = F.size(F.split(F.coalesce(F.col("value"), F.lit("")), " "))
    return (raw.withColumns(_parsed_columns(F.col("value")))
            .withColumn("fault", F.when(fields < 5, F.lit("short")).when(~parsable(), F.lit("number"))))


def ad_parsed(checked: DataFrame) -> DataFrame:
    """PRJ3: the good lines, typed."""
    return checked.where("fault is null").drop("value", "fault")


def ad_dead_letters(checked: DataFrame) -> DataFrame:
    """PRJ3: the lines that do not parse, as they came: value, fault and how often."""
    return checked.where("fault is not null").groupBy("value", "fault").agg(F.count(F.lit(1)).alias("line_count"))


def with_event_time(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("event_time", F.timestamp_millis("timestamp_ms"))


def ad_blacklist_filter(parsed: DataFrame, blacklist: DataFrame) -> DataFrame:
    """FLT14/JN9: drop lines of blacklisted users."""
    return parsed.join(blacklist.select("user_id"), "user_id", "left_anti")


def ad_user_click_count(filtered: DataFrame) -> DataFrame:
    """AGG18: clicks per (date, user, ad)."""
    return filtered.groupBy("date_key", "user_id", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))


def ad_blacklist(user_counts: DataFrame, threshold: int = 100) -> DataFrame:
    """FLT15 + AGG21: users with more than ``threshold`` clicks on one ad in one day."""
    return user_counts.where(F.col("click_count") > int(threshold)).select("user_id").distinct()


def ad_stat(filtered: DataFrame) -> DataFrame:
    """AGG19: clicks per (date, province, city, ad)."""
    return filtered.groupBy("date_key", "province", "city", "ad_id").agg(
        F.count(F.lit(1)).alias("click_count"))


def ad_province_count(stat: DataFrame) -> DataFrame:
    """AGG20: re-aggregate city counts to (date, province, ad)."""
    return stat.groupBy("date_key", "province", "ad_id").agg(
        F.sum("click_count").cast("bigint").alias("click_count"))


def ad_province_top3(province_counts: DataFrame, n: int = 3) -> DataFrame:
    """WIN2: per (date, province) the n ads with most clicks; ties by ad id."""
    w = Window.partitionBy("date_key", "province").orderBy(F.col("click_count").desc(),
                                                           F.col("ad_id").asc())
    return (province_counts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= int(n))
            .select("date_key", "province", "ad_id", "click_count"))


def _minute(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("_minute", F.expr("timestamp_ms div 60000"))


def ad_click_trend(filtered: DataFrame) -> DataFrame:
    """STR6 (batch form): clicks per (minute, ad) with the minute split into date/hour/minute."""
    per_min = _minute(filtered).groupBy("_minute", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))
    t = F.timestamp_seconds(F.col("_minute") * 60)
    return per_min.select(F.date_format(t, "yyyyMMdd").alias("date"),
                          F.date_format(t, "HH").alias("hour"),
                          F.date_format(t, "mm").alias("minute"),
                          "ad_id", "click_count")


MINUTES_A_DAY = 1440


def windows_from_minutes(per_min: DataFrame, window_minutes: int = 60, slide_minutes: int = 1,
                         only_flagged: str | None = None) -> DataFrame:
    """(minute, ad_id, n) per-minute counts -> (window_start, window_end, ad_id, click_count) for
    every sliding window that starts on a ``slide_minutes`` boundary and contains a minute.

    The sum over a window changes only where a minute enters or leaves it. Per ad and day of the window's start,
    a range frame sums the window that starts at each of these points, and the windows up to the next point
    share that sum. The minutes of the first window length of a day also go to the day before; nothing else is
    copied before the shuffle. With ``only_flagged``, keep just the windows holding a minute whose flag
    column is 1. Rows without a minute are in no window."""
    if window_minutes % slide_minutes:
        raise ValueError("window must be a multiple of the slide")
    chunk = MINUTES_A_DAY * -(-window_minutes // MINUTES_A_DAY)
    own = F.floor(F.col("minute") / chunk).cast("bigint")
    flag = F.col(only_flagged).cast("int") if only_flagged else F.lit(1)
    rows = (per_min.where(F.col("minute").isNotNull())
            .select("ad_id", F.col("minute").cast("bigint").alias("_minute"), F.col("n").cast("bigint").alias("_n"), flag.alias("_f"),
                    own.alias("_own"), F.when(F.col("minute") - own * chunk < window_minutes - 1, own - 1).alias("_edge")))
    dealt = (rows.unpivot(["ad_id", "_minute", "_n", "_f"], ["_own", "_edge"], "_which", "_chunk")
             .where(F.col("_chunk").isNotNull()).repartition("ad_id", "_chunk"))
    m, zero, null = F.col("_minute"), F.lit(0).cast("bigint"), F.lit(None).cast("int")
    points = dealt.select("ad_id", "_chunk", F.inline(F.array(
        F.struct(m.alias("_at"), F.col("_n").alias("_n"), F.col("_f").alias("_f")),
        F.struct((m - window_minutes + 1).alias("_at"), zero.alias("_n"), null.alias("_f")),
        F.struct((m + 1).alias("_at"), zero.alias("_n"), null.alias("_f")))))
    order = Window.partitionBy("ad_id", "_chunk").orderBy("_at")
    frame = order.rangeBetween(0, window_minutes - 1)
    sums = points.select("ad_id", "_chunk", "_at", F.lead("_at").over(order).alias("_next"),
                         F.sum("_n").over(frame).alias("click_count"), F.max("_f").over(frame).alias("_f"))
    low = F.greatest(F.col("_at"), F.col("_chunk") * chunk)
    low = low + F.pmod(-low, F.lit(slide_minutes))
    high = F.least(F.col("_next"), (F.col("_chunk") + 1) * chunk) - 1
    agg = (sums.where((F.col("_f") == 1) & (F.col("_next") > F.col("_at"))).withColumns({"_low": low, "_high": high})
           .where(F.col("_low") <= F.col("_high"))
           .select("ad_id", "click_count", F.explode(F.sequence("_low", "_high", F.lit(slide_minutes).cast("bigint"))).alias("_start")))
    return agg.select(window_label(F.col("_start")).alias("window_start"),
                      window_label(F.col("_start") + window_minutes).alias("window_end"),
                      "ad_id", "click_count")


def window_label(epoch_minute) -> F.Column:
    return F.date_format(F.timestamp_seconds(epoch_minute * 60), "yyyy-MM-dd HH:mm")


def ad_recent_hour(filtered: DataFrame, window_minutes: int = 60, slide_minutes: int = 1) -> DataFrame:
    """STR5 / AGG22 (batch form): clicks per ad in every sliding window of ``window_minutes``
    that starts on a ``slide_minutes`` boundary, labelled by window start and end."""
    per_min = (_minute(filtered).groupBy(F.col("_minute").alias("minute"), "ad_id")
               .agg(F.count(F.lit(1)).alias("n")))
    return windows_from_minutes(per_min, window_minutes, slide_minutes)
