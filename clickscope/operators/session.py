"""Session analytics: roll-up, user join, filter, length distribution, stratified sample.

Scale notes
- ``session_summary`` is one hash aggregate on ``session_id``. ``collect_set`` runs as a
  partial (map-side) aggregate, so a hot session reaches the final task as at most one
  small set per map task, never as its raw rows.
- ``session_aggr_stat`` is a global aggregate: one partial row per task, one final row.
- ``session_passing`` decides on a session without building its lists; only outputs that show
  lists build them, for their own sessions.
- ``session_sample`` counts the sessions of an hour by the leading bits of a hash and ranks only
  those up to the bin that fills the quota, so no task sorts a whole hour.
- ``session_filtered_actions`` drops most actions of other sessions by a bitmap of fixed size before
  the shuffle and leaves hot sessions to AQE's skew-join split (see its docstring).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.functions import columns as C
from clickscope.params import DEFAULT_TASK_ID, TaskParams

# Visit-length buckets in seconds, (name, low, high, low_inclusive); high None = open.
VISIT_BUCKETS = [
    ("visit_length_1s_3s", 1, 3, True),
    ("visit_length_4s_6s", 4, 6, True),
    ("visit_length_7s_9s", 7, 9, True),
    ("visit_length_10s_30s", 10, 30, True),
    ("visit_length_30s_60s", 30, 60, False),
    ("visit_length_1m_3m", 60, 180, False),
    ("visit_length_3m_10m", 180, 600, False),
    ("visit_length_10m_30m", 600, 1800, False),
    ("visit_length_30m", 1800, None, False),
]
# Step-length buckets in actions, same layout.
STEP_BUCKETS = [
    ("step_length_1_3", 1, 3, True),
    ("step_length_4_6", 4, 6, True),
    ("step_length_7_9", 7, 9, True),
    ("step_length_10_30", 10, 30, True),
    ("step_length_30_60", 30, 60, False),
    ("step_length_60", 60, None, False),
]

SUMMARY_COLUMNS = ["session_id", "user_id", "search_keywords", "click_category_ids",
                   "visit_length", "step_length", "start_time"]
USER_COLUMNS = ["age", "professional", "sex", "city"]
DETAIL_COLUMNS = ["user_id", "session_id", "page_id", "action_time", "search_keyword",
                  "click_category_id", "click_product_id", "order_category_ids",
                  "order_product_ids", "pay_category_ids", "pay_product_ids"]


def _bucket(col, low, high, low_inclusive):
    cond = (col >= low) if low_inclusive else (col > low)
    if high is not None:
        cond = cond & (col <= high)
    return cond


def _join_or_null(arr):
    return F.when(F.size(arr) > 0, F.array_join(arr, ","))


def session_summary(actions: DataFrame) -> DataFrame:
    """AGG1: one row per session.

    user_id is the smallest user id seen, lists are distinct and sorted (categories
    numerically), null when empty; visit_length is whole seconds between the first and
    last action; step_length counts actions.
    """
    ts = C.parse_time("action_time")
    kw = F.when(C.is_not_empty("search_keyword"), F.col("search_keyword"))
    cat = F.when(F.col("click_category_id") != -1, F.col("click_category_id"))
    agg = actions.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min(ts).alias("_start"),
        F.max(ts).alias("_end"),
        F.count(F.lit(1)).alias("step_length"),
        F.array_sort(F.collect_set(kw)).alias("_kws"),
        F.array_sort(F.collect_set(cat)).alias("_cats"),
    )
    return agg.select(
        "session_id",
        "user_id",
        _join_or_null(F.col("_kws")).alias("search_keywords"),
        _join_or_null(F.transform("_cats", lambda x: x.cast("string"))).alias("click_category_ids"),
        (F.unix_seconds("_end") - F.unix_seconds("_start")).alias("visit_length"),
        "step_length",
        C.format_time("_start").alias("start_time"),
    )


def session_full_info(summary: DataFrame, users: DataFrame) -> DataFrame:
    """JN1: inner join with the user dimension; sessions of unknown users drop out.

    No broadcast hint: the user table grows with the data, so the join strategy is left to
    the optimizer's size estimate and AQE's runtime statistics.
    """
    return summary.join(users.select("user_id", *USER_COLUMNS), "user_id", "inner").select(
        *SUMMARY_COLUMNS, *USER_COLUMNS)


def _overlap(list_col, values) -> F.Column:
    wanted = F.array(*[F.lit(str(v)) for v in values])
    return F.coalesce(F.arrays_overlap(F.split(list_col, ","), wanted), F.lit(False))


def _user_predicates(params: TaskParams) -> F.Column:
    """FLT1-FLT5: AND of the optional predicates on the user's columns."""
    cond = F.lit(True)
    if params.start_age is not None and params.end_age is not None:
        cond = cond & F.col("age").between(params.start_age, params.end_age)
    if params.professionals:
        cond = cond & F.col("professional").isin(list(params.professionals))
    if params.cities:
        cond = cond & F.col("city").isin(list(params.cities))
    if params.sex:
        cond = cond & (F.col("sex") == params.sex)
    return F.coalesce(cond, F.lit(False))


def session_filter(full: DataFrame, params: TaskParams) -> DataFrame:
    """FLT1-FLT7 over sessions with their lists: AND of the optional predicates; an unset parameter
    passes everything."""
    cond = _user_predicates(params)
    if params.keywords:
        cond = cond & _overlap("search_keywords", params.keywords)
    if params.category_ids:
        cond = cond & _overlap("click_category_ids", params.category_ids)
    return full.where(cond)


def session_facts(actions: DataFrame, params: TaskParams = TaskParams()) -> DataFrame:
    """AGG1 without the lists: one row of fixed size per session, with the keyword and category predicates
    of ``params`` as booleans ``has_keyword`` and ``has_category`` that hold if any action has them."""
    ts = C.parse_time("action_time")
    hits = []
    if params.keywords:
        hits.append(F.bool_or(_overlap("search_keyword", params.keywords) & C.is_not_empty("search_keyword")).alias("has_keyword"))
    if params.category_ids:
        wanted = [str(c) for c in params.category_ids]
        hit = (F.col("click_category_id") != -1) & F.col("click_category_id").cast("string").isin(wanted)
        hits.append(F.bool_or(F.coalesce(hit, F.lit(False))).alias("has_category"))
    agg = actions.groupBy("session_id").agg(F.min("user_id").alias("user_id"), F.min(ts).alias("_start"), F.max(ts).alias("_end"),
                                            F.count(F.lit(1)).alias("step_length"), *hits)
    return agg.select("session_id", "user_id", (F.unix_seconds("_end") - F.unix_seconds("_start")).alias("visit_length"),
                      "step_length", C.format_time("_start").alias("start_time"), *[c for c in agg.columns if c.startswith("has_")])


def session_passing(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """JN1 + FLT1-FLT7: the sessions that pass, without their lists. The same sessions as
    ``session_filter(session_full_info(session_summary(actions), users), params)``."""
    facts = session_facts(actions, params)
    for hit in ("has_keyword", "has_category"):
        if hit in facts.columns:
            facts = facts.where(F.col(hit)).drop(hit)
    # no broadcast hint: the user table grows with the data
    return facts.join(users.select("user_id", *USER_COLUMNS).where(_user_predicates(params)), "user_id", "inner").select(
        *facts.columns, *USER_COLUMNS)


def session_aggr_stat(filtered: DataFrame, taskid: str = DEFAULT_TASK_ID) -> DataFrame:
    """AGG2-AGG5: session count and the share of sessions per length bucket (2 decimals, HALF_UP).

    A session of 0 s is in no visit bucket. With no session the row reads count 0 and all
    shares 0.0.
    """
    v, s = F.col("visit_length"), F.col("step_length")
    buckets = [(n, _bucket(v, lo, hi, inc)) for n, lo, hi, inc in VISIT_BUCKETS]
    buckets += [(n, _bucket(s, lo, hi, inc)) for n, lo, hi, inc in STEP_BUCKETS]
    counts = filtered.agg(F.count(F.lit(1)).alias("session_count"),
                          *[F.count_if(c).alias(n) for n, c in buckets])
    denom = F.greatest(F.col("session_count"), F.lit(1)).cast("double")
    return counts.select(
        F.lit(taskid).alias("taskid"),
        F.col("session_count"),
        *[F.round(F.col(n) / denom, 2).alias(f"{n}_ratio") for n, _ in buckets],
    )


def _with_date_hour(df: DataFrame) -> DataFrame:
    st = F.col("start_time")
    return df.withColumn("date", F.substring_index(st, " ", 1)).withColumn(
        "hour", F.substring_index(F.substring_index(st, " ", -1), ":", 1))


def session_hour_counts(filtered: DataFrame) -> DataFrame:
    """AGG6: sessions per (date, hour) of their start time."""
    return (_with_date_hour(filtered).groupBy("date", "hour")
            .agg(F.count(F.lit(1)).alias("session_count")))


def sample_quotas(filtered: DataFrame, total: int = 100) -> DataFrame:
    """AGG7 + quota rule: per-day quota = total div days; per-hour quota =
    min(hour count, hour count * per-day quota div day count).

    Output has one row per (date, hour) present, so its size is bounded by the date range
    times 24, independent of the number of sessions.
    """
    return _quotas(session_hour_counts(filtered).withColumnRenamed("session_count", "hour_count"), total)


def _quotas(hours: DataFrame, total: int) -> DataFrame:
    """hours: date, hour, hour_count; at most 24 rows a day."""
    q = hours.select(
        "date", "hour", "hour_count",
        F.sum("hour_count").over(Window.partitionBy("date")).alias("day_count"),
        F.size(F.collect_set("date").over(Window.partitionBy())).cast("bigint").alias("days"),
    )
    per_day = F.expr(f"{int(total)} div days")
    return q.select("date", "hour", "hour_count", "day_count", "days",
                    F.least(F.col("hour_count"), F.expr(f"hour_count * ({int(total)} div days) div day_count")).alias("quota"),
                    per_day.alias("per_day"))


# The leading bits of the md5 by which sessions of an hour are counted: 4 hex digits.
SAMPLE_DIGITS = 4


def session_sample(passing: DataFrame, total: int = 100, seed: str = "0") -> DataFrame:
    """WIN5: (session_id, start_time) of a stratified sample by (date, hour) of the start: the sessions with the
    smallest md5(session_id || seed) of every hour, as many as its quota.

    A histogram of the md5's leading bits per hour (at most 65,536 short rows each, combined before the shuffle)
    gives the bin in which the quota is reached. Only sessions at or below that bin are ranked: the quota and
    what shares its last bin, however many sessions the hour holds.
    """
    digest = F.md5(F.concat(F.col("session_id"), F.lit(str(seed))))
    bin_ = F.coalesce(F.conv(F.substring("_md5", 1, SAMPLE_DIGITS), 16, 10).cast("int"), F.lit(-1))
    s = (_with_date_hour(passing.select("session_id", "start_time")).withColumn("_md5", digest).withColumn("_bin", bin_))
    bins = s.groupBy("date", "hour", "_bin").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("date", "hour").orderBy("_bin")
    bins = bins.select("date", "hour", "_bin", F.sum("n").over(upto).alias("upto"), F.sum("n").over(Window.partitionBy("date", "hour")).alias("hour_count"))
    quotas = _quotas(bins.select("date", "hour", "hour_count").distinct(), total).select("date", "hour", "quota")
    cuts = (bins.join(F.broadcast(quotas), ["date", "hour"]).where("quota > 0 and upto >= quota")
            .groupBy("date", "hour", "quota").agg(F.min("_bin").alias("_cut")))
    # quotas and cuts have at most (days in range) x 24 rows: a proven bound, safe to broadcast.
    near = s.join(F.broadcast(cuts), ["date", "hour"]).where(F.col("_bin") <= F.col("_cut"))
    rank = F.row_number().over(Window.partitionBy("date", "hour").orderBy("_md5"))
    return near.withColumn("_rk", rank).where(F.col("_rk") <= F.col("quota")).select("session_id", "start_time")


def session_random_extract(passing: DataFrame, total: int = 100, seed: str = "0", taskid: str = DEFAULT_TASK_ID,
                           actions: DataFrame | None = None) -> DataFrame:
    """WIN5 with the lists of the sampled sessions: built from their ``actions`` alone if given, else taken from
    ``passing``."""
    sample = session_sample(passing, total, seed)
    ids = F.broadcast(sample.select("session_id"))  # at most `total` rows
    full = passing if actions is None else session_summary(actions.join(ids, "session_id", "left_semi"))
    if actions is None:
        full = full.join(ids, "session_id", "left_semi")
    return full.select(F.lit(taskid).alias("taskid"), "session_id", "start_time", "search_keywords", "click_category_ids")


def session_extract_detail(extract: DataFrame, actions: DataFrame,
                           taskid: str = DEFAULT_TASK_ID) -> DataFrame:
    """WIN6: all actions of the sampled sessions (the sample holds at most ``total`` rows)."""
    ids = F.broadcast(extract.select("session_id").distinct())
    return actions.join(ids, "session_id", "left_semi").select(
        F.lit(taskid).alias("taskid"), *DETAIL_COLUMNS)


# Bits of the session bitmap: 2^24 are 2 MB, whatever the number of sessions. Fewer than about eight bits a kept
# session let more rows through to the join; 2^30 (128 MB) serve 130 million sessions.
SESSION_BITS = 1 << 24
_PAGE_BITS = 32768  # bits that one row of bitmap_construct_agg holds


def session_bitmap(sessions: DataFrame, bits: int = SESSION_BITS) -> DataFrame:
    """(_page, _bits): a bit for the hash of every session, in rows of 4 KB; at most ``bits`` / 32,768 rows."""
    place = F.pmod(F.xxhash64("session_id"), F.lit(int(bits))) + 1  # bucket numbers and positions start at 1
    return (sessions.select(F.bitmap_bucket_number(place).alias("_page"), F.bitmap_bit_position(place).alias("_at"))
            .groupBy("_page").agg(F.bitmap_construct_agg("_at").alias("_bits")))


def maybe_in(actions: DataFrame, bitmap: DataFrame, bits: int = SESSION_BITS) -> DataFrame:
    """Actions whose session's bit is set: all of the sessions in the bitmap, few others while it is sparse."""
    place = F.pmod(F.xxhash64("session_id"), F.lit(int(bits))) + 1
    marked = actions.withColumns({"_page": F.bitmap_bucket_number(place), "_at": F.bitmap_bit_position(place)})
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.expr("shiftright(_byte, cast(_at % 8 as int)) & 1")
    # the bitmap has a fixed number of rows of fixed size: a proven bound, safe to broadcast
    return (marked.join(F.broadcast(bitmap), "_page").withColumn("_byte", byte).where(bit == 1).select(*actions.columns))


def session_filtered_actions(actions: DataFrame, filtered: DataFrame, bits: int = SESSION_BITS) -> DataFrame:
    """JN2: actions of the sessions that passed the filter (semi join on session_id).

    A bitmap of the sessions' hashes, of fixed size, drops most actions of other sessions before the shuffle.
    Skew: the session side comes from an aggregate that is already dealt by session_id, and a join that takes it as it
    lies cannot be split by AQE. The hash beside the id makes both sides shuffle for this join, so a session with very
    many actions is split over tasks at run time, and a session is one row.
    """
    ids = filtered.select("session_id")
    kept = maybe_in(actions, session_bitmap(ids, bits), bits).withColumn("_hash", F.xxhash64("session_id"))
    return kept.join(ids.withColumn("_hash", F.xxhash64("session_id")), ["session_id", "_hash"], "left_semi").select(*actions.columns)
