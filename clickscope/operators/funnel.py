"""Page-flow conversion along a target path.

Scale notes
- Consecutive pages per session need the session's actions in time order. The default
  ``page_transitions`` cuts all actions into ranges of (session, time, tie) and links rows inside a
  range and then across its ends, so one session may fill many tasks. ``page_transitions_window``
  is the plain window form, used as a cross-check.
- Pairs are cut to the target path (broadcast: its size is the parameter's length) before
  counting, and the count is a partial + final hash aggregate.
- Rates are computed over at most len(path) rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickscope.functions import columns as C
from clickscope.params import DEFAULT_TASK_ID

def _ordered(actions: DataFrame) -> DataFrame:
    """Session, time in seconds, tie-breaker (event_id, else page_id) and page."""
    tie = "event_id" if "event_id" in actions.columns else "page_id"
    return actions.select("session_id", F.unix_seconds(C.parse_time("action_time")).alias("t"),
                          F.col(tie).alias("tie"), "page_id")


def page_transitions_window(actions: DataFrame) -> DataFrame:
    """WIN4 (window form): (session, page, next page) in (time, event_id) order. A next page that is
    null gives no pair; null sessions form one group."""
    w = Window.partitionBy("session_id").orderBy("t", "tie")
    return (_ordered(actions)
            .select("session_id", F.col("page_id").alias("from_page"),
                    F.lead("page_id").over(w).alias("to_page"))
            .where(F.col("to_page").isNotNull()))


def page_transitions(actions: DataFrame, parts: int | None = None) -> DataFrame:
    """WIN4: (session, page, next page) in (time, event_id) order, whatever the length of a session; the same rows
    as the window form.

    The rows are cut into ranges of (session, time, tie), as many as there are shuffle partitions or ``parts``; a
    cut may fall anywhere, also inside one second of one session. ``lead`` links the rows of a range, and the last row of
    every range is linked to the first row of the next one."""
    keys = ["session_id", "t", "tie"]
    ordered = _ordered(actions)
    ranged = ordered.repartitionByRange(*([int(parts)] if parts else []), *keys).withColumn("_range", F.spark_partition_id())
    w = Window.partitionBy("_range").orderBy(*keys)
    linked = ranged.select(
        "_range", "session_id", "page_id", F.lead("page_id").over(w).alias("_page"), F.lead("session_id").over(w).alias("_session"),
        F.lag(F.lit(1)).over(w).isNull().alias("_first"), F.lead(F.lit(1)).over(w).isNull().alias("_last"))
    same = F.col("session_id").eqNullSafe(F.col("_session")) & F.col("_page").isNotNull()
    inner = linked.where(~F.col("_last") & same).select("session_id", F.col("page_id").alias("from_page"), F.col("_page").alias("to_page"))
    row = F.struct("session_id", "page_id")
    # one row per range: as many as shuffle partitions, whatever the data
    ends = (linked.where("_first or _last").groupBy("_range")
            .agg(F.max(F.when(F.col("_first"), row)).alias("a"), F.max(F.when(F.col("_last"), row)).alias("b")))
    after = Window.orderBy("_range")
    cross = (ends.select("b.session_id", F.col("b.page_id").alias("page_id"), F.lead("a").over(after).alias("n"))
             .where(F.col("n").isNotNull() & F.col("session_id").eqNullSafe(F.col("n.session_id")) & F.col("n.page_id").isNotNull())
             .select("session_id", F.col("page_id").alias("from_page"), F.col("n.page_id").alias("to_page")))
    return inner.unionByName(cross)


def target_path(spark: SparkSession, flow) -> DataFrame:
    """PRJ12: (step, from_page, to_page, page_split) for consecutive pages of the target flow."""
    flow = [int(p) for p in flow]
    rows = [(i + 1, a, b, f"{a}_{b}") for i, (a, b) in enumerate(zip(flow[:-1], flow[1:]))]
    schema = "step int, from_page bigint, to_page bigint, page_split string"
    return spark.createDataFrame(rows, schema)


def page_split_count(transitions: DataFrame, path: DataFrame) -> DataFrame:
    """FLT12 + AGG13: count of each target pair; one row per path step, absent pairs count 0."""
    wanted = F.broadcast(path.select("from_page", "to_page").distinct())
    counts = (transitions.join(wanted, ["from_page", "to_page"], "left_semi")
              .groupBy("from_page", "to_page").agg(F.count(F.lit(1)).alias("split_count")))
    return (F.broadcast(path).join(counts, ["from_page", "to_page"], "left")
            .select("step", "page_split", F.coalesce("split_count", F.lit(0)).cast("bigint")
                    .alias("split_count")))


def start_page_count(actions: DataFrame, start_page: int) -> DataFrame:
    """FLT13 + AGG14: number of actions (not sessions) on the first page of the path."""
    return actions.agg(F.count_if(F.col("page_id") == int(start_page)).alias("start_page_count"))


def page_convert_rate(actions: DataFrame, flow, transitions: DataFrame | None = None) -> DataFrame:
    """AGG15: rate_1 = n_1 / start count, rate_i = n_i / n_(i-1); zero denominator -> null."""
    spark = actions.sparkSession
    path = target_path(spark, flow)
    if transitions is None:
        transitions = page_transitions(actions)
    splits = page_split_count(transitions, path)
    start = start_page_count(actions, list(flow)[0]).select(
        F.lit(0).alias("step"), F.lit("start").alias("page_split"),
        F.col("start_page_count").alias("split_count"))
    # at most len(flow) rows: a single ordered window is fine.
    w = Window.orderBy("step")
    chained = splits.unionByName(start).select(
        "step", "page_split", "split_count",
        F.try_divide(F.col("split_count").cast("double"),
                     F.lag("split_count").over(w).cast("double")).alias("convert_rate"))
    return chained.where(F.col("step") > 0)


def page_convert_rate_string(rates: DataFrame, taskid: str = DEFAULT_TASK_ID) -> DataFrame:
    """PRJ11: one row 'a_b=rate|b_c=rate|...' ordered by step."""
    item = F.struct("step", F.concat(F.col("page_split"), F.lit("="),
                                     F.coalesce(F.col("convert_rate").cast("string"), F.lit("null"))).alias("s"))
    agg = rates.agg(F.array_sort(F.collect_list(item)).alias("_items"))
    return agg.select(F.lit(taskid).alias("taskid"),
                      F.array_join(F.transform("_items", lambda x: x["s"]), "|").alias("convert_rate"))
