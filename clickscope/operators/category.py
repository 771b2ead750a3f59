"""Popular categories and their most active sessions.

Scale notes
- Click, order and pay counts come from ONE pass: every action emits (category, kind)
  pairs, the pairs are exploded and counted with conditional aggregates. This replaces a
  distinct universe plus three left joins (four shuffles) with one partial + final hash
  aggregate; a hot category is pre-aggregated map-side.
- The top-N list is ``orderBy(...).limit(n)`` -> ``TakeOrderedAndProject`` (each task keeps
  n rows). It holds at most n rows, so broadcasting it for the semi join is a proven bound.
- Top sessions per category use ``row_number() <= n``; Catalyst adds a partial
  ``WindowGroupLimit`` before the shuffle, so a hot category ships at most n rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.functions.columns import split_ids
from clickscope.params import DEFAULT_TASK_ID

CLICK, ORDER, PAY = 0, 1, 2


def _category_events(actions: DataFrame, *keep: str) -> DataFrame:
    """(category_id, kind, *keep) for every click, every ordered id and every paid id
    (duplicates kept)."""
    def tagged(arr, kind):
        return F.transform(arr, lambda c: F.struct(c.alias("category_id"), F.lit(kind).alias("kind")))

    click = F.when(F.col("click_category_id") != -1, F.array(F.col("click_category_id"))) \
        .otherwise(F.array().cast("array<bigint>"))
    order = F.coalesce(split_ids("order_category_ids"), F.array().cast("array<bigint>"))
    pay = F.coalesce(split_ids("pay_category_ids"), F.array().cast("array<bigint>"))
    events = F.concat(tagged(click, CLICK), tagged(order, ORDER), tagged(pay, PAY))
    return actions.select(*keep, F.explode(events).alias("ev")).select("ev.category_id", "ev.kind", *keep)


def category_click_count(actions: DataFrame) -> DataFrame:
    """AGG8: clicks per category."""
    return (actions.where(F.col("click_category_id") != -1)
            .groupBy(F.col("click_category_id").alias("category_id"))
            .agg(F.count(F.lit(1)).alias("click_count")))


def _exploded_count(actions: DataFrame, col: str, out: str) -> DataFrame:
    return (actions.where(F.col(col).isNotNull())
            .select(F.explode(split_ids(col)).alias("category_id"))
            .groupBy("category_id").agg(F.count(F.lit(1)).alias(out)))


def category_order_count(actions: DataFrame) -> DataFrame:
    """AGG9: ordered ids per category (a list counts each of its items)."""
    return _exploded_count(actions, "order_category_ids", "order_count")


def category_pay_count(actions: DataFrame) -> DataFrame:
    """AGG10: paid ids per category."""
    return _exploded_count(actions, "pay_category_ids", "pay_count")


def category_universe(actions: DataFrame) -> DataFrame:
    """AGG11: every category clicked, ordered or paid."""
    return _category_events(actions).select("category_id").distinct()


def category_full_count(actions: DataFrame) -> DataFrame:
    """JN3-JN5: click, order and pay counts per category of the universe (absent -> 0)."""
    k = F.col("kind")
    return _category_events(actions).groupBy("category_id").agg(
        F.count_if(k == CLICK).alias("click_count"),
        F.count_if(k == ORDER).alias("order_count"),
        F.count_if(k == PAY).alias("pay_count"),
    )


def top10_category(full_count: DataFrame, n: int = 10, taskid: str = DEFAULT_TASK_ID) -> DataFrame:
    """SRT1: top n by (click, order, pay) descending; ties by category id ascending."""
    top = full_count.orderBy(F.col("click_count").desc(), F.col("order_count").desc(),
                             F.col("pay_count").desc(), F.col("category_id").asc()).limit(int(n))
    return top.select(F.lit(taskid).alias("taskid"), "category_id", "click_count",
                      "order_count", "pay_count")


def category_session_count(actions: DataFrame, top_categories: DataFrame) -> DataFrame:
    """FLT11 + AGG12: clicks per (category, session) for the top categories only."""
    # top_categories comes from top10_category: at most n rows.
    top_ids = F.broadcast(top_categories.select(F.col("category_id").alias("click_category_id")))
    return (actions.join(top_ids, "click_category_id", "left_semi")
            .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def top10_active_session(category_sessions: DataFrame, n: int = 10,
                         taskid: str = DEFAULT_TASK_ID) -> DataFrame:
    """WIN3: per category the n sessions with most clicks; ties by session id ascending."""
    w = Window.partitionBy("category_id").orderBy(F.col("click_count").desc(),
                                                  F.col("session_id").asc())
    return (category_sessions.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= int(n))
            .select(F.lit(taskid).alias("taskid"), "category_id", "session_id", "click_count"))


def category_session_matrix(actions: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Click, order and pay counts per (category, session) in one pass over the actions, of the given
    ``sessions`` only.

    The top-N categories and the per-session click counts are both derived from this one
    aggregate, so a pipeline that needs both reads and filters the actions once (the two
    consumers share its exchange). Sessions are chosen after counting: a session with very many
    actions is then one row per category, and raw actions are not shuffled by session at all."""
    k = F.col("kind")
    matrix = _category_events(actions, "session_id").groupBy("category_id", "session_id").agg(
        F.count_if(k == CLICK).alias("click_count"),
        F.count_if(k == ORDER).alias("order_count"),
        F.count_if(k == PAY).alias("pay_count"),
    )
    return matrix if sessions is None else matrix.join(sessions.select("session_id"), "session_id", "left_semi")


def full_count_from_matrix(matrix: DataFrame) -> DataFrame:
    """category_full_count from the (category, session) matrix."""
    return matrix.groupBy("category_id").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("click_count", "order_count", "pay_count")])


def session_count_from_matrix(matrix: DataFrame, top_categories: DataFrame) -> DataFrame:
    """category_session_count from the matrix: clicked (category, session) pairs of the top list."""
    top_ids = F.broadcast(top_categories.select("category_id"))  # at most n rows
    return (matrix.where(F.col("click_count") > 0).join(top_ids, "category_id", "left_semi")
            .select("category_id", "session_id", "click_count"))


def single_count_from_matrix(matrix: DataFrame, count: str) -> DataFrame:
    """AGG8-AGG10 from the matrix: one of click_count, order_count, pay_count per category that has any."""
    return (matrix.where(F.col(count) > 0).groupBy("category_id").agg(F.sum(count).cast("bigint").alias(count)))
