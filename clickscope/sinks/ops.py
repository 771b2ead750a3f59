"""Sink operations (SNK1-SNK7).

The keyed operations are pure ``(old table, batch) -> new table`` DataFrame functions, for tables that are
rewritten whole; ``deltas`` keeps the same results without rewriting. Every one of them is a
union plus an aggregate or an anti join on the keys, so they partition by key and a hot key
is pre-aggregated map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_add(old: DataFrame, delta: DataFrame, keys: list[str], value: str = "click_count") -> DataFrame:
    """SNK3: missing key -> insert, present key -> value + delta."""
    cols = keys + [value]
    return (old.select(*cols).unionByName(delta.select(*cols))
            .groupBy(*keys).agg(F.sum(value).cast("bigint").alias(value)))


def _without(old: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``old`` whose key is not in ``batch``; a null key equals a null key."""
    seen = batch.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return old.join(seen, same, "left_anti")


def upsert_replace(old: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """SNK4/SNK5: rows of the batch replace rows with the same key; other rows stay."""
    kept = _without(old, delta, keys)
    return delta.select(*old.columns).unionByName(kept)


def replace_group(old: DataFrame, batch: DataFrame, group_keys: list[str]) -> DataFrame:
    """SNK6: every group present in the batch is deleted and re-inserted from the batch."""
    kept = _without(old, batch, group_keys)
    return batch.select(*old.columns).unionByName(kept)


def blacklist_insert(old: DataFrame, users: DataFrame) -> DataFrame:
    """SNK7: add users not yet listed (idempotent, no duplicates)."""
    new = _without(users.select("user_id").distinct(), old, ["user_id"])
    return old.select("user_id").unionByName(new)


def append(df: DataFrame, target: str, fmt: str = "parquet", options: dict | None = None) -> None:
    """SNK1: append rows. ``fmt='jdbc'`` with url/dbtable/user/password options writes to a
    database (the driver jar must be on the classpath); otherwise a file format or, when
    ``target`` has no '/', a catalog table."""
    writer = df.write.mode("append")
    if fmt == "jdbc":
        writer.format("jdbc").options(**(options or {})).save()
    elif "/" not in target and ":" not in target:
        writer.saveAsTable(target)
    else:
        writer.format(fmt).options(**(options or {})).save(target)


def overwrite(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    """SNK2: drop and recreate the table with the rows of ``df``."""
    writer = df.write.mode("overwrite")
    if "/" not in target and ":" not in target:
        writer.saveAsTable(target)
    else:
        writer.format(fmt).save(target)
