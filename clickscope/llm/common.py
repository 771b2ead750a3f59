"""Helpers shared by the operators: words, single evaluation, lineage cuts, size-checked joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.runtime import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# A table is broadcast only after its rows were counted and found to be at most this many.
BROADCAST_ROWS = 20_000


def words_of(text: Column) -> Column:
    """The words of a text in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, although body may use it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row.

    A plain projection may be merged into the next one by the optimizer, and an expression used inside
    a lambda is then evaluated for every element. A generator is never merged.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def hidden(docs: DataFrame) -> list[Column]:
    """The columns of docs under names that clash with no other; shown() gives them back."""
    return [F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate(docs.columns)]


def shown(docs: DataFrame, **changed: Column) -> list[Column]:
    return [changed.get(c, F.col(f"_in{i}")).alias(c) for i, c in enumerate(docs.columns)]


def settle(df: DataFrame, name: str, compression: str = "zstd", passing: list[str] | None = None) -> DataFrame:
    """Cut the lineage: write df under the shared checkpoint folder and read it back.

    The written table survives the loss of any executor, and its size is known to the planner. Its folder is
    added to `passing`, if given, for discard().
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", compression).parquet(path)
    if passing is not None:
        passing.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, passing: list[str]) -> None:
    """Delete tables that settle() wrote, once whatever was made of them is settled itself."""
    for path in map(spark._jvm.org.apache.hadoop.fs.Path, passing):
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    passing.clear()


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only where a count shows at most `rows` rows; otherwise a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def row_key(df: DataFrame) -> list[Column]:
    """Two independent 64-bit hashes of the whole row, nulls marked: equal only for repeated rows."""
    cells = [c for name in df.columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    return [F.xxhash64(*cells), F.xxhash64(F.lit(0x9E3779B9), *cells)]
