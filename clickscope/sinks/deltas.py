"""Keyed sink tables as plain Parquet deltas, one partition per batch, without a MERGE-capable format.

A batch writes only its own rows, as ``<root>/deltas/slot=<s>/batch=<id>/part_day=<day>``; writing the same batch
again replaces that folder, whatever days it held. The current table is an aggregate over a base and the deltas
after it: the sum per key, the row of the latest batch, the rows of the latest batch that holds a group, or the
distinct rows. Every ``fold_every`` batch ids the state so far becomes the base of the other slot and the deltas
start anew there, so a read covers at most one base and ``fold_every`` deltas.

Restarts. A batch that does not finish leaves no rows (Spark shows a written folder's files when the job commits).
A fold reads one slot and writes only the other one, and no reader looks there before the first delta of
that slot stands, so a fold that does not finish is made again by the retried batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

DAY, BATCH, SLOT = "part_day", "batch", "slot"
BASE_BATCH = -1  # the batch that rows of a base count as: older than every delta


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys; a null key equals a null key. Keeps the left columns."""
    named = right.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
                         *[c for c in right.columns if c not in keys])
    on = [left[k].eqNullSafe(named[f"_key{i}"]) for i, k in enumerate(keys)]
    return left.join(named, reduce(lambda a, b: a & b, on), how).drop(*named.columns[:len(keys)])


class DeltaTable:
    """``kind``: ``add`` (SNK3: the last column is summed per key), ``replace`` (SNK4/SNK5: the latest row of a key),
    ``group`` (SNK6: the latest batch that holds a group gives all its rows) or ``rows`` (SNK7: distinct rows).

    ``keys`` are the key columns (of ``group``: the group columns). ``day`` gives a row's day from its key columns; reads
    that name a span of days see only their folders.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, kind: str, keys: list[str] | None = None,
                 day: Column | None = None, fold_every: int = 32):
        if kind not in ("add", "replace", "group", "rows"):
            raise ValueError(f"unknown kind of table: {kind}")
        self.spark, self.root, self.schema, self.kind = spark, root.rstrip("/"), schema, kind
        self.keys = list(keys or schema.fieldNames())
        self.day = F.lit("all") if day is None else day.cast("string")
        self.fold_every = fold_every
        self._last: tuple[int, int] | None = None

    # ---- writing -------------------------------------------------------------------------

    def _put(self, df: DataFrame, folder: str) -> None:
        """One folder, by day; AQE gives a day few files and still splits a large one."""
        (df.select(*self.schema.fieldNames()).withColumn(DAY, self.day).hint("rebalance", DAY)
         .write.mode("overwrite").partitionBy(DAY).parquet(f"{self.root}/{folder}"))

    def seed(self, rows: DataFrame | None) -> None:
        """Rows that stand before the first batch; a table that already holds rows is left alone."""
        if rows is not None and self._latest() is None and self.read().isEmpty():
            self._put(rows, "base/slot=0")

    def write(self, batch: int, delta: DataFrame) -> None:
        """The rows of one batch, unique by key. Writing a batch again replaces it."""
        last = self._latest(batch)
        slot = 0 if last is None else last[1]
        if last is not None and last[0] // self.fold_every != batch // self.fold_every:
            state, slot = self._merged(self._rows(last)), 1 - slot
            self._put(state, f"base/slot={slot}")
            self._put(self.spark.createDataFrame([], self.schema), f"deltas/slot={slot}")
        self._put(delta, f"deltas/slot={slot}/{BATCH}={int(batch)}")
        self._last = (int(batch), slot)

    # ---- reading -------------------------------------------------------------------------

    def _folder(self, name: str, *parts: tuple[str, object]) -> DataFrame:
        schema = StructType(list(self.schema.fields))
        for column, kind in (*parts, (DAY, StringType())):
            schema = schema.add(column, kind)
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)  # nothing written yet

    def _latest(self, before: int | None = None) -> tuple[int, int] | None:
        """(batch, slot) of the latest delta, below ``before`` if given: the footers of one fold's files at most, or what
        this object wrote last."""
        if self._last is not None and (before is None or self._last[0] < before):
            return self._last
        deltas = self._folder("deltas", (SLOT, IntegerType()), (BATCH, LongType()))
        if before is not None:
            deltas = deltas.where(F.col(BATCH) < before)
        top = deltas.agg(F.max(F.struct(BATCH, SLOT)).alias("top")).first()["top"]
        return None if top is None else (top[BATCH], top[SLOT])

    def _rows(self, last: tuple[int, int] | None) -> DataFrame:
        """Base and deltas up to ``last``, with columns batch and part_day."""
        batch, slot = last or (BASE_BATCH, 0)
        base = self._folder("base", (SLOT, IntegerType())).where(F.col(SLOT) == slot).withColumn(BATCH, F.lit(BASE_BATCH).cast("long"))
        deltas = (self._folder("deltas", (SLOT, IntegerType()), (BATCH, LongType()))
                  .where((F.col(SLOT) == slot) & (F.col(BATCH) <= batch)))
        columns = [*self.schema.fieldNames(), BATCH, DAY]
        return base.select(*columns).unionByName(deltas.select(*columns))

    def _merged(self, rows: DataFrame) -> DataFrame:
        names = self.schema.fieldNames()
        if self.kind == "add":
            value = names[-1]
            out = rows.groupBy(*self.keys).agg(F.sum(value).cast(self.schema[value].dataType).alias(value))
        elif self.kind == "replace":
            rest = [n for n in names if n not in self.keys]
            out = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), BATCH).alias("_new")).select(*self.keys, "_new.*")
        elif self.kind == "group":
            newest = rows.groupBy(*self.keys).agg(F.max(BATCH).alias("_newest"))
            kept = [F.col(f"_g{i}").eqNullSafe(F.col(k)) for i, k in enumerate(self.keys)] + [F.col("_newest") == F.col(BATCH)]
            newest = newest.select("_newest", *[F.col(k).alias(f"_g{i}") for i, k in enumerate(self.keys)])
            out = rows.join(newest, reduce(lambda a, b: a & b, kept), "left_semi")
        else:
            out = rows.select(*names).distinct()
        return out.select(*names)

    def read(self) -> DataFrame:
        """The current table."""
        return self._merged(self._rows(self._latest()))

    def before(self, batch: int) -> DataFrame:
        """The table as it stood before ``batch``, also while that batch is written again."""
        return self._merged(self._rows(self._latest(batch)))

    def touched(self, by: DataFrame, columns: list[str], days: tuple[str | None, str | None, bool] | None = None) -> DataFrame:
        """The current rows whose ``columns`` occur in ``by``; ``days`` (see span()) narrows the folders read."""
        rows = self._rows(self._latest())
        if days is not None:
            low, high, null = days
            rows = rows.where(F.col(DAY).between(low, high) | (F.col(DAY).isNull() & F.lit(null)))
        return self._merged(same_keys(rows, by.select(*columns).distinct(), columns, "left_semi"))

    def span(self, delta: DataFrame, early: Column | None = None, late: Column | None = None) -> tuple[str | None, str | None, bool]:
        """First and last day of the rows of a batch, and whether some have none: one row, whatever the batch holds.
        ``early`` and ``late`` replace the day at either end."""
        r = delta.agg(F.min(self.day if early is None else early).alias("a"), F.max(self.day if late is None else late).alias("b"),
                      F.coalesce(F.bool_or(self.day.isNull()), F.lit(False)).alias("n")).first()
        return r["a"], r["b"], r["n"]
