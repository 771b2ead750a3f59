"""Delta tables: every kind against a replay by hand, retries, writes that do not finish, folds, folders read."""

import random

import pytest
from pyspark.sql import functions as F

from clickscope.sinks.deltas import DeltaTable
from clickscope.streaming import ad_stream as ST
from tests.conftest import rows_of

SCHEMA = "day string, province string, ad_id long, click_count long"


def _table(spark, root, kind, fold_every=32):
    schema = spark.createDataFrame([], SCHEMA).schema
    keys = {"add": ["day", "province", "ad_id"], "replace": ["day", "province", "ad_id"], "group": ["day", "province"], "rows": None}[kind]
    return DeltaTable(spark, str(root), schema, kind, keys, F.col("day"), fold_every)


def _replay(kind, batches):
    """The table after these batches, in plain Python."""
    state = {}
    for rows in batches:
        if kind == "group":
            groups = {r[:2] for r in rows}
            state = {k: v for k, v in state.items() if k[:2] not in groups}
        for r in rows:
            key = r if kind == "rows" else r[:3]
            state[key] = state.get(key, 0) + r[3] if kind == "add" else r[3]
    return sorted(k if kind == "rows" else (*k, v) for k, v in state.items())


def _batch(rng):
    keys = {(f"2024010{rng.randint(1, 4)}", rng.choice("ab"), rng.randint(1, 4)) for _ in range(rng.randint(0, 12))}
    return [(*k, rng.randint(1, 9)) for k in sorted(keys)]


@pytest.mark.parametrize("kind", ["add", "replace", "group", "rows"])
def test_batches_with_retries_and_folds(spark, tmp_path, kind):
    """Folds every 2 batches; every other batch is tried twice, the first time with other rows and days; one id has a
    gap of several folds before it. For one kind every batch is a process that opens the table anew."""
    rng = random.Random(kind)
    table, done = _table(spark, tmp_path, kind, 2), []
    seed = _batch(rng) + [("20240101", "z", 9, 1)]
    table.seed(spark.createDataFrame(seed, SCHEMA))
    table.seed(spark.createDataFrame([("20240101", "no", 1, 1)], SCHEMA))  # seeded already
    done.append(seed)
    for batch in (0, 1, 2, 9):
        for rows in (_batch(rng), _batch(rng))[batch % 2:]:
            if kind == "add":
                table = _table(spark, tmp_path, kind, 2)
            table.write(batch, spark.createDataFrame(rows, SCHEMA))
        assert rows_of(table.before(batch)) == _replay(kind, done)
        done.append(rows)
        assert rows_of(_table(spark, tmp_path, kind, 2).read()) == _replay(kind, done), batch


def test_retry_with_fewer_days_leaves_nothing_of_the_first_attempt(spark, tmp_path):
    table = _table(spark, tmp_path, "add")
    table.write(1, spark.createDataFrame([("20240101", "a", 1, 5)], SCHEMA))
    table.write(2, spark.createDataFrame([("20240101", "a", 1, 7), ("20240102", "a", 1, 1)], SCHEMA))
    table.write(2, spark.createDataFrame([("20240102", "a", 1, 2)], SCHEMA))
    assert rows_of(table.read()) == [("20240101", "a", 1, 5), ("20240102", "a", 1, 2)]
    table.write(2, spark.createDataFrame([], SCHEMA))
    assert rows_of(table.read()) == [("20240101", "a", 1, 5)]


def _failing(spark, rows):
    """Rows of which the last raises while it is written."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    bad = F.when(F.col("click_count") < 0, F.raise_error(F.lit("lost"))).otherwise(F.col("province"))
    return df.withColumn("province", bad.cast("string"))


@pytest.mark.parametrize("batch", [2, 4])  # within a fold, and the batch that folds
def test_write_that_does_not_finish_changes_nothing(spark, tmp_path, batch):
    table = _table(spark, tmp_path, "add", 4)
    for b in (0, 1):
        table.write(b, spark.createDataFrame([("20240101", "a", 1, 5)], SCHEMA))
    with pytest.raises(Exception, match="lost"):
        table.write(batch, _failing(spark, [("20240101", "a", 1, 3), ("20240102", "a", 1, -1)]))
    for again in (table, _table(spark, tmp_path, "add", 4)):
        assert rows_of(again.read()) == [("20240101", "a", 1, 10)]
    table.write(batch, spark.createDataFrame([("20240102", "a", 1, 4)], SCHEMA))
    assert rows_of(_table(spark, tmp_path, "add", 4).read()) == [("20240101", "a", 1, 10), ("20240102", "a", 1, 4)]


def test_fold_that_does_not_finish_is_made_again(spark, tmp_path, monkeypatch):
    table = _table(spark, tmp_path, "add", 2)
    for b in (0, 1, 2, 3):
        table.write(b, spark.createDataFrame([("20240101", "a", b, 5)], SCHEMA))
    want, put = rows_of(table.read()), table._put
    for stop in ("base/", "deltas/slot=0", "deltas/slot=0/batch"):
        def failing(df, folder, stop=stop):
            if folder.startswith(stop):
                raise RuntimeError("executor lost")
            put(df, folder)
        monkeypatch.setattr(table, "_put", failing)
        with pytest.raises(RuntimeError):
            table.write(4, spark.createDataFrame([("20240101", "a", 9, 1)], SCHEMA))
        assert rows_of(_table(spark, tmp_path, "add", 2).read()) == want
    again = _table(spark, tmp_path, "add", 2)
    again.write(4, spark.createDataFrame([("20240101", "a", 9, 1)], SCHEMA))
    assert rows_of(again.read()) == sorted([*want, ("20240101", "a", 9, 1)])


def test_touched_reads_only_the_days_of_the_batch(spark, tmp_path):
    table = _table(spark, tmp_path, "add")
    table.write(1, spark.createDataFrame([(f"202401{d:02d}", "a", 1, d) for d in range(1, 29)], SCHEMA))
    delta = spark.createDataFrame([("20240103", "a", 1, 1), ("20240104", "b", 1, 1)], SCHEMA)
    table.write(2, delta)
    found = table.touched(delta, table.keys, table.span(delta))
    assert rows_of(found) == [("20240103", "a", 1, 4), ("20240104", "b", 1, 1)]
    p = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in p and "20240104" in p


def test_folded_deltas_are_gone(spark, tmp_path):
    """Folders of at most two folds stay, whatever the number of batches."""
    table = _table(spark, tmp_path, "add", 2)
    for b in range(5):
        table.write(b, spark.createDataFrame([("20240101", "a", 1, 1)], SCHEMA))
    assert rows_of(table.read()) == [("20240101", "a", 1, 5)]
    kept = sorted(f.name for f in (tmp_path / "deltas").glob("slot=*/batch=*"))
    assert kept == ["batch=2", "batch=3", "batch=4"]


def test_unknown_kinds_and_outputs(spark, tmp_path):
    with pytest.raises(ValueError):
        DeltaTable(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema, "merge")
    with pytest.raises(ValueError):
        ST.run_dynamic(spark, ST.StreamConfig(source_dir=str(tmp_path)), str(tmp_path), outputs=("ad_stats",))
