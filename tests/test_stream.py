"""Stream = batch: replay events in several files (out of order), and restart from the checkpoint."""

import os
import shutil

from pyspark.sql import functions as F

from clickscope.operators import ads as ADS
from clickscope.plans.catalog import fixtures
from clickscope.streaming import ad_stream as ST
from tests.conftest import SF_SMALL, rows_of


def _split_events(spark, tmp_path, parts):
    src = str(tmp_path / "src")
    os.makedirs(src)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    # three files, newest first, so the replay sees rows out of order across batches
    for i, cond in enumerate(parts):
        d = str(tmp_path / f"part{i}")
        ev.where(cond).coalesce(1).write.parquet(d)
        f = [x for x in os.listdir(d) if x.endswith(".parquet")][0]
        shutil.copy(os.path.join(d, f), os.path.join(src, f"events_{i}.parquet"))
    return src


def test_stream_equals_batch_across_batches_and_restart(spark, tmp_path):
    t = fixtures(spark, SF_SMALL)
    day = F.dayofmonth("ts")
    src = _split_events(spark, tmp_path, [day > 20, (day > 10) & (day <= 20), day <= 10])
    root = str(tmp_path / "out")
    cfg = ST.StreamConfig(source_dir=src, file_glob="events_*.parquet", max_files_per_trigger=1)
    ckpt = str(tmp_path / "ckpt")
    ST.run_ad_stat(spark, cfg, root, blacklist=t.blacklist, checkpoint=ckpt)
    # restart on the same checkpoint: nothing new, nothing counted twice
    ST.run_ad_stat(spark, cfg, root, blacklist=t.blacklist, checkpoint=ckpt)
    got = ST.read_table(spark, root, "ad_stat")
    want = ADS.ad_stat(ADS.ad_blacklist_filter(ADS.ad_log_parse(t.ad_lines), t.blacklist))
    assert rows_of(got) == rows_of(want)


def test_stream_blacklist_multi_batch(spark, tmp_path):
    t = fixtures(spark, SF_SMALL)
    day = F.dayofmonth("ts")
    src = _split_events(spark, tmp_path, [day <= 15, day > 15])
    root = str(tmp_path / "bl")
    cfg = ST.StreamConfig(source_dir=src, file_glob="events_*.parquet", max_files_per_trigger=1)
    ST.run_blacklist(spark, cfg, root, seed=t.blacklist, threshold=1)
    got = rows_of(ST.read_table(spark, root, "blacklist"))
    parsed = ADS.ad_blacklist_filter(ADS.ad_log_parse(t.ad_lines), t.blacklist)
    want = rows_of(t.blacklist.unionByName(ADS.ad_blacklist(ADS.ad_user_click_count(parsed), 1)).distinct())
    assert got == want


def test_processing_time_trigger(spark, tmp_path):
    t = fixtures(spark, SF_SMALL)
    root = str(tmp_path / "pt")
    cfg = ST.StreamConfig(source_dir=SF_SMALL, processing_time="1 second")
    q = ST.run_click_trend(spark, cfg, root, blacklist=t.blacklist, checkpoint=str(tmp_path / "ck"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = ST.read_table(spark, root, "click_trend")
    want = ADS.ad_click_trend(ADS.ad_blacklist_filter(ADS.ad_log_parse(t.ad_lines), t.blacklist))
    assert rows_of(got) == rows_of(want)


def test_killed_between_sink_write_and_offset_commit(spark, tmp_path, monkeypatch):
    """A query under a processing-time trigger dies after a batch is in its tables and before its offsets are; started
    again on the checkpoint it runs that batch once more, and the totals are those of the batch SQL."""
    import pytest
    t = fixtures(spark, SF_SMALL)
    day = F.dayofmonth("ts")
    src = _split_events(spark, tmp_path, [day > 20, (day > 10) & (day <= 20), day <= 10])
    root, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    cfg = ST.StreamConfig(source_dir=src, file_glob="events_*.parquet", max_files_per_trigger=1, processing_time="0 seconds")
    write, tries = ST._add_ad_stat, []

    def dies(stat, batch, kept):
        write(stat, batch, kept)
        tries.append(batch)
        if tries == [0, 1]:
            raise RuntimeError("killed")

    monkeypatch.setattr(ST, "_add_ad_stat", dies)
    q = ST.run_ad_stat(spark, cfg, root, blacklist=t.blacklist, checkpoint=ckpt)
    with pytest.raises(Exception, match="killed"):
        q.processAllAvailable()
    q = ST.run_ad_stat(spark, cfg, root, blacklist=t.blacklist, checkpoint=ckpt)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert tries == [0, 1, 1, 2]
    want = ADS.ad_stat(ADS.ad_blacklist_filter(ADS.ad_log_parse(t.ad_lines), t.blacklist))
    assert rows_of(ST.read_table(spark, root, "ad_stat")) == rows_of(want)


def test_dead_letters_of_a_stream_are_kept_apart_and_once(spark, tmp_path):
    """Short lines, words for numbers, empty lines and repeated ones; a second run on the checkpoint adds nothing."""
    good = "1700000000000 p c 5 6"
    lines = [good, good, "1700000000000 p", "1700000000000 p", "x p c 5 6", "1700000000000 p c 5 z", "", "1700000000000 p c 5 6 more"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(str(tmp_path / "in"))
    cfg = ST.StreamConfig(source_dir=str(tmp_path / "in"), text_lines=True)
    for _ in range(2):
        ST.run_dynamic(spark, cfg, str(tmp_path / "out"), checkpoint=str(tmp_path / "ckpt"), outputs=("ad_stat",))
    assert rows_of(ST.read_table(spark, str(tmp_path / "out"), "dead_letters")) == [
        ("", "short", 1), ("1700000000000 p", "short", 2), ("1700000000000 p c 5 z", "number", 1), ("x p c 5 6", "number", 1)]
    assert rows_of(ST.read_table(spark, str(tmp_path / "out"), "ad_stat")) == [("20231114", "p", "c", 6, 3)]
