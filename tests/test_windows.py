"""Sliding windows by range frames: against counting by hand, and the plan that makes them."""

import random
import re

import pytest
from pyspark.sql import functions as F

from clickscope.operators import ads as ADS
from tests.conftest import rows_of


def _by_hand(rows, window, slide, flagged):
    out = {}
    for minute, ad, n, f in rows:
        if minute is None:
            continue
        start = minute - minute % slide
        while start > minute - window:
            old = out.get((start, ad), (0, 0))
            out[start, ad] = (old[0] + n, max(old[1], f))
            start -= slide
    return sorted((s, ad, n) for (s, ad), (n, f) in out.items() if f or not flagged)


@pytest.mark.parametrize("window,slide", [(60, 1), (60, 15), (10, 10), (1, 1), (1440, 60), (3000, 500)])
@pytest.mark.parametrize("flagged", [False, True])
def test_windows_equal_counting_by_hand(spark, window, slide, flagged):
    rng = random.Random(window * slide)
    minutes = [0, 1, 59, 60, 1380, 1381, 1382, 1439, 1440, 1441, 1499, 1500, 2879, 2880, -1, -60, -1440, 29_000_000]
    minutes += [rng.randrange(-3000, 6000) for _ in range(40)]
    rows = [(m, ad, rng.randint(1, 9), rng.randint(0, 1)) for m in sorted(set(minutes)) for ad in (1, None, 7) if rng.random() < 0.7]
    rows += [(None, 1, 5, 1)]
    df = spark.createDataFrame(rows, "minute long, ad_id long, n long, flag int")
    got = ADS.windows_from_minutes(df, window, slide, "flag" if flagged else None)
    start = F.unix_timestamp(F.to_timestamp("window_start", "yyyy-MM-dd HH:mm")) / 60
    end = F.unix_timestamp(F.to_timestamp("window_end", "yyyy-MM-dd HH:mm")) / 60
    assert got.where(end - start != window).count() == 0
    key = lambda r: (r[0], r[1] is None, r[1] or 0)
    assert sorted((tuple(r) for r in got.select(start.cast("long"), "ad_id", "click_count").collect()), key=key) == sorted(
        _by_hand([(m, a, n, f) for m, a, n, f in rows if a is not None], window, slide, flagged)
        + _by_hand([(m, None, n, f) for m, a, n, f in rows if a is None], window, slide, flagged), key=key)


def test_nothing_is_exploded_below_a_shuffle(spark):
    lines = spark.createDataFrame([(f"{1700000000000 + i * 60000} p c {i % 5} {i % 3}",) for i in range(50)], "value string")
    df = ADS.ad_recent_hour(ADS.ad_log_parse(lines))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    below = p[p.index("Exchange"):]
    assert p.count("Generate") == 2 and "Generate" not in below and len(re.findall("Exchange", p)) == 2


def test_slide_must_divide_the_window(spark):
    with pytest.raises(ValueError):
        ADS.windows_from_minutes(spark.createDataFrame([], "minute long, ad_id long, n long"), 60, 7)
