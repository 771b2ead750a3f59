import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clickscope.runtime import build_session
    s = build_session("local[4]", 8)
    # tests only: no shared checkpoint folder is configured, so use a private one
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clickscope-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    names = ("region nation customer supplier part orders lineitem events documents embeddings "
             "pages benchmark labels conversations").split()
    for t in names:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())
