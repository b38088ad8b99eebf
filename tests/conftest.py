import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marketlens.session import get_spark

    s = get_spark("local[4]", app_name="marketlens-tests", shuffle_partitions=4)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="marketlens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def mk_small(spark):
    from marketlens.sources.testdata import load_testdata

    return load_testdata(spark, SF_SMALL)
