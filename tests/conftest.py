from __future__ import annotations

import glob
import os
import sys
import tempfile

import duckdb
import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-test-")).getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="session")
def same():
    """Compares frames as multisets of rows, columns by name."""

    def check(a, b):
        assert sorted(a.columns) == sorted(b.columns)
        cols = sorted(a.columns)

        def value(x):
            if pd.isna(x):
                return "null"
            if hasattr(x, "isoformat"):
                return x.isoformat()[:19].removesuffix("T00:00:00")
            return f"{float(x):.5f}" if isinstance(x, (int, float)) or hasattr(x, "dtype") and x.dtype.kind in "fiu" else str(x)

        rows = [sorted(tuple(map(value, r)) for r in x[cols].itertuples(index=False)) for x in (a, b)]
        assert len(rows[0]) == len(rows[1])
        assert [x.replace("-0.00000", "0.00000") for r in rows[0] for x in r] == [x.replace("-0.00000", "0.00000") for r in rows[1] for x in r]

    return check
