import os

import pandas as pd
import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    os.environ["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse")).config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import glob

    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def rows_of(frame):
    """Rows with columns in order of name, as sorted text; doubles to nine digits."""
    names = sorted(frame.columns)

    def cell(v):
        if v is None or v is pd.NA or v is pd.NaT or v != v:
            return "-"
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    return names, sorted(tuple(cell(v) for v in r) for r in frame[names].itertuples(index=False))
