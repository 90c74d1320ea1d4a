import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def agrees(spark):
    """Whether a query gives the rows of its SQL over the smallest tables."""
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables here")
    db = duckdb.connect()
    db.sql("set TimeZone = 'UTC'")
    for f in os.listdir(SMALL):
        db.sql(f"create view {f[:-8]} as select * from '{SMALL}/{f}'")

    def check(query, sql):
        plain = lambda x: f"{x:.6g}" if isinstance(x, float) else str(x)
        df = query(spark, SMALL)
        columns = sorted(df.columns)
        rows = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
        quoted = ", ".join(f'"{c}"' for c in columns)
        return rows == sorted(tuple(map(plain, r)) for r in db.sql(f"select {quoted} from ({sql})").fetchall())

    return check
