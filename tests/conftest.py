import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from recordloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 8, "recordloom-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate an expression over one column of literal values, in order."""
    from pyspark.sql import functions as F

    def run(expr, data, type_="string"):
        df = spark.createDataFrame(list(enumerate(data)), f"i int, v {type_}")
        return [r[1] for r in df.select("i", expr(F.col("v"))).orderBy("i").collect()]

    return run


def plan_of(df) -> str:
    """The physical plan; the adapted one if the frame has been run."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
