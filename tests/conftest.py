import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from rubric.session import build_session
    s = build_session("local[4]", 8, app_name="rubric-tests")
    yield s
    s.stop()


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def one_col(spark, values, expr_fn, schema="x string"):
    """Evaluate a Column builder on a one-column DataFrame of ``values``."""
    df = spark.createDataFrame([(v,) for v in values], schema)
    from pyspark.sql import functions as F
    return [r[0] for r in df.select(expr_fn(F.col(df.columns[0]))).collect()]
