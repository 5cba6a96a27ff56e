import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lavra.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, app_name="lavra-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def one(df, col=None):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0] if col is None else rows[0][col]


def values(spark, expr, inputs, schema="x string"):
    df = spark.createDataFrame([(v,) for v in inputs], schema)
    return [r[0] for r in df.select(expr).collect()]


__all__ = ["one", "values", "tempfile"]
