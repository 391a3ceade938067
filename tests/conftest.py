import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from quarry.session import get_session

    s = get_session("local[4]", 4)
    yield s


def col_values(df, col="text"):
    return [r[col] for r in df.collect()]


def one(spark, fn, value, schema="text string"):
    """Apply a column function to a one-row frame and return the value."""
    df = spark.createDataFrame([(value,)], schema)
    return df.select(fn(df.columns[0]).alias("r")).first().r
