from __future__ import annotations

import pytest

from parcelflow.checkpoints import ensure_checkpoint_dir
from parcelflow.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "6g")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture()
def one(spark):
    """Value of a column expression."""

    def value(column):
        return spark.range(1).select(column.alias("v")).first()["v"]

    return value


@pytest.fixture()
def mapped(spark):
    """Results of a column function over a list of inputs, in input order."""

    def values(function, inputs, schema):
        rows = [(i, *(x if isinstance(x, tuple) else (x,))) for i, x in enumerate(inputs)]
        df = spark.createDataFrame(rows, f"i int, {schema}")
        arguments = df.columns[1:]
        return [r["v"] for r in df.select("i", function(*arguments).alias("v")).orderBy("i").collect()]

    return values


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()
