import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sql():
    from checks.compare import connect
    return connect(SMALL)


@pytest.fixture
def make(spark):
    """Small frames: ``make("id string, a int", [("x", 1)])``."""
    return lambda schema, rows: spark.createDataFrame(rows, schema)


def by_id(df, *columns):
    """``{id: value}`` or ``{id: (values...)}``."""
    rows = df.select("id", *columns).collect()
    if len(columns) == 1:
        return {r["id"]: r[columns[0]] for r in rows}
    return {r["id"]: tuple(r[c] for c in columns) for r in rows}
