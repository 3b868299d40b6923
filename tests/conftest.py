import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from weftline.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("weftline-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.enabled": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def edges_of(spark):
    def build(pairs):
        return spark.createDataFrame(list(pairs), "src string, dst string")

    return build


def rows(df):
    return sorted(tuple(r) for r in df.collect())
