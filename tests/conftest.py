import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from changeflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "changeflow-tests", "6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate a column over a list of texts: one job for many cases."""

    def run(texts, build):
        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "i int, text string").repartition(4)
        return [r["v"] for r in df.select("i", build("text").alias("v")).orderBy("i").collect()]

    return run
