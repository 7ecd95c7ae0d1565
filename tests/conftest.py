import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def one(spark):
    """Values of column expressions over one literal row."""

    def run(*cols, **data):
        from pyspark.sql import functions as F

        df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in data.items()] or [F.lit(0).alias("_")])
        row = df.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()
        return row[0] if len(cols) == 1 else tuple(row)

    return run
