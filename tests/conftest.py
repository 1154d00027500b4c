import tempfile

import pytest

from sample import BASE, SAMPLE
from thermoweave.session import build_session
from thermoweave.sources.readings import event_time, from_rows


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        conf={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-"),
            "spark.sql.streaming.noDataMicroBatches.enabled": "true",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Readings from (id, seconds after BASE, temperature) rows, with seq and ts."""
    from pyspark.sql import functions as F

    def build(rows):
        df = from_rows(spark, [(i, BASE + s, float(t)) for i, s, t in rows])
        return df.withColumn("ts", event_time(F.col("timestamp"), "s"))

    return build


@pytest.fixture(scope="session")
def sample(make):
    return make(SAMPLE).cache()
