import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def records(spark):
    """Build records from (time, entity, value[, value2[, value3[, value4]]]) tuples."""

    def build(*rows):
        full = [tuple(r) + (None,) * (6 - len(r)) + ("{}",) for r in rows]
        df = spark.createDataFrame(
            full,
            "time string, entity_id string, value double, value2 double, value3 double, "
            "value4 double, metadata string",
        )
        return df.withColumn("time", df["time"].cast("timestamp"))

    return build


@pytest.fixture
def ticks(spark):
    """Build ticks from (time, symbol, price[, volume]) tuples."""

    def build(*rows):
        full = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        df = spark.createDataFrame(full, "time string, symbol string, price double, volume double")
        return df.withColumn("time", df["time"].cast("timestamp"))

    return build
