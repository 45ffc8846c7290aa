import os
import sys
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_ticks(spark):
    """Build ticks from ``(symbol, price, volume, time)``; times are on 2024-01-01."""

    def build(rows, price="decimal(18,2)"):
        frame = spark.createDataFrame(
            [(s, None if p is None else str(p), v, moment(t)) for s, p, v, t in rows],
            "symbol string, price string, volume int, timestamp timestamp_ntz",
        )
        return frame.withColumn("price", frame.price.cast(price))

    return build


def moment(text):
    """A clock time on 2024-01-01, or a full ISO time."""
    if text is None or isinstance(text, datetime):
        return text
    return datetime.fromisoformat(text if "T" in text else f"2024-01-01T{text}")


def rows(frame):
    """Rows as plain tuples, in a fixed order."""
    return sorted((tuple(r) for r in frame.collect()), key=repr)
