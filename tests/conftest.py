from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession, types as T

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from rushcart.sources.samples import SAMPLES  # noqa: E402
from rushcart.sources.tables import EVENTS  # noqa: E402

START = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return START + timedelta(microseconds=round(seconds * 1e6))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    """``(event_id, seconds, user, type)`` tuples to events."""

    def make(rows):
        full = [(i, at(s) if s is not None else None, u, t, 1.0, '{"k": 1}') for i, s, u, t in rows]
        return spark.createDataFrame(full, EVENTS)

    return make


@pytest.fixture(scope="session")
def samples(spark):
    """``(version, route, seconds, latency, is_error)`` tuples to samples."""
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in SAMPLES])

    def make(rows):
        return spark.createDataFrame([(v, r, at(s), l, e) for v, r, s, l, e in rows], loose)

    return make


LINES = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("user", T.LongType()),
        T.StructField("item", T.LongType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("ordered_at", T.TimestampNTZType()),
    ]
)


@pytest.fixture(scope="session")
def lines(spark):
    """``(order, user, item, quantity)`` tuples to purchase lines, one day per order."""

    def make(rows):
        full = [(o, u, i, float(q), START + timedelta(days=o)) for o, u, i, q in rows]
        return spark.createDataFrame(full, LINES)

    return make


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
