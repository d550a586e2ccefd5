from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF = "/root/testdata/sf0.001"
T0 = datetime(2003, 12, 1)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Inline ticks, one millisecond apart unless offsets are given; slices are tiny on purpose."""
    from tickloom.core import Series
    from tickloom.sources.readers import ticks

    def build(end=datetime(2003, 12, 4), offset=None, slice_us=2000, **cols) -> Series:
        s = ticks(spark, cols, T0, end, offset_ms=offset)
        return s.using(s.df, slice_us=slice_us)

    return build


def values(result, *columns, order="ts"):
    df = getattr(result, "df", result)
    rows = df.orderBy(*([order] if isinstance(order, str) else order)).collect()
    return [r[columns[0]] if len(columns) == 1 else tuple(r[c] for c in columns) for r in rows]


def at(ms: float) -> datetime:
    return T0 + timedelta(milliseconds=ms)
