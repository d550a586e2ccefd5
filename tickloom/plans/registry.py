"""The named queries, the SQL that must agree with each, and the data mapping they share."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.core import DAY, Series, col
from tickloom.functions import numeric as nu

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

START, END = datetime(2024, 1, 1), datetime(2024, 1, 31)
S0, S1 = 1_704_067_200_000_000, 1_706_659_200_000_000  # START and END in microseconds


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def r(c: Column | str, digits: int = 4) -> Column:
    """Round half up with a little slack, so that both engines agree on computed doubles; infinities and NaN stay."""
    scale = float(10**digits)
    return nu.floor(col(c).cast("double") * scale + 0.5001) / scale


def R(sql: str, digits: int = 4) -> str:
    scale = float(10**digits)
    return f"(floor(({sql})::DOUBLE * {scale} + 0.5001)::DOUBLE / {scale})"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str, kind: str | None = None) -> Series:
    """Ticks: symbol = user, arrival = event number."""
    df = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    if kind is not None:
        df = df.where(F.col("event_type") == kind)
    return Series(df, ts="ts", seq=("event_id",), keys=("user_id",), start=START, end=END, slice_us=DAY).balanced()


def trades(spark: SparkSession, sf: str) -> Series:
    """Purchases read as trades: PRICE and SIZE."""
    s = events(spark, sf, "purchase")
    return s.using(s.df.select("user_id", "ts", "event_id", F.col("value").alias("PRICE"), _size().alias("SIZE")))


def _size() -> Column:
    return F.floor(F.col("value") % 7).cast("long") + 1


SIZE_SQL = "(floor(value % 7)::BIGINT + 1)"


def quotes(spark: SparkSession, sf: str) -> Series:
    """Views read as quotes: a spread of 2 % around the value."""
    s = events(spark, sf, "view")
    return s.using(
        s.df.select(
            "user_id", "ts", "event_id",
            (F.col("value") * 0.99).alias("BID_PRICE"), (F.col("value") * 1.01).alias("ASK_PRICE"),
            F.lit(100).cast("long").alias("BID_SIZE"), F.lit(100).cast("long").alias("ASK_SIZE"),
        )
    )


TRADES_SQL = f"trades AS (SELECT user_id, ts, event_id, value AS PRICE, {SIZE_SQL} AS SIZE FROM events WHERE event_type = 'purchase')"
QUOTES_SQL = (
    "quotes AS (SELECT user_id, ts, event_id, value * 0.99 AS BID_PRICE, value * 1.01 AS ASK_PRICE, "
    "100::BIGINT AS BID_SIZE, 100::BIGINT AS ASK_SIZE FROM events WHERE event_type = 'view')"
)


def orders(spark: SparkSession, sf: str) -> Series:
    """Orders as a day-granular series of each customer, with ties."""
    df = table(spark, sf, "orders")
    return Series(df, ts="o_orderdate", seq=("o_orderkey",), keys=("o_custkey",), slice_us=180 * DAY).balanced()


def lineitems(spark: SparkSession, sf: str) -> Series:
    """Line items as trades of a supplier over years; their order within a day is not unique."""
    df = table(spark, sf, "lineitem")
    return Series(
        df, ts="l_shipdate", seq=("l_orderkey", "l_linenumber"), keys=("l_suppkey",),
        start=datetime(1995, 1, 1), end=datetime(2002, 1, 1), slice_us=30 * DAY,
    ).balanced()


L0 = 788_918_400_000_000  # 1995-01-01 in microseconds
