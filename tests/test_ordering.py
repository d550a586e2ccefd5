"""The sliced building blocks against plain windows, on skewed data with ties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.core import Series
from tickloom.ordering import Fold, distribution, running, shift


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({
        "k": np.where(rng.random(n) < 0.6, 0, rng.integers(0, 20, n)), "us": np.sort(rng.integers(0, 5000, n) // 7 * 7),
        "seq": np.arange(n), "v": np.where(rng.random(n) < 0.2, np.nan, rng.integers(0, 50, n)),
    })
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    return df.withColumn("k", F.when(F.col("k") != 19, F.col("k")))


def views(df):
    base = Series(df, ts="us", us_column="us", keys=("k",))
    yield base.using(df, slice_us=37, hot=None)
    yield base.using(df, slice_us=10**9, hot=None)
    yield base.using(df, seq_slice=11, hot=None)
    yield base.balanced(200)
    yield base.balanced(10**6)
    # An input that holds a shuffle takes the shared path.
    shuffled = df.groupBy("k", "us", "seq").agg(F.max("v").alias("v"))
    yield Series(shuffled, ts="us", us_column="us", keys=("k",), slice_us=53)


def same(a, b):
    a, b = (x.orderBy("seq").toPandas().sort_index(axis=1) for x in (a, b))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


@pytest.mark.parametrize("view", range(6))
def test_running(skewed, view):
    s = list(views(skewed))[view]
    w = Window.partitionBy("k").orderBy("us", "seq").rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("k").orderBy(F.desc("us"), F.desc("seq")).rowsBetween(Window.unboundedPreceding, -1)
    v = F.col("v")
    folds = {"s": Fold("sum", v), "lo": Fold("min", v), "hi": Fold("max", v), "f": Fold("first", v), "l": Fold("last", v)}
    want = skewed.withColumns({n: f.over(w) for n, f in folds.items()})
    same(running(s, folds), want)
    want = skewed.withColumns({n: f.over(back) for n, f in folds.items()})
    same(running(s, folds, exclusive=True, reverse=True), want)


@pytest.mark.parametrize("view", range(6))
@pytest.mark.parametrize("lead", [False, True])
def test_shift(skewed, view, lead):
    s = list(views(skewed))[view]
    w = Window.partitionBy("k").orderBy("us", "seq")
    fn = F.lead if lead else F.lag
    want = skewed.withColumns({"a": fn("seq", 1).over(w), "b": fn("v", 3).over(w)})
    same(shift(s, {"a": (F.col("seq"), 1), "b": (F.col("v"), 3)}, lead=lead), want)


def test_distribution(skewed):
    pdf = skewed.toPandas().dropna(subset=["v", "k"])
    got = distribution(skewed.where("k IS NOT NULL"), ["k"], ["v"]).toPandas()
    counts = pdf.groupby(["k", "v"]).size().rename("n").reset_index().sort_values(["k", "v"])
    counts["before"] = counts.groupby("k")["n"].cumsum() - counts["n"]
    counts["total"] = counts.groupby("k")["n"].transform("sum")
    got = got.sort_values(["k", "v"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got[counts.columns], counts.reset_index(drop=True), check_dtype=False)


@pytest.mark.parametrize("kind", ["text", "nan", "time"])
def test_distribution_of_other_values(spark, kind):
    """Texts, NaN and infinities, times; NULL groups are groups."""
    nan, inf = float("nan"), float("inf")
    values_ = {
        "text": ["", "a", "ab", "b", "zz", "\u00e9", "\u00e9t", "\U0001f642"], "nan": [-inf, -3.5, 0.0, 1e300, inf, nan],
        "time": ["1969-12-31 23:59:59", "2024-03-10 02:30:00", "2024-03-10 03:10:00", "2024-11-03 01:30:00"],
    }[kind]
    rows = [(g, v) for g in (None, 1) for i, v in enumerate(values_) for _ in range(i + 1)]
    df = spark.createDataFrame(rows, f"g int, v {'double' if kind == 'nan' else 'string'}")
    df = df.withColumn("v", F.col("v").cast("timestamp_ntz")) if kind == "time" else df
    got = distribution(df, ["g"], ["v"]).orderBy("g", "v").collect()
    before = [sum(range(1, i + 1)) for i in range(len(values_))]
    assert [r["before"] for r in got] == before * 2 and {r["total"] for r in got} == {sum(range(1, len(values_) + 1))}


def test_rows_survive_an_unstable_input(spark, skewed):
    """The branches of a sliced operator may see different rows, as when a lost output is recomputed."""
    unstable = skewed.groupBy("k", "us", "seq").agg(F.max("v").alias("v")).withColumn("v", F.col("v") + F.rand())
    s = Series(unstable, ts="us", us_column="us", keys=("k",), slice_us=53)
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        assert running(s, {"s": Fold("sum", F.col("v"))}).count() == skewed.count()
        out = shift(s, {"a": (F.col("v"), 1)})
        assert out.where("a IS NOT NULL OR v IS NULL OR true").count() == skewed.count()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


def test_a_chain_reads_its_input_once(spark, skewed, tmp_path):
    skewed.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    s = Series(df, ts="us", us_column="us", keys=("k",), slice_us=37)
    for i in range(3):
        s = s.using(running(s, {f"c{i}": Fold("sum", F.col("v"))}), us_column="us")
    plan = final_plan(s.df)
    # Two scans for the first operator; the later ones reuse its shuffle.
    assert plan.count("FileScan") == 2 and plan.count("ReusedExchange") == 2


@pytest.mark.parametrize("name", [
    "bars_with_quotes", "join_by_time_default", "interval_join", "join_with_query_window", "coalesce_feeds", "cut_bins",
    "pnl_realized", "eval_scalar", "mkt_activity", "diff_series", "cumsum_global", "ob_snapshot_uncrossed", "ob_snapshot_ticks", "tw_average_ticks",
])
def test_plans_hold_no_cross_join(spark, name):
    from conftest import SF
    from tickloom.plans import QUERIES

    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_filters_reach_the_scan(spark):
    from conftest import SF
    from tickloom.plans import QUERIES

    df = QUERIES["scan_interval_symbols"](spark, SF)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(ts" in plan and "In(event_type" in plan and "props" not in plan


def test_large_keys_are_found_on_demand_and_only_those(spark, skewed):
    s = Series(skewed.where("k IS NOT NULL"), ts="us", us_column="us", keys=("k",)).balanced(300)
    assert "_found" not in s.hot.__dict__
    assert s.hot.values == ((0,),) and s.sliced
    assert s.using(s.df.where("v > 1")).hot is s.hot
    assert s.using(s.df, keys=()).hot is None
