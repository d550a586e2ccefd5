"""Sliding folds against plain computation over each window: skewed keys, ties, infinities, mixed magnitudes, large offsets."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tickloom.core import Series
from tickloom.operators import aggregate as ag
from tickloom.operators import joins as jn
from tickloom.operators import statistics as stats
from tickloom.operators import ticks as tk

INF = math.inf


def rows_of(seed=5, n=160):
    r = random.Random(seed)
    out = []
    for i in range(n):
        k = r.choice(["a", "a", "a", "b", "c"])
        x = r.choice([None, 1e8, 1e8 + 1, 1e8 + r.random(), 3.0]) if k == "b" else r.choice([None, 1.0, 2.5, -4.0, 1e16, INF if r.random() < 0.1 else 7.0])
        out.append((k, r.randrange(900), i, x, None if r.random() < 0.2 else r.randrange(-5, 6)))
    return out


def series(spark, rows, slice_us, **changes):
    df = spark.createDataFrame(rows, "k string, us long, seq long, x double, y int").repartition(3)
    df = df.withColumn("ts", F.timestamp_add("MICROSECOND", F.col("us"), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")))
    from datetime import datetime, timedelta

    return Series(df, us_column="us", keys=("k",), slice_us=slice_us, end=datetime(1970, 1, 1) + timedelta(microseconds=800), **changes)


def aggs(few=False):
    """All aggregates, or one of each way of folding: plans of many slices are slow to compile."""
    every = {
        "n": ag.count(), "s": ag.sum_("x"), "m": ag.average("x"), "lo": ag.min_("x"), "hi": ag.max_("x"), "f": ag.first("y"), "l": ag.last("x"),
        "sd": ag.stddev("x"), "u": ag.variance("x", biased=False), "sk": ag.standardized_moment("x", 3), "ku": ag.standardized_moment("x", 4),
        "co": ag.correlation("x", "y"), "sl": ag.slope("y", "x"), "ic": ag.intercept("y", "x"),
    }
    return {n: a for n, a in every.items() if not few or n in ("s", "f", "ku", "co")}


def plain(window):
    """The aggregates of a list of rows in order."""
    xs = [r[3] for r in window if r[3] is not None]
    pairs = [(r[3], r[4]) for r in window if r[3] is not None and r[4] is not None]
    finite = all(map(math.isfinite, xs))
    out = {
        "n": len(window), "s": sum(xs) if finite else INF, "m": (sum(xs) / len(xs) if finite else INF) if xs else None, "lo": min(xs, default=None),
        "hi": max(xs, default=None), "f": window[0][4] if window else None, "l": window[-1][3] if window else None,
    }
    if not finite:
        return out
    out["s"] = math.fsum(xs)
    out["m"] = math.fsum(xs) / len(xs) if xs else None
    if xs:
        mean = statistics.fmean(xs)
        central = [math.fsum((x - mean) ** d for x in xs) for d in (2, 3, 4)]
        sd = math.sqrt(central[0] / len(xs))
        out |= {"sd": sd, "u": central[0] / (len(xs) - 1) if len(xs) > 1 else None}
        out |= {"sk": central[1] / len(xs) / sd**3, "ku": central[2] / len(xs) / sd**4} if central[0] else {"sk": None, "ku": None}
    if pairs:
        mx, my = (statistics.fmean(c) for c in zip(*pairs))
        xx, yy, xy = (math.fsum((x - mx) ** 2 for x, _ in pairs), math.fsum((y - my) ** 2 for _, y in pairs), math.fsum((x - mx) * (y - my) for x, y in pairs))
        out |= {"sl": xy / xx if xx else None, "ic": my - xy / xx * mx if xx else None, "co": xy / math.sqrt(xx) / math.sqrt(yy) if xx and yy else None}
    return out


def close(got, want, large):
    if want is None or got is None:
        return want is None and got is None
    return math.isclose(got, want, rel_tol=1e-6, abs_tol=1e-6 * max(1.0, large))


def check(got, window):
    want = plain(window)
    # a window that holds 1e16 beside small numbers has no more digits than doubles have
    large = max((abs(r[3]) for r in window if r[3] is not None and math.isfinite(r[3])), default=0.0)
    large = large if large > 1e12 else 0.0
    for name, v in want.items():
        if name not in got:
            continue
        if large and name in ("sk", "ku", "co", "sl", "ic"):
            continue
        # an intercept far from the data amplifies the last digits of the slope
        assert close(got[name], v, large if name != "ic" else max(abs(r[3] or 0) for r in window)), (name, got[name], v, window)


@pytest.mark.parametrize("slice_us", [40, 10**9])
@pytest.mark.parametrize("width", [1, 150])
def test_time_windows(spark, slice_us, width):
    rows = rows_of()
    s = series(spark, rows, slice_us)
    order = sorted(rows, key=lambda r: (r[1], r[2]))
    for got in ag.running_agg(s, aggs(slice_us < 100), width, emit="arrival").df.collect() if width != 1 else []:
        check(got.asDict(), [r for r in order if r[0] == got["k"] and got["us"] - width < r[1] <= got["us"]])
    left = ag.running_agg(s, {"n": ag.count(), "s": ag.sum_("x"), "lo": ag.min_("x"), "f": ag.first("seq")}, width, emit="exit").df.collect()
    assert len(left) == sum(r[1] + width < 800 for r in rows)
    both = ag.running_agg(s, {"n": ag.count(), "hi": ag.max_("x")}, width, emit="both").df
    times = {(r[0], t) for r in rows for t in (r[1], r[1] + width) if t == r[1] or t < 800}
    got = {(r["k"], r["t"]): (r["n"], r["hi"]) for r in both.withColumn("t", F.unix_micros(F.col("ts").cast("timestamp"))).collect()}
    assert got.keys() == times
    for (k, t), (n, hi) in got.items():
        window = [r for r in rows if r[0] == k and t - width < r[1] <= t]
        assert (n, hi) == (len(window), max((r[3] for r in window if r[3] is not None), default=None))


@pytest.mark.parametrize("ticks, rows_per_slice", [(1, 10**6), (20, 5), (64, 10**6)])
def test_windows_of_ticks(spark, ticks, rows_per_slice, monkeypatch):
    monkeypatch.setattr(ag, "ROWS_PER_SLICE", rows_per_slice)
    rows = rows_of(8)
    out = ag.running_agg(series(spark, rows, 40), aggs(rows_per_slice < 10), ticks=ticks).df.collect()
    assert len(out) == len(rows)
    order = sorted(rows, key=lambda r: (r[1], r[2]))
    for got in out:
        own = [r for r in order if r[0] == got["k"]]
        at = [r[2] for r in own].index(got["seq"])
        check(got.asDict(), own[max(0, at - ticks + 1) : at + 1])


@pytest.mark.parametrize("ticks", [1, 20, 33])
def test_windows_of_ticks_without_large_keys(spark, ticks):
    """A few ticks: one sort and no row twice; the same values from plain windows and from blocks."""
    rows = rows_of(8)
    s = series(spark, rows, 40).balanced()
    out = ag.running_agg(s, aggs(True), ticks=ticks).df
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("Generate explode" not in plan and plan.count("Sort [") == 1) == (ticks < 33)
    got = out.collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[1], r[2]))
    for g in got:
        own = [r for r in order if r[0] == g["k"]]
        at = [r[2] for r in own].index(g["seq"])
        check(g.asDict(), own[max(0, at - ticks + 1) : at + 1])


def test_grouped_ticks(spark):
    rows = rows_of(9, 200)
    out = ag.running_agg(series(spark, rows, 40), {"n": ag.count(), "lo": ag.min_("x"), "g": ag.first("seq")}, ticks=3, group_by=["y"]).df.collect()
    order = sorted(rows, key=lambda r: (r[1], r[2]))
    for got in out:
        own = [r for r in order if r[0] == got["k"] and r[4] == got["y"]]
        at = [r[2] for r in own].index(got["seq"])
        window = own[max(0, at - 2) : at + 1]
        assert (got["n"], got["lo"], got["g"]) == (len(window), min((r[3] for r in window if r[3] is not None), default=None), window[0][2])


@pytest.mark.parametrize("slice_us", [3, 10**9])
def test_cumulative_moments(spark, slice_us):
    """Hundreds of slices, so that merged states are merged again."""
    rows = [(k, t, t, 1e8 + t % 2, t % 3) for k in ("a", "b") for t in range(0, 600, 1 if k == "a" else 97)]
    out = ag.running_agg(series(spark, rows, slice_us), aggs(slice_us < 100)).df.collect()
    for got in out[::9]:
        check(got.asDict(), [r for r in rows if r[0] == got["k"] and r[1] <= got["us"]])


def test_runs_of_runs(spark, monkeypatch):
    """More than 4,096 slices in a key."""
    rows = [("a", 2 * t, t, 1e8 + t % 5, None) for t in range(9000)]
    out = ag.running_agg(series(spark, rows, 1), {"v": ag.variance("x")}).df.where("seq > 8990 or seq in (63, 64, 4095, 4096, 8191)").collect()
    for got in out:
        assert math.isclose(got["v"], statistics.pvariance([r[3] - 1e8 for r in rows[: got["seq"] + 1]]), rel_tol=1e-6)


@pytest.mark.parametrize("low, high, slice_us", [(-50, 1, 10**9), (-200, 200, 11), (-200, 200, 10**9), (5, 5, 11)])
def test_windows_of_another_series(spark, low, high, slice_us):
    a, b = rows_of(1, 60), rows_of(2, 120)
    out = jn.window_join(series(spark, a, slice_us).using(series(spark, a, slice_us).df.select("k", "ts", "us", "seq")), series(spark, b, slice_us), aggs(slice_us < 100), low, high)
    got = out.df.collect()
    assert len(got) == len(a)
    order = sorted(b, key=lambda r: (r[1], r[2]))
    for g in got:
        check(g.asDict(), [r for r in order if r[0] == g["k"] and g["us"] + low <= r[1] < g["us"] + high])


def test_what_has_left_is_forgotten(spark):
    rows = [("a", t, t, x, None) for t, x in enumerate([1.0, INF, 2.0, 3.0, 4.0])] + [("b", t, t, x, None) for t, x in enumerate([1e16, 1.0, 1.0, 1.0])]
    out = ag.running_agg(series(spark, rows, 10**9), {"s": ag.sum_("x")}, 2, emit="arrival").df.orderBy("k", "us").collect()
    assert [r["s"] for r in out] == [1.0, INF, INF, 5.0, 7.0, 1e16, 1e16, 2.0, 2.0]
    offset = [("a", t, t, 1e8 + t % 2, None) for t in range(10)]
    for window in ({"ticks": 4}, {"window_us": 4, "emit": "arrival"}):
        out = ag.running_agg(series(spark, offset, 2), {"sd": ag.stddev("x")}, **window).df.orderBy("us").collect()
        assert [round(r["sd"], 7) for r in out][3:] == [0.5] * 7


@pytest.mark.parametrize("window", [{"window_us": 1}, {"window_us": 90}, {"ticks": 1}, {"ticks": 9}, {"ticks": 1000}])
def test_order_statistics_and_distinct_counts(spark, window):
    rows = [(k, t, i, math.nan if i % 31 == 0 else x, y) for k, t, i, x, y in rows_of(12)]
    s = series(spark, rows, 40)
    order = sorted(rows, key=lambda r: (r[1], r[2]))

    def windows(k, t, seq):
        own = [r for r in order if r[0] == k]
        if "ticks" in window:
            at = [r[2] for r in own].index(seq)
            return own[max(0, at - window["ticks"] + 1) : at + 1]
        return [r for r in own if t - window["window_us"] < r[1] <= t]

    middle = stats.sliding_median(s, "x", **window).df.collect()
    nearest = {r["seq"]: r for r in stats.sliding_quantiles(s, "x", {"lo": 0.0, "third": 1 / 3, "hi": 1.0}, interpolate=False, **window).df.collect()}
    assert len(middle) == len(nearest) == len(rows)
    for r in middle:
        xs = sorted(x for *_, x, _ in windows(r["k"], r["us"], r["seq"]) if x is not None and not math.isnan(x))
        assert math.isclose(r["median"], statistics.median(xs)) if xs else r["median"] is None
        n = nearest[r["seq"]]
        assert (n["lo"], n["third"], n["hi"]) == ((xs[0], xs[math.ceil(len(xs) / 3) - 1], xs[-1]) if xs else (None, None, None))
    for r in tk.sliding_num_distinct(s, ["y"], **window).df.collect():
        assert r["num_distinct"] == len({x[4] for x in windows(r["k"], r["us"], r["seq"])})


def test_small_groups_are_read_together(spark):
    """One call reads many groups, each of them whole, wherever the batches are cut."""
    import pyarrow as pa

    keys, blocks = ["a", "a", "b", "b", "b", "b", "b", None, None, "c", "c", "c"], [1, 2, 1, 1, 1, 1, 1, 1, 1, 1, 2, 2]
    for size in (1, 2, 3, 5, 12):
        calls = []

        def read(table, run, calls=calls):
            calls.append(list(zip(table.column("k").to_pylist(), table.column("b").to_pylist(), run.tolist())))
            return table

        rows = pa.table({"k": keys, "b": blocks})
        out = list(stats._whole_groups(iter(rows.to_batches(size)), ["k", "b"], read))
        assert pa.Table.from_batches(out).to_pydict() == rows.to_pydict()
        owners = [{(k, b) for k, b, _ in c} for c in calls]
        assert sum(len(o) for o in owners) == len(set(zip(keys, blocks)))  # no group in two calls
        assert all(len({n for _, _, n in c}) == len(o) for c, o in zip(calls, owners))
        assert len(calls) <= -(-len(keys) // size) + 1
    assert list(stats._whole_groups(iter([]), ["k"], lambda t, run: t)) == []

    plan = stats.sliding_median(series(spark, rows_of(12), 40), "x", 90).df._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroupsInArrow" not in plan
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(batch, 3)
    try:
        test_order_statistics_and_distinct_counts(spark, {"window_us": 90})
    finally:
        spark.conf.unset(batch)
