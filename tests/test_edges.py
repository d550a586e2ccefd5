"""Values at the edge: infinities, large numbers, first matches, refused joins, bad factors."""

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import at, values
from tickloom.functions import numeric as nu
from tickloom.functions import text as tx
from tickloom.operators import aggregate as ag
from tickloom.operators import filters as fi
from tickloom.operators import joins as jn
from tickloom.operators import project as pj
from tickloom.operators import scripting as sc
from tickloom.operators import timing as tm
from tickloom.sources import readers as rd
from tickloom.sources import writers as wr


def test_whole_numbers_keep_infinities(spark):
    values = [float("inf"), float("-inf"), 1e19, -2.5, 2.5, 0.4, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select(nu.floor("v").alias("f"), nu.ceil("v").alias("c"), nu.round_("v").alias("r"), nu.round_("v", 1).alias("r1")).collect()
    assert [r["f"] for r in got] == [float("inf"), float("-inf"), 1e19, -3.0, 2.0, 0.0, None]
    assert [r["c"] for r in got] == [float("inf"), float("-inf"), 1e19, -2.0, 3.0, 1.0, None]
    assert [r["r"] for r in got] == [float("inf"), float("-inf"), 1e19, -2.0, 3.0, 0.0, None]
    assert [r["r1"] for r in got] == values
    nan = spark.createDataFrame([(float("nan"),)], "v double").select(F.isnan(nu.floor("v")), F.isnan(nu.ceil("v")), F.isnan(nu.round_("v"))).first()
    assert tuple(nan) == (True, True, True)


@pytest.mark.parametrize(("text", "pattern", "replacement", "want"), [
    ("a cat b dog c", "cat|dog", "X", "a X b dog c"), ("xaab aab", r"(a)\1b", r"<\1>", "x<a> aab"), ("ab", "b|a", "X", "Xb"),
    ("one\ntwo", "two", "2", "one\n2"), ("none", "z", "X", "none"), ("a1b2", r"([a-z])(\d)", r"\2\1", "1ab2"),
])
def test_first_match_only(spark, text, pattern, replacement, want):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(tx.regex_replace("s", pattern, replacement)).first()[0] == want


def test_joins_need_an_equality(spark):
    a, b = spark.range(3).withColumnRenamed("id", "x"), spark.range(3).withColumnRenamed("id", "y")
    with pytest.raises(ValueError):
        jn.join(a, b, F.col("x") < F.col("y"))
    assert jn.join(a, b, (F.col("x") == F.col("y")) & (F.col("x") > 0)).count() == 2


def test_bad_factors_are_errors(make):
    from tickloom.operators.merging import corp_actions

    prices, factors = make(PRICE=[1.0, 2.0], offset=[0, 5]), make(FACTOR=[0.5, -1.0], offset=[1, 9])
    with pytest.raises(PySparkException):
        corp_actions(prices, factors).df.collect()


def test_copies_far_apart_in_a_stream(spark, tmp_path):
    """Several micro-batches: the same keys come again and again."""
    from pyspark.sql import types as T

    from tickloom.streaming import stream as st

    schema = T.StructType.fromDDL("ts timestamp, k int")
    for i in range(4):
        spark.createDataFrame([(f"2024-01-0{i + 1} 00:00:00", k) for k in (1, 2)], "ts string, k int").selectExpr("timestamp(ts) ts", "k").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = []
    live = st.live(spark, str(tmp_path / "in"), schema, "ts", files_per_trigger=1)
    st.run(st.deduplicate(live, ["k"]), lambda df, _: got.extend(r["k"] for r in df.collect()), str(tmp_path / "c")).awaitTermination()
    assert sorted(got) == [1, 2]


@pytest.mark.parametrize("handling", ["complain", "discard", "use_original", "use_new"])
def test_delay_limits_of_new_times(make, handling):
    end = 40
    shift_by = [0, 3, -3, 9, -9, 2, 0, -9, 30, 0, 1]
    s = make(X=list(range(11)), D=shift_by, offset=[2 * i for i in range(11)], end=at(end), slice_us=5000)
    s = s.using(s.df.withColumn("other", F.timestamp_add("MILLISECOND", F.col("D"), F.col("ts"))))
    update = lambda **more: tm.update_timestamp(s, "other", delay_handling=handling, max_delay_of_original_us=5000, max_delay_of_new_us=4000, **more)
    if handling == "complain":
        with pytest.raises(Exception, match="delayed too much"):
            update().df.collect()
        return
    want, latest = {}, None
    for i, d in enumerate(shift_by):
        old, new = 2 * i, 2 * i + d
        apart = d > 5 or -d > 4
        if apart and handling == "discard":
            continue
        if apart:
            new = old if handling == "use_original" else min(max(new, 0), end)
        latest = new if latest is None else max(latest, new)
        want[i] = at(latest if apart and handling == "use_new" else new)
    assert {r["X"]: r["ts"] for r in update().df.collect()} == want
    assert update().df.columns == s.df.columns


def test_an_original_time_may_be_as_late(make):
    s = make(X=[0, 1, 2], offset=[0, 1, 2])
    moved = lambda d: s.using(s.df.withColumn("other", F.timestamp_add("MILLISECOND", F.element_at(F.array(*map(F.lit, d)), F.col("X").cast("int") + 1), F.col("ts"))))
    out = tm.update_timestamp(moved([0, 2, -2]), "other", 1000, "use_original")
    assert [r["ts"] for r in out.df.orderBy("X").collect()] == [at(0), at(3), at(2)]
    with pytest.raises(Exception, match="out of order"):
        tm.update_timestamp(moved([0, 9, -2]), "other", 1000, "use_original").df.collect()


def test_parquet_and_discovery(spark, make, tmp_path):
    s = make(X=[1, 2, 3], S=["a", "b", "ab"])
    path = str(tmp_path / "out")
    wr.write_parquet(s.df, path, ["S"], "gzip", row_group_bytes=1 << 20)
    assert sorted((r["X"], r["S"]) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b"), (3, "ab")]
    assert all(p.name.endswith(".gz.parquet") for p in (tmp_path / "out").rglob("*.parquet"))
    with pytest.raises(Exception, match="already exists"):
        wr.write_parquet(s.df, path)
    assert sorted(r["S"] for r in wr.find_snapshot_symbols(spark, path, "S", "a%").collect()) == ["a", "ab"]
    assert "default" in [r[0] for r in rd.databases(spark).collect()]
    s.df.createOrReplaceTempView("tick_view_of_a_test")
    try:
        assert "tick_view_of_a_test" in [r[0] for r in rd.tick_types(spark, "default").collect()]
        assert [r[0] for r in wr.show_snapshots(spark, "default", "tick_view_of*").collect()] == ["tick_view_of_a_test"]
    finally:
        spark.catalog.dropTempView("tick_view_of_a_test")
    assert rd.last_date(s).collect()[0][0] == at(0).date()
    assert [r["Y"] for r in pj.apply_column(s.df, "Y", lambda c: c * 2, "X").orderBy("X").collect()] == [2, 4, 6]


def test_state_from_query(make):
    """Ticks set the variable from a query; an empty result counts or not; ``each`` is put in by every tick first."""
    s = make(A=[1, 2, 3, 4, 5], offset=[0, 1, 2, 3, 4])
    asked = make(X=[123, 50], offset=[0, 1])
    odd = F.col("A") % 2 == 1

    def state(**kw):
        return values(sc.state_from_query(s, "V", asked, ag.max_("X"), -1000, 1, **kw), "V")

    assert state() == [123, 123, 50, None, None]
    assert state(where=F.col("A") == 2, initial=F.lit(0)) == [0, 123, 123, 123, 123]
    assert state(where=odd, action="update") == [123, 123, 50, 50, 50]
    assert state(where=odd, each=F.lit(7)) == [123, 7, 50, 7, None]
    with pytest.raises(ValueError):
        state(action="add")


def test_symbol_errors(make):
    s = make(A=[1, 2, 3], K=["a", "b", "a"])
    s = s.using(s.df, keys=("K",))
    thrown = fi.throw_for_symbol(s, message="WRONG")
    assert values(fi.show_symbol_errors(thrown), "ts", "ERROR_CODE", "ERROR_MESSAGE", order="seq") == [(at(0), 1, "WRONG")] * 3
    assert fi.intercept_symbol_errors(thrown).df.count() == 0
    some = fi.throw_for_symbol(s, F.when(F.col("A") > 1, F.col("A") == 3), F.concat(F.lit("no "), F.col("A").cast("string")), 5)
    assert values(fi.show_symbol_errors(some), "K", "ERROR_CODE", "ERROR_MESSAGE") == [("a", 5, "no 3")]
    assert values(fi.intercept_symbol_errors(some), "A") == [1, 2]
    assert values(fi.intercept_symbol_errors(some, whole_symbols=True), "A") == [2]
    assert fi.show_symbol_errors(some).df.columns == ["K", "ts", "seq", "ERROR_CODE", "ERROR_MESSAGE"]


def test_activity_of_overlapping_sessions(spark, make):
    """Sessions that touch, hold each other, repeat, last for months, or are empty."""
    s = make(A=list(range(8)), offset=[0, 10, 20, 30, 40, 50, 60, 70])
    rows = [(at(10), at(30), "R"), (at(20), at(50), "A"), (at(30), at(40), "R"), (at(20), at(50), "A"), (at(60), at(60), "E"), (at(65), at(1e10), "L")]
    calendar = spark.createDataFrame(rows, "b timestamp_ntz, e timestamp_ntz, f string")
    out = tm.mkt_activity(s, calendar, "b", "e", "f", "ACT")
    assert values(out, "ACT") == ["", "R", "AR", "AR", "A", "", "", "L"]
    assert values(tm.mkt_activity(s, calendar.limit(0), "b", "e", "f", "ACT"), "ACT") == [""] * 8


def test_last_day_with_ticks(make):
    s = make(A=[1, 2], offset=[0, 2 * 86_400_000])

    def last(day, back):
        return rd.last_not_empty_date(s, datetime.date(2003, 12, day), back).collect()[0]["last_date"]

    assert last(3, 0) == last(9, 6) == datetime.date(2003, 12, 3)
    assert last(2, 5) == datetime.date(2003, 12, 1)
    assert last(2, 0) is None and last(9, 5) is None


def test_what_there_is_to_read(spark, make):
    make(A=[1]).df.createOrReplaceTempView("inspected_ticks")
    assert "default" in [r[0] for r in rd.databases(spark).collect()]
    assert "inspected_ticks" in [r[0] for r in rd.tick_types(spark, "default").collect()]
    spark.catalog.dropTempView("inspected_ticks")


def test_rounding_of_queries_keeps_infinities(spark):
    from tickloom.plans.registry import r

    values = [float("inf"), float("-inf"), 1e18, 1.00005, -2.5, None]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(r("v").alias("r")).collect()
    assert [x["r"] for x in got] == [float("inf"), float("-inf"), 1e18, 1.0001, -2.5, None]
    assert spark.createDataFrame([(float("nan"),)], "v double").select(F.isnan(r("v"))).first()[0]


def test_logarithms_at_zero(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (100.0,), (None,)], "v double").select(nu.ln("v").alias("e"), nu.log10("v").alias("t"))
    assert [x["t"] for x in df.collect()] == [float("-inf"), 0.0, 2.0, None]
    assert [x["e"] for x in df.collect()][:2] == [float("-inf"), 0.0]


def test_spread_of_a_closed_quote(make):
    from tickloom.plans import recipes as rc

    q = make(BID_PRICE=[0.0, 10.0], ASK_PRICE=[0.0, 11.0], offset=[0, 10])
    t = make(PRICE=[8.0, 0.0, 12.0], SIZE=[1, 1, 1], offset=[1, 2, 11])
    df = rc.effective_spread(t, q, F.lit(True)).df.orderBy("ts")
    rows = df.select("ETQ", "NUM_SPREADS", F.isnan("ETQ").alias("nan")).collect()
    assert (rows[0]["ETQ"], rows[0]["NUM_SPREADS"]) == (float("inf"), float("inf"))
    assert [x["nan"] for x in rows] == [False, True, False] and rows[2]["ETQ"] == 3.0
    nothing = q.df.limit(1).select(nu.divide(F.lit(None), F.lit(0)).alias("n"), F.isnan(nu.divide(F.lit(float("nan")), F.lit(0))).alias("nan")).first()
    assert tuple(nothing) == (None, True)


def test_volatility_with_a_price_of_zero(make):
    """Infinite returns make the deviation undefined, but are counted and no error."""
    from tickloom.plans import recipes as rc

    s = make(PRICE=[2.0, 0.0, 4.0, 2.0, 2.0, 4.0], offset=[0, 1, 2, 1000, 1001, 1002])
    rows = rc.volatility(s, "PRICE", 1).df.orderBy("ts").select("VOLATILITY", "N").collect()
    assert [x["N"] for x in rows] == [2, 3]
    assert rows[0]["VOLATILITY"] != rows[0]["VOLATILITY"] and rows[1]["VOLATILITY"] == pytest.approx(0.6931471805599453)


def test_jumps_from_and_to_zero(make):
    s = make(X=[5.0, 5.0, 0.0, 5.0, 5.0, 0.0, 0.0, 0.0, 4.0])
    assert values(fi.skip_bad_tick_symmetric(s, "X", 3.0), "X") == [5.0, 5.0, 5.0, 5.0, 0.0, 0.0, 0.0]


def test_return_on_a_price_of_zero(make):
    from tickloom.operators import statistics as st
    from tickloom.operators.buckets import Buckets

    s = make(PRICE=[0.0, 4.0, 8.0], offset=[100, 1100, 2100], end=datetime.datetime(2003, 12, 1, 0, 0, 3))
    got = values(st.return_ep(s, "PRICE", Buckets(1)), "return")
    assert got[0] != got[0] and got[1:] == [float("inf"), 2.0]


def test_euclid_takes_the_steps_its_numbers_need(spark):
    import math

    fib = [0, 1]
    while fib[-1] < 2**62:
        fib.append(fib[-1] + fib[-2])
    pairs = [*zip(fib, fib[1:]), *zip(fib[1:], fib), (0, 0), (-12, 18), (2**63 - 1, 7), (6 * fib[80], 6 * fib[81])]
    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", nu.gcd("a", "b").alias("g"))
    assert [x["g"] for x in df.collect()] == [math.gcd(a, b) for a, b in pairs]
    assert spark.range(1).select(nu.gcd("id", F.lit(None).cast("long"))).first()[0] is None
    assert "sequence(1, 93" not in df._jdf.queryExecution().analyzed().toString()
