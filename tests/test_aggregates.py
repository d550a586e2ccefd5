"""Golden tables of bucketed, running and sliding aggregation."""

import collections
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import T0, at, values
from tickloom.operators import aggregate as ag
from tickloom.operators import statistics as st
from tickloom.operators import ticks as tk
from tickloom.operators.buckets import Buckets

SECONDS = [0, 5, 13, 15, 20, 27, 30, 35, 42, 45]
W = 20_000_000


@pytest.fixture(params=[7_000_000, 10**12])
def ten(make, request):
    return make(A=list(range(10)), offset=[s * 1000 for s in SECONDS], end=T0 + timedelta(seconds=60), slice_us=request.param)


def test_time_buckets(ten):
    out = ag.agg(ten, {"S": ag.sum_("A"), "N": ag.count()}, Buckets(21))
    assert values(out, "ts", "S", "N") == [(at(21000), 10, 5), (at(42000), 18, 3), (at(60000), 17, 2)]


def test_bucket_start_stamp_and_first_fields(ten):
    out = ag.agg(ten, {"S": ag.sum_("A")}, Buckets(21, stamp="start"), all_fields="first")
    assert values(out, "ts", "A", "S") == [(at(0), 0, 10), (at(21000), 5, 18), (at(42000), 8, 17)]


def test_tick_buckets_end_at_their_last_tick(ten):
    out = ag.agg(ten, {"S": ag.sum_("A")}, Buckets(3, "ticks"))
    assert values(out, "ts", "S") == [(at(13000), 3), (at(27000), 12), (at(42000), 21), (at(60000), 9)]


@pytest.mark.parametrize("boundary, sums", [("new", [6, 22, 17]), ("previous", [0, 10, 26, 9])])
def test_flexible_buckets(ten, boundary, sums):
    b = Buckets(unit="flexible", condition=F.col("A") % 4 == 0, boundary=boundary)
    assert values(ag.agg(ten, {"S": ag.sum_("A")}, b), "S") == sums


def test_empty_buckets_have_defaults(make):
    s = make(A=[1, 2], offset=[0, 4500], end=T0 + timedelta(seconds=6))
    out = ag.agg(s, {"S": ag.sum_("A"), "N": ag.count(), "L": ag.last("A")}, Buckets(2))
    assert values(out, "S", "N", "L") == [(1, 1, 1), (0, 0, None), (2, 1, 2)]


def test_cumulative(ten):
    assert values(ag.running_agg(ten, {"S": ag.sum_("A")}), "S") == [0, 1, 3, 6, 10, 15, 21, 28, 36, 45]


@pytest.mark.parametrize("framed", [False, True])
def test_sliding(ten, framed):
    aggs = {"S": ag.sum_("A"), **({"M": ag.max_("A")} if framed else {})}
    both = ag.running_agg(ten, aggs, W)
    assert values(both, "S") == [0, 1, 3, 6, 10, 9, 14, 20, 18, 22, 18, 26, 35, 30, 24, 17]
    assert values(ag.running_agg(ten, aggs, W, emit="arrival"), "S", order="A") == [0, 1, 3, 6, 10, 14, 20, 22, 26, 35]
    assert values(ag.running_agg(ten, aggs, W, emit="exit"), "S", order="A") == [6, 10, 20, 18, 22, 35, 30, 24]


def test_state_series_carries_the_last_tick(make):
    s = make(A=[5, 1, 2], offset=[0, 3000, 4500], end=T0 + timedelta(seconds=8))
    out = ag.agg(s, {"M": ag.max_("A")}, Buckets(2), time_series_type="state_ts")
    assert values(out, "M") == [5, 5, 2, 2]


def test_moments(make):
    s = make(X=[1, 2, 3, 3, 4])
    out = ag.agg(s, {"B": ag.variance("X"), "U": ag.variance("X", False)})
    assert [round(x, 6) for x in values(out, "B", "U")[0]] == [1.04, 1.3]
    assert st.median(s, "X").collect()[0]["median"] == 3.0


def test_vwap_and_weighted_averages(make):
    s = make(P=[1, 2, 3, 4], S=[10, 20, 30, 40])
    assert values(ag.agg(s, {"V": ag.vwap("P", "S")}), "V") == [3.0]
    t = make(X=[1, 2, 3, 4], offset=[0, 1000, 1500, 3000], end=T0 + timedelta(seconds=4))
    assert st.tw_average(t, "X").collect()[0]["tw_average"] == 2.625
    e = st.exp_w_average(make(A=[1.0, 2.0, 3.0, 3.0, 4.0]), "A", 2, Buckets(2, "ticks"), "lambda")
    assert [round(x, 6) for x in values(e, "exp_w_average", order="_tl_bucket")] == [1.880797, 2.984124, 3.880797]


def test_time_weights_in_buckets_of_ticks(make):
    """A bucket of ticks lasts from the last tick of the bucket before to its own last tick, the open one to the end."""
    s = make(A=[1.0, 2.0, 3.0, 3.0, 4.0])
    for decay, kind, want in ((2, "half_life_index", [1.0, 2.500087, 4.0]), (2, "lambda", [1.0, 2.5005, 4.0])):
        out = st.exp_tw_average(s, "A", decay, Buckets(2, "ticks"), kind)
        assert [round(x, 6) for x in values(out, "exp_tw_average", order="_tl_bucket")] == want
    t = make(A=[1.0, 2.0, 4.0, 8.0], offset=[0, 1000, 3000, 4000], end=T0 + timedelta(seconds=6))
    assert values(st.tw_average(t, "A", Buckets(2, "ticks")), "tw_average", order="_tl_bucket") == [1.0, 8 / 3]
    assert values(st.tw_average(t, "A", Buckets(2, "ticks"), "event_ts"), "tw_average", order="_tl_bucket") == [1.0, 4.0]
    assert values(st.tw_average(t, "A", Buckets(1, "ticks")), "tw_average", order="_tl_bucket") == [None, 1.0, 2.0, 4.0]
    assert values(st.tw_average(t, "A", Buckets(3, "ticks")), "tw_average", order="_tl_bucket") == [5 / 3, 20 / 3]
    closing = F.col("A") == 4.0
    assert values(st.tw_average(t, "A", Buckets(unit="flexible", condition=closing)), "tw_average", order="_tl_bucket") == [5 / 3, 20 / 3]
    before = Buckets(unit="flexible", condition=closing, boundary="previous")
    assert values(st.tw_average(t, "A", before), "tw_average", order="_tl_bucket") == [5 / 3, 20 / 3]


@pytest.mark.parametrize("per_group", [False, True])
def test_time_weights_in_groups(make, per_group):
    t = make(A=[1.0, 2.0, 4.0, 8.0], G=["a", "b", "a", "a"], offset=[0, 1000, 3000, 4000], end=T0 + timedelta(seconds=6))
    out = st.tw_average(t, "A", Buckets(2, "ticks", per_group=per_group), group_by=["G"])
    got = {(r["G"], r["_tl_bucket"]): r["tw_average"] for r in out.collect()}
    if per_group:
        assert got == {("a", 0): 1.0, ("a", 1): 20 / 3, ("b", 0): 2.0}
    else:
        assert got == {("a", 0): 1.0, ("a", 1): 2.0, ("b", 0): None, ("b", 1): 2.0}


def test_percentiles(make):
    s = make(A=[1, 2, 3, 4])
    assert [r["A"] for r in st.percentile(s, ["A"]).collect()] == [2]
    assert values(st.percentile(s, ["A"], 3), "A", order="QUANTILE") == [3, 2]
    assert values(st.percentile(s, [("A", "asc")], 3), "A", order="QUANTILE") == [2, 3]
    assert st.find_value_for_percentile(s, "A", 50, "interpolated_value").collect()[0]["value"] == 2.5
    assert st.find_value_for_percentile(s, "A", 50, "first_value_with_ge_percentile").collect()[0]["value"] == 3


def test_ranking(make):
    assert values(st.ranking(make(A=[1, 2, 3]), ["A"]), "RANKING") == [3, 2, 1]
    s = make(A=[1, 2, 2, 3, 2, 1])
    lt = [round(x, 2) for x in values(st.ranking(s, [("A", "asc")], "percent_lt_values", True), "RANKING")]
    assert lt == [66.67, 16.67, 16.67, 0.0, 16.67, 66.67]
    assert values(st.ranking(s, [("A", "asc")], "percent_lt_values"), "RANKING") == [80, 20, 20, 0, 20, 80]


def test_balanced_groups(make):
    s = make(X=list("ABACD"), SIZE=[10, 30, 20, 15, 14])
    got = {r["X"]: r["GROUP_ID"] for r in st.partition_evenly_into_groups(s, "X", "SIZE", 3).collect()}
    assert got == {"A": 0, "B": 1, "C": 2, "D": 2}


@pytest.mark.parametrize("heaviest, largest", [(1, 900), (3, 900), (2, 50_000)])
def test_light_values_level_the_groups(make, heaviest, largest):
    rng = np.random.default_rng(heaviest)
    size = [int(x) for x in rng.integers(1, 40, 300)] + [largest, 200, 0]
    s = make(X=[*range(301), -1, 500], SIZE=size)
    s = s.using(s.df.withColumn("X", F.nullif("X", F.lit(-1))))
    rows = st.partition_evenly_into_groups(s, "X", "SIZE", 5, heaviest=heaviest).collect()
    weight = dict(zip([*range(301), None, 500], size))
    assert len(rows) == len(weight) and {r["X"] for r in rows} == set(weight)
    loads = collections.Counter()
    for r in rows:
        loads[r["GROUP_ID"]] += weight[r["X"]]
    alone = largest > sum(size) / 5  # nothing joins a value that weighs more than a fair share
    level = (sum(size) - largest) / 4 if alone else sum(size) / 5
    assert set(loads) == set(range(5)) and (not alone or largest in loads.values())
    assert all(abs(x - level) <= sorted(size)[-5 * heaviest - 1] for x in loads.values() if not alone or x != largest)


def test_light_values_of_equal_weight_and_none(make):
    s = make(X=list(range(100)), SIZE=[1] * 100)
    count = collections.Counter(r["GROUP_ID"] for r in st.partition_evenly_into_groups(s, "X", "SIZE", 4, heaviest=2).collect())
    assert sorted(count) == [0, 1, 2, 3] and max(count.values()) - min(count.values()) <= 1
    empty = s.using(s.df.limit(0))
    assert st.partition_evenly_into_groups(empty, "X", "SIZE", 4).count() == 0


def test_bins(make):
    s = make(X=[9, 8, 5, 6, 7, 0])
    assert values(s.df.withColumn("b", st.cut(s.df, "X", 3, list("abc"))), "b") == list("ccbbca")
    q = make(X=[10, 3, 5, 6, 7, 1])
    assert values(q.df.withColumn("b", st.qcut(q.df, "X", 3, list("abc"))), "b") == list("cabbca")


def test_returns_and_portfolio(make):
    s = make(PRICE=[1.0, 2.0, 3.0, 6.0], offset=[0, 1000, 2500, 4500], end=T0 + timedelta(seconds=8))
    assert values(st.return_ep(s, "PRICE", Buckets(2)), "return") == [2.0, 1.5, 2.0, 1.0]
    p = make(PRICE=[10.0, 12.5, 11.0, 10.2, 15.0], W=[1, 2, -1, 2, 2])
    assert st.portfolio_price(p, weight="W").select("VALUE", "NUM_SYMBOLS").collect()[0] == (30.0, 1)


def test_distinct(make):
    s = make(A=[1, 1, 2, 1, 3])
    assert tk.num_distinct(s, ["A"]).collect()[0]["num_distinct"] == 3
    assert values(tk.running_num_distinct(s, ["A"]), "num_distinct") == [1, 1, 2, 2, 3]


def test_months_and_zoned_days(spark):
    from datetime import datetime

    from tickloom.sources.readers import ticks

    times = [datetime(2024, 3, 9, 12), datetime(2024, 3, 10, 12), datetime(2024, 3, 11, 3, 30), datetime(2024, 3, 11, 12)]
    start = datetime(2024, 3, 9, 5)
    s = ticks(spark, {"A": [1, 2, 3, 4]}, start, datetime(2024, 3, 12, 4), [(t - start).total_seconds() * 1000 for t in times])
    out = ag.agg(s, {"S": ag.sum_("A")}, Buckets(1, "days", zone="America/New_York"))
    # The second local day lasts 23 hours.
    assert values(out, "ts", "S") == [(datetime(2024, 3, 10, 5), 1), (datetime(2024, 3, 11, 4), 5), (datetime(2024, 3, 12, 4), 4)]
