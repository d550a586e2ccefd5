"""Golden tables of time joins, merges and comparisons."""

import pytest
from pyspark.sql import functions as F

from conftest import at, values
from tickloom.operators import aggregate as ag
from tickloom.operators import filters as fi
from tickloom.operators import joins as jn
from tickloom.operators import merging as mg
from tickloom.operators import outliers
from tickloom.operators import project as pj
from tickloom.operators import trading as tr


@pytest.fixture
def pair(make):
    return make(A=[1, 2, 3], offset=[1, 2, 3]), make(B=[1, 2, 4], offset=[1, 2, 4])


@pytest.mark.parametrize("kw, want", [
    ({}, [(1, None), (2, 1), (3, 2)]),
    ({"leading": 1}, [(1, 1), (2, 2), (3, 4)]),
    ({"how": "inner"}, [(2, 1), (3, 2)]),
    ({"how": "inner", "match_if_identical_times": True}, [(1, 1), (2, 2)]),
])
def test_join_by_time(pair, kw, want):
    assert values(jn.join_by_time(list(pair), **kw), "A", "B") == want


def test_source_order_settles_ties(pair):
    a, b = pair
    assert values(jn.join_by_time([b, a]), "B", "A") == [(1, None), (2, 1), (4, 3)]


@pytest.mark.parametrize("policy, want", [
    ("arrival_order", [(1, None), (2, 1)]),
    ("latest_ticks", [(2, 2)]),
    ("each_for_leader_with_first", [(1, 1), (2, 1)]),
    ("each_for_leader_with_latest", [(1, 2), (2, 2)]),
])
def test_policies(make, policy, want):
    a = make(A=[1, 2], offset=[0, 0], OM=[0, 3])
    b = make(B=[1, 2], offset=[0, 0], OM=[2, 4])
    a, b = (s.using(s.df.drop("seq"), seq=("OM",)) for s in (a, b))
    out = jn.join_by_time([a, b], policy=policy, arrival="OM" if policy == "arrival_order" else None)
    assert values(out, "A", "B", order="A") == want


def test_typed_defaults(pair):
    assert values(jn.join_by_time(list(pair), typed_defaults=True), "B") == [0, 1, 2]


def test_conflicting_names_are_refused(make):
    with pytest.raises(ValueError, match="several sources"):
        jn.join_by_time([make(A=[1]), make(A=[2])])


@pytest.mark.parametrize("kw, sums, counts", [
    ({}, [0, 3, 10], [1, 3, 5]),
    ({"boundary": "previous"}, [1, 6, 15], [2, 4, 6]),
    ({"delay_ms": 1}, [0, 1, 6], [0, 2, 4]),
    ({"delay_ms": -1}, [1, 6, 15], [2, 4, 6]),
    ({"window": 2, "unit": "ticks"}, [0, 3, 7], [1, 2, 2]),
    ({"window": 0.002}, [0, 3, 7], [1, 2, 2]),
    ({"window": 0.002, "boundary": "previous"}, [1, 5, 9], [2, 2, 2]),
])
@pytest.mark.parametrize("slice_us", [1500, 10**9])
def test_aggregated_window(make, kw, sums, counts, slice_us):
    a = make(A=list(range(7)), slice_us=slice_us)
    b = make(B=[1, 3, 5], offset=[1, 3, 5], slice_us=slice_us)
    out = jn.join_with_aggregated_window(a, b, {"S": ag.sum_("A"), "N": ag.count()}, **kw)
    assert values(out, "S", "N") == list(zip(sums, counts))
    framed = jn.join_with_aggregated_window(a, b, {"S": ag.sum_("A"), "M": ag.max_("A")}, **kw)
    assert values(framed, "S") == sums


def test_window_join_around(make):
    a, b = make(A=list(range(7))), make(B=[1, 3, 5], offset=[1, 3, 5])
    assert values(jn.window_join(b, a, {"S": ag.sum_("A")}, -2000, 1000), "S") == [1, 6, 12]
    assert values(jn.window_join(b, a, {"S": ag.sum_("A"), "M": ag.min_("A")}, -2000, 1000), "S", "M") == [(1, 0), (6, 1), (12, 3)]


def test_point_in_time(make):
    q, t = make(ASK=[20, 21, 22, 23, 24, 25]), make(PRICE=[1, 3, 5], offset=[1, 3, 5])
    assert values(jn.point_in_time(q, t, [0]), "PRICE", "TICK_TIME") == [(1, at(1)), (1, at(1)), (3, at(3)), (3, at(3)), (5, at(5))]
    ahead = jn.point_in_time(q, t, [1], "num_ticks", ["ASK"])
    assert values(ahead, "ASK", "PRICE") == [(20, 1), (21, 3), (22, 3), (23, 5), (24, 5)]


def test_equi_and_positional_join(make):
    left, right = make(ID=[1, 2, 3], A=[10, 20, 30]), make(ID=[2, 3, 4], A=[7, 8, 9])
    out = jn.join(left.df.select("ID", "A"), right.df.select("ID", "A"), ["ID"], "left_outer", typed_defaults=True)
    assert values(out, "ID", "A", "RIGHT_A", order="ID") == [(1, 10, 0), (2, 20, 7), (3, 30, 8)]
    assert values(jn.join_same_size(left, right), "ID", "RIGHT_ID") == [(1, 2), (2, 3), (3, 4)]


def test_positional_join_refuses_other_sizes(make):
    with pytest.raises(Exception, match="differ in size"):
        jn.join_same_size(make(A=[1, 2, 3]), make(B=[1, 2])).collect()


def test_interval_join_against_all_pairs(make):
    s = make(A=list(range(60)))
    spans = make(L=[3, 8, 1, 30, 5], offset=[0, 4, 10, 20, 55])
    spans = spans.df.select((spans.us).alias("b"), (spans.us + F.col("L") * 1000).alias("e"), "L")
    got = jn.interval_join(s, spans, F.col("b"), F.col("e"), bin_us=4000).select("A", "L").collect()
    want = [(a, n) for a in range(60) for b, n in zip([0, 4, 10, 20, 55], [3, 8, 1, 30, 5]) if b <= a < b + n]
    assert sorted((r["A"], r["L"]) for r in got) == sorted(want)


def test_coalesce_feeds(make):
    a, b = make(A=[1, 2, 3], offset=[0, 3000, 6000]), make(A=[4, 5, 6], offset=[999, 4000, 7001])
    assert values(mg.coalesce([b, a], 1_000_000, ["b", "a"]), "A", "SOURCE") == [(4, "b"), (5, "b"), (3, "a"), (6, "b")]


def test_diff(make):
    out = mg.diff(make(A=[1, 2], B=[0, 0]), make(A=[1, 3], B=[0, 0]), show="all")
    assert values(out, "MATCH_STATUS", "L_A", "R_A") == [(1, 1, 1), (0, 2, 3)]
    lone = mg.diff(make(A=[1, 2, 5]), make(A=[1]))
    assert values(lone, "MATCH_STATUS", "L_A", "R_A") == [(2, 2, None), (2, 5, None)]


def test_lee_and_ready(make):
    t = make(PRICE=[10.0, 10.5, 10.5, 10.2, 10.2], SIZE=[1] * 5, offset=[5, 6, 7, 8, 9])
    q = make(BID_PRICE=[10.0, 10.0], ASK_PRICE=[11.0, 11.0], offset=[5, 6])
    assert values(mg.lee_and_ready(t, q), "BuySellFlag") == [-1, 1, 1, -1, -1]


def test_corporate_actions(make):
    t = make(PRICE=[10.0, 10.0, 10.0, 10.0], offset=[5, 6, 7, 8])
    f = make(FACTOR=[0.5, 2.0], offset=[6, 8])
    assert [round(x, 6) for x in values(mg.corp_actions(t, f), "PRICE")] == [10.0, 20.0, 20.0, 10.0]
    assert [round(x, 6) for x in values(mg.corp_actions(t, f, adjustment=at(7)), "PRICE")] == [5.0, 10.0, 10.0, 10.0]


def test_realised_profit(make):
    s = make(
        PRICE=[1.0, 2.0, 3.0, 2.5, 4.0, 5.0, 6.0, 7.0, 3.0, 4.0, 1.0],
        SIZE=[700, 20, 570, 600, 100, 100, 100, 100, 150, 10, 100],
        SIDE=["B", "B", "B", "S", "S", "S", "S", "S", "B", "B", "S"],
    )
    want = [0, 0, 0, 900, 300, 220, 300, 400, 0, 0, -200]
    for width in (90, 10_000):
        assert values(tr.pnl_realized(s, side="SIDE", quantity_slice=width), "PNL_REALIZED") == want


def test_outliers_follow_the_last_kept_tick(make):
    assert values(outliers.skip_bad_tick(make(X=[10, 11, 15, 11, 9, 10]), "X", 1.2), "X") == [10, 11, 11, 10]
    assert values(outliers.skip_bad_tick(make(X=[10, 11, 15, 11, 9, 10]), "X", 1.2, discard_on_match=True), "X") == [15, 9]
    signed = outliers.skip_bad_tick(make(X=[10, -11, -15, 11, 9, -10]), "X", 1.2, use_absolute_values=True)
    assert values(signed, "X") == [10, -11, 11, -10] and signed.df.columns == make(X=[1]).df.columns


def test_outliers_against_brute_force(make):
    import numpy as np

    rng = np.random.default_rng(5)
    x = np.exp(np.cumsum(rng.normal(0, 0.1, 600)) + rng.normal(0, 0.2, 600)).tolist()
    want, last = [], None
    for v in x:
        if last is None or max(v, last) <= 1.15 * min(v, last):
            want.append(v)
            last = v
    for width in (7000, 10**9):
        assert values(outliers.skip_bad_tick(make(X=x, slice_us=width), "X", 1.15), "X") == want


def test_row_operators(make):
    assert values(pj.transpose_rows(make(A=[1, 2, 3, 4, 5]), 2, ["A"]), "A_1", "A_2") == [(2, 1), (4, 3)]
    assert values(fi.row_slice(make(A=list(range(10))), -5, -1, 2), "A") == [5, 7]
    assert values(fi.stop_on_first_mismatch(make(A=[1, 2, 5, 1]), F.col("A") < 3), "A") == [1, 2]
    inserted = pj.insert_tick(make(A=[1, 2]), {"A": F.lit(9)}, where=F.col("A") == 2)
    assert values(inserted, "A", order=["ts", "sub"]) == [1, 9, 2]
    s = pj.lag(make(A=[1, 2, 3]), {"P": ("A", 2)}, typed_defaults=True)
    assert values(s, "P") == [0, 0, 1]


def test_throw(make):
    with pytest.raises(Exception, match="too large"):
        pj.throw(make(A=[1, 9]).df, F.col("A") > 5, "too large").collect()


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("bin_us", [1, 10, 10**9])
def test_intervals_of_every_length(spark, how, bin_us):
    """Against all pairs; a long interval has few copies."""
    import random

    from tickloom.core import Series
    from tickloom.operators.joins import interval_join

    r = random.Random(4)
    ticks = [(r.choice("ab"), r.randrange(-500, 5000), i) for i in range(150)]
    spans = [(r.choice("abc"), b, b + r.choice([-3, 0, 1, 7, 40, 300, 4000, 10**9]), i) for i, b in enumerate(r.randrange(-700, 5000) for _ in range(40))]
    left = Series(spark.createDataFrame(ticks, "k string, us long, seq long"), ts="us", us_column="us", keys=("k",))
    right = spark.createDataFrame(spans, "k string, b long, e long, id long")
    got = interval_join(left, right, F.col("b"), F.col("e"), how, bin_us=bin_us)
    pairs = {(k, t, i, s) for k, t, i in ticks for q, b, e, s in spans if k == q and b <= t < e}
    if how == "left":
        pairs |= {(k, t, i, None) for k, t, i in ticks if not any(k == q and b <= t < e for q, b, e, _ in spans)}
    rows = [tuple(x) for x in got.select("k", "us", "seq", "id").collect()]
    assert set(rows) == pairs and len(rows) == len(pairs)
    assert got.columns == ["k", "us", "seq", "b", "e", "id"]
    assert interval_join(left, right.limit(0), F.col("b"), F.col("e"), how).count() == (150 if how == "left" else 0)


def test_join_with_query_on_a_computed_symbol(spark, make):
    """An expression picks the symbol, parameters shape the fields, empty results take defaults."""
    from tickloom.operators.joins import join_with_query

    data = make(A=[1, 2, 9], B=[2, 4, 9], PREF=["_", "^", "x"])
    other = make(N=["3", "6", "6"], TYPE=["three", "six", None], offset=[0, 1, 500])
    other = other.using(other.df, keys=("N",))
    symbol = {"N": (F.col("A") + F.col("B")).cast("string")}
    fields = {"TYPE": lambda p, t: F.concat(p["pref"], t["TYPE"])}
    take = lambda **more: join_with_query(data, other, -100_000, 100_000, symbol=symbol, params={"pref": F.col("PREF")}, fields=fields, **more)
    assert values(take(how="inner"), "A", "TYPE", order="A") == [(1, "_three"), (2, "^six")]
    assert values(take(), "A", "TYPE", order="A") == [(1, "_three"), (2, "^six"), (9, "")]
    out = take(where=F.col("A") != 2, prefix="P_", keep_time="AT", defaults={"TYPE": F.lit("none")})
    assert values(out, "A", "P_TYPE", order="A") == [(1, "_three"), (2, "none"), (9, "none")]
    assert values(out, "AT", order="A")[0] == at(0)
    assert values(take(how="inner", condition=lambda p, t: t["TYPE"] != "six"), "A", order="A") == [1]
    whole = join_with_query(data, other, 0, 600_000, how="inner", symbol=symbol)
    assert values(whole, "A", "TYPE", order=["A", "TYPE"]) == [(1, "three"), (2, None), (2, "six")]
