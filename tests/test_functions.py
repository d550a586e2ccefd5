"""Golden values of scalar functions, options and books."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import T0, at, values
from tickloom.core import TMP
from tickloom.functions import dates as dt
from tickloom.functions import numeric as nu
from tickloom.functions import text as tx
from tickloom.operators import book as ob
from tickloom.operators import trading as tr
from tickloom.operators.buckets import Buckets


@pytest.fixture(scope="module")
def one(spark):
    row = (-1.5, 7, -21, "US_COMP::TRD", "abcdef", datetime(2020, 11, 11, 5, 4, 13, 101737))
    return spark.createDataFrame([row], "a double, b long, c long, s string, t string, ts timestamp_ntz")


CASES = [
    (lambda: nu.round_("a"), -1.0), (lambda: nu.round_("a", 0, "downward"), -2.0),
    (lambda: nu.round_(F.lit(-123.45), 1), -123.4), (lambda: nu.round_("a", 0, "away_from_zero"), -2.0),
    (lambda: nu.gcd("b", "c"), 7), (lambda: nu.div("c", 4), -5), (lambda: nu.mod("c", 4), -1), (lambda: nu.div("c", 0), None),
    (lambda: nu.divide("a", F.lit(0)), -math.inf), (lambda: nu.text_to_float(F.lit(" -1.5e2x")), -150.0),
    (lambda: nu.text_to_int(F.lit("x")), 0), (lambda: nu.to_int("a"), -1),
    (lambda: nu.compare(F.lit(2.17), 2.1, 0.01), 1), (lambda: nu.compare(F.lit(2.17), 2.1, 0.1), 0),
    (lambda: tx.token("s", ":", -1), "TRD"), (lambda: tx.token("s", ":", 999), ""), (lambda: tx.substr("t", -3), "def"),
    (lambda: tx.substr(F.lit("12345     "), -3, rtrim=True), "345"), (lambda: tx.substr("t", 2, 2), "cd"), (lambda: tx.get("t", 2), "c"),
    (lambda: tx.slice_("t", -3, -1), "de"), (lambda: tx.slice_("t", 1), "bcdef"), (lambda: tx.find("t", "c"), 2), (lambda: tx.find("t", "z"), -1),
    (lambda: tx.find(F.lit("ababab"), "ab", 1), 2), (lambda: tx.insert(F.lit("aaaaaaa"), 3, 1, "X"), "aaXaaaa"),
    (lambda: tx.insert(F.lit("cccc"), 3, 2, ""), "cc"),
    (lambda: tx.regex_replace(F.lit("A Table, A Chair"), "An? ", "The "), "The Table, A Chair"),
    (lambda: tx.regex_replace(F.lit("A Table, An Apple"), "An? ", "The ", every=True), "The Table, The Apple"),
    (lambda: tx.regex_replace(F.lit("11/12/1992"), r"(\d{1,2})/(\d{1,2})/", r"\2.\1."), "12.11.1992"),
    (lambda: tx.extract(F.lit("Mr. Smith: +1348 +4781"), r"\+\d{4}"), "+1348"),
    (lambda: tx.extract(F.lit("Mr. Smith: 1992/12/22"), r"(\d{4})/(\d{2})/(\d{2})", r"birth year: \1"), "birth year: 1992"),
    (lambda: tx.extract(F.lit("mr. BroWn"), r"(m)([rs]\. )([a-z])([a-z]*)", r"\u1\l2\u3\l4", caseless=True), "Mr. Brown"),
    (lambda: tx.format_("A is about {:.2f} and {0}", F.lit(12.3456)), "A is about 12.35 and 12.3456"),
    (lambda: dt.strftime("ts", "%Y/%m/%d %H:%M:%S.%J"), "2020/11/11 05:04:13.101737000"),
    (lambda: dt.date_trunc("week", "ts"), datetime(2020, 11, 8)), (lambda: dt.day_of_week("ts"), 3),
    (lambda: dt.date_trunc(F.lit("millisecond"), "ts"), datetime(2020, 11, 11, 5, 4, 13, 101000)),
    (lambda: dt.to_datetime(F.lit("1693825877111.002001"), unit="ns"), datetime(2023, 9, 4, 11, 11, 17, 111002)),
    (lambda: dt.to_datetime(F.lit("5/17/22-11:10:56.123456789"), "%m/%d/%y-%H:%M:%S.%J"), datetime(2022, 5, 17, 11, 10, 56, 123456)),
    (lambda: dt.to_datetime(F.lit("20220517"), "%Y%m%d"), datetime(2022, 5, 17)),
    (lambda: dt.to_datetime(F.lit("nonsense"), "%Y%m%d"), None),
    (lambda: dt.add("ts", "Month", 4), datetime(2021, 3, 11, 5, 4, 13, 101737)),
]


@pytest.mark.parametrize("i", range(len(CASES)))
def test_scalar(one, i):
    build, want = CASES[i]
    assert one.select(build().alias("x")).collect()[0]["x"] == want


def test_weeks_start_on_sunday(spark):
    df = spark.createDataFrame([(datetime(2020, m, 1),) for m in range(3, 8)], "ts timestamp_ntz")
    assert [r["w"] for r in df.select(dt.week("ts").alias("w")).collect()] == [10, 14, 18, 23, 27]


def test_normal_distribution(spark):
    xs = [i / 7 for i in range(-60, 61)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(tr.normal_cdf(F.col("x")).alias("c")).collect()
    assert max(abs(r["c"] - 0.5 * math.erfc(-x / math.sqrt(2))) for x, r in zip(xs, got)) < 1e-13


def test_option_values(make):
    s = make(PRICE=[100.0, 100.0], OPTION_PRICE=[10.450583572185565, 5.573526022256971], OPTION_TYPE=["CALL", "PUT"],
             STRIKE_PRICE=[100.0, 100.0], DAYS_TILL_EXPIRATION=[365, 365], K=[0, 1])
    s = s.using(s.df, keys=("K",))
    assert [round(v, 6) for v in values(tr.option_price(s, interest_rate=0.05), "VALUE", order="K")] == [10.450584, 5.573526]
    tree = values(tr.option_price(s, interest_rate=0.05, model="CRR", steps=500), "VALUE", order="K")
    assert abs(tree[0] - 10.4506) < 0.01 and abs(tree[1] - 5.5735) < 0.01
    assert [round(v, 8) for v in values(tr.implied_vol(s, interest_rate=0.05), "VALUE", order="K")] == [0.2, 0.2]


def test_book(make):
    s = make(offset=[0, 1, 2, 3, 4, 1500, 1600], PRICE=[10.0, 9.0, 11.0, 12.0, 9.5, 10.0, 11.0], SIZE=[5, 7, 3, 4, 2, 0, 9],
             BUY_SELL_FLAG=[0, 0, 1, 1, 0, 0, 1], end=T0 + timedelta(seconds=2))
    book = ob.ob_snapshot(s, Buckets(1))
    assert values(book, "PRICE", "SIZE", "LEVEL", order=["ts", "BUY_SELL_FLAG", "LEVEL"]) == [
        (10.0, 5, 1), (9.5, 2, 2), (9.0, 7, 3), (11.0, 3, 1), (12.0, 4, 2),
        (9.5, 2, 1), (9.0, 7, 2), (11.0, 9, 1), (12.0, 4, 2)]
    assert values(ob.ob_snapshot(s, Buckets(1), max_depth_shares=6, side="BID"), "PRICE", "SIZE", order=["ts", "LEVEL"]) == [
        (10.0, 5), (9.5, 1), (9.5, 2), (9.0, 4)]
    assert values(ob.ob_size(s, Buckets(2)), "ASK_VALUE", "BID_VALUE") == [(13.0, 9.0)]
    changes = ob.book_diff(ob.ob_snapshot_flat(s, 2, Buckets(1)), 2)
    assert sorted(values(changes, "BUY_SELL_FLAG", "PRICE", "SIZE")) == [(0, 9.0, 7), (0, 10.0, 0), (1, 11.0, 9)]


def replayed(rows, ends):
    """The books at ``ends`` by replaying updates (ms, side, price, size), older crossed levels removed."""
    out = []
    for end in ends:
        book = {}
        for ms, side, price, size in rows:
            if ms >= end:
                break
            if size > 0:
                book = {(s, p): n for (s, p), n in book.items() if s == side or (p > price if side == 0 else p < price)}
                book[side, price] = size
            else:
                book.pop((side, price), None)
        out += [(end, s, p, n) for (s, p), n in sorted(book.items())]
    return out


@pytest.mark.parametrize("slice_us", [7000, 50_000, 10**9])
def test_uncrossed_book(make, slice_us):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        side, middle = rng.randrange(2), 100 + 8 * math.sin(i / 40)
        rows.append((i // 2, side, float(round(middle + (1 if side else -1) * rng.randrange(-2, 12))), rng.choice([0, 1, 2, 3])))
    s = make(offset=[x[0] for x in rows], BUY_SELL_FLAG=[x[1] for x in rows], PRICE=[x[2] for x in rows], SIZE=[x[3] for x in rows],
             end=T0 + timedelta(milliseconds=220), slice_us=slice_us)
    book = values(ob.ob_snapshot(s, Buckets(0.02), uncross=True), "ts", "BUY_SELL_FLAG", "PRICE", "SIZE", order=["ts", "BUY_SELL_FLAG", "PRICE"])
    want = replayed(rows, range(20, 221, 20))
    assert book == [(T0 + timedelta(milliseconds=ms), side, price, size) for ms, side, price, size in want]
    plain = ob.ob_snapshot(s, Buckets(0.02)).df.count()
    assert len(want) < plain


def test_uncrossed_book_of_odd_ticks(make):
    """Neither a tick without a price or size nor NaN crosses anything; an empty book stays empty; a level comes back with its next update."""
    s = make(PRICE=[10.0, 1.0, float("nan"), 10.0, 9.0, 10.0], SIZE=[5, 7, 3, 0, 2, 4], BUY_SELL_FLAG=[0, 1, 1, 1, 1, 0], end=T0 + timedelta(seconds=1))
    s = s.using(s.df.withColumn("PRICE", F.expr("if(SIZE = 7, null, PRICE)")))
    assert values(ob.crossed(s), f"{TMP}crossed", order="seq") == [1_070_236_800_004_000, None, None, 1_070_236_800_005_000, 1_070_236_800_005_000, None]
    book = ob.ob_snapshot(s.using(s.df.where("PRICE = PRICE and not isnan(PRICE)")), uncross=True)
    assert values(book, "BUY_SELL_FLAG", "PRICE", "SIZE", order="BUY_SELL_FLAG") == [(0, 10.0, 4)]
    assert ob.ob_snapshot(s.using(s.df.limit(0)), uncross=True).df.count() == 0


def test_book_in_buckets_of_ticks(make):
    """The book after every second tick, the open bucket at the end; buckets closed by a condition with their own stamps."""
    s = make(offset=[0, 1, 2, 3, 4], PRICE=[10.0, 9.0, 10.0, 12.0, 12.0], SIZE=[5, 7, 0, 4, 6], BUY_SELL_FLAG=[0, 0, 0, 1, 1], end=T0 + timedelta(seconds=2))
    book = values(ob.ob_snapshot(s, Buckets(2, "ticks")), "ts", "PRICE", "SIZE", order=["ts", "BUY_SELL_FLAG", "LEVEL"])
    assert book == [(at(1), 10.0, 5), (at(1), 9.0, 7), (at(3), 9.0, 7), (at(3), 12.0, 4), (at(2000), 9.0, 7), (at(2000), 12.0, 6)]
    closing = Buckets(unit="flexible", condition=F.col("SIZE") == 0)
    book = values(ob.ob_snapshot(s, closing), "ts", "PRICE", "SIZE", order=["ts", "BUY_SELL_FLAG", "LEVEL"])
    assert book == [(at(2), 10.0, 5), (at(2), 9.0, 7), (at(2000), 9.0, 7), (at(2000), 12.0, 6)]
    cleared = ob.ob_snapshot(s, Buckets(2, "ticks"), clear=F.col("SIZE") == 0)
    assert values(cleared, "ts", "PRICE", "SIZE", order=["ts", "BUY_SELL_FLAG", "LEVEL"]) == [(at(1), 10.0, 5), (at(1), 9.0, 7), (at(3), 12.0, 4), (at(2000), 12.0, 6)]
    days = ob.ob_snapshot(s.using(s.df, end=datetime(2003, 12, 3)), Buckets(1, "days"))
    assert values(days, "ts", "PRICE", order=["ts", "LEVEL", "PRICE"]) == [(datetime(2003, 12, d), p) for d in (2, 3) for p in (9.0, 12.0)]


def test_changes_of_a_book(make):
    s = make(offset=[0, 1, 2, 3, 4], PRICE=[10.0, 9.0, 10.0, 9.0, 9.0], SIZE=[5, 7, 0, 8, 0], BUY_SELL_FLAG=[0] * 5, end=T0 + timedelta(milliseconds=6))
    for buckets, ends in ((Buckets(1, "ticks"), [0, 1, 2, 3, 4]), (Buckets(0.001), [1, 2, 3, 4, 5])):
        out = ob.ob_snapshot(s, buckets, show_only_changes=True)
        want = [(10.0, 5, 1), (9.0, 7, 2), (10.0, 0, 0), (9.0, 8, 1), (9.0, 0, 0)]
        assert values(out, "ts", "PRICE", "SIZE", "LEVEL") == [(at(ms), *row) for ms, row in zip(ends, want, strict=True)]
    with pytest.raises(ValueError):
        ob.ob_snapshot(s, show_only_changes=True, show_full_detail=True)


def test_entries_and_delimiters_of_a_book(make):
    s = make(offset=[0, 1, 2, 3], PRICE=[10.0, 10.0, 10.0, 9.0], SIZE=[5, 7, 6, 1], BUY_SELL_FLAG=[0] * 4, ORDER=["a", "b", "a", "c"], end=T0 + timedelta(seconds=3))
    summed = ob.ob_snapshot(s, state_key=["ORDER"])
    assert values(summed, "PRICE", "SIZE", "LEVEL", "UPDATE_TIME", order="LEVEL") == [(10.0, 13, 1, at(2)), (9.0, 1, 2, at(3))]
    full = ob.ob_snapshot(s, state_key=["ORDER"], show_full_detail=True, max_levels=1)
    assert values(full, "PRICE", "SIZE", "LEVEL", "ORDER", order="ORDER") == [(10.0, 6, 1, "a"), (10.0, 7, 1, "b")]
    gone = ob.ob_snapshot(s, Buckets(1), state_key=["ORDER"], max_inactivity_sec=0.9985)
    assert values(gone, "ts", "PRICE", "SIZE", order=["ts", "LEVEL"]) == [(at(1000), 10.0, 6), (at(1000), 9.0, 1)]
    marked = ob.ob_snapshot(s, book_delimiters=True)
    assert [r[:3] for r in values(marked, "DELIMITER", "LEVEL", "SIZE", "PRICE", order=list(marked.seq))] == [("0", 1, 6), ("0", 2, 1), ("D", 0, 0)]


def test_virtual_book_times_out(make):
    q = make(offset=[0, 1000, 5000], ASK_PRICE=[22.28, 21.8, 21.8], ASK_SIZE=[500, 500, 300], BID_PRICE=[21.66] * 3, BID_SIZE=[100] * 3,
             end=T0 + timedelta(seconds=9))
    plain = values(ob.virtual_ob(q), "PRICE", "SIZE", order=["ts", "sub"])
    assert plain == [(22.28, 500), (21.66, 100), (22.28, -500), (21.8, 500), (21.8, -500), (21.8, 300)]
    stale = values(ob.virtual_ob(q, quote_timeout=2.0), "PRICE", "SIZE", order=["ts", "sub"])
    assert stale[4:6] == [(21.8, -500), (21.66, -100)] and len(stale) == 10
