"""Queries over order books, trade analytics and recipes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.core import DAY, HOUR
from tickloom.operators import book as ob
from tickloom.operators import trading as tr
from tickloom.operators.buckets import Buckets
from tickloom.plans import recipes as rc
from tickloom.plans.registry import QUOTES_SQL, R, S0, S1, TRADES_SQL, events, query, quotes, r, table, trades


def _updates(spark, sf):
    """Events read as level updates: a price grid from the value, side and size from the number."""
    s = events(spark, sf)
    df = s.df.select(
        "user_id", "ts", "event_id",
        F.when(F.col("event_type").isin("view", "click"), 50.0 - F.floor("value") % 10).otherwise(51.0 + F.floor("value") % 10).alias("PRICE"),
        (F.col("event_id") % 5 * 100).alias("SIZE"),
        F.when(F.col("event_type").isin("view", "click"), 0).otherwise(1).alias("BUY_SELL_FLAG"),
        (F.col("value") > 80).alias("clears"),
    )
    return s.using(df)


UPDATES = """u AS (SELECT user_id, ts, event_id, CASE WHEN event_type IN ('view', 'click') THEN 50.0 - floor(value) % 10 ELSE 51.0 + floor(value) % 10 END::DOUBLE AS PRICE,
  event_id % 5 * 100 AS SIZE, CASE WHEN event_type IN ('view', 'click') THEN 0 ELSE 1 END AS BUY_SELL_FLAG, value > 80 AS clears FROM events)"""
BOOK = f"""{UPDATES}, iv AS (SELECT *, epoch_us(ts) AS us, lead(epoch_us(ts), 1, {S1} + 1) OVER (PARTITION BY user_id, BUY_SELL_FLAG, PRICE ORDER BY ts, event_id) AS nx FROM u),
  e AS (SELECT {S0} + (unnest(range(0, 10)) + 1) * {3 * DAY} AS en),
  lv AS (SELECT iv.*, e.en FROM iv JOIN e ON iv.us < e.en AND iv.nx >= e.en WHERE SIZE > 0),
  bk AS (SELECT *, row_number() OVER (PARTITION BY user_id, en, BUY_SELL_FLAG ORDER BY CASE WHEN BUY_SELL_FLAG = 0 THEN -PRICE ELSE PRICE END) AS LEVEL FROM lv)"""
B3 = Buckets(3 * 86400)


@query("ob_snapshot", f"WITH {BOOK} SELECT user_id, make_timestamp(en) AS ts, BUY_SELL_FLAG, LEVEL, PRICE, SIZE, ts AS UPDATE_TIME FROM bk WHERE LEVEL <= 3")
def _(spark, sf):
    out = ob.ob_snapshot(_updates(spark, sf), B3, max_levels=3)
    return out.df.select("user_id", "ts", "BUY_SELL_FLAG", "LEVEL", "PRICE", "SIZE", "UPDATE_TIME")


@query("ob_snapshot_ticks", f"""
WITH {UPDATES}, n AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 20 AS b FROM u),
  e AS (SELECT user_id, b, CASE WHEN count(*) = 20 THEN max(ts) ELSE TIMESTAMP '2024-01-31' END AS en, max(b) OVER (PARTITION BY user_id) AS top FROM n GROUP BY 1, 2),
  iv AS (SELECT *, lead(b) OVER (PARTITION BY user_id, BUY_SELL_FLAG, PRICE ORDER BY ts, event_id) AS nb FROM n),
  lv AS (SELECT iv.*, e.b AS bn, e.en FROM iv JOIN e ON iv.user_id = e.user_id AND e.b BETWEEN iv.b AND coalesce(iv.nb - 1, e.top) WHERE SIZE > 0),
  bk AS (SELECT *, row_number() OVER (PARTITION BY user_id, bn, BUY_SELL_FLAG ORDER BY CASE WHEN BUY_SELL_FLAG = 0 THEN -PRICE ELSE PRICE END) AS LEVEL FROM lv)
SELECT user_id, en AS ts, BUY_SELL_FLAG, LEVEL, PRICE, SIZE, ts AS UPDATE_TIME FROM bk WHERE LEVEL <= 3""")
def _(spark, sf):
    out = ob.ob_snapshot(_updates(spark, sf), Buckets(20, "ticks"), max_levels=3)
    return out.df.select("user_id", "ts", "BUY_SELL_FLAG", "LEVEL", "PRICE", "SIZE", "UPDATE_TIME")


@query("ob_snapshot_changes", f"""
WITH {BOOK}, o AS (SELECT * REPLACE (en + {3 * DAY} AS en) FROM bk WHERE en < {S1})
SELECT user_id, make_timestamp(en) AS ts, BUY_SELL_FLAG, PRICE, coalesce(bk.LEVEL, 0) AS LEVEL, coalesce(bk.SIZE, 0)::BIGINT AS SIZE, coalesce(bk.ts, o.ts) AS UPDATE_TIME
FROM bk FULL JOIN o USING (user_id, en, BUY_SELL_FLAG, PRICE) WHERE bk.SIZE IS DISTINCT FROM o.SIZE""")
def _(spark, sf):
    out = ob.ob_snapshot(_updates(spark, sf), B3, show_only_changes=True)
    return out.df.select("user_id", "ts", "BUY_SELL_FLAG", "PRICE", "LEVEL", "SIZE", "UPDATE_TIME")


def _entries(spark, sf):
    s = _updates(spark, sf)
    return s.using(s.df.withColumn("VENUE", F.col("event_id") % 3))


ENTRIES = f"""{UPDATES}, iv AS (SELECT *, event_id % 3 AS VENUE, epoch_us(ts) AS us, lead(epoch_us(ts), 1, {S1} + 1) OVER (PARTITION BY user_id, BUY_SELL_FLAG, PRICE, event_id % 3 ORDER BY ts, event_id) AS nx FROM u),
  e AS (SELECT {S0} + (unnest(range(0, 10)) + 1) * {3 * DAY} AS en),
  lv AS (SELECT iv.*, e.en FROM iv JOIN e ON iv.us < e.en AND least(nx, us + {10 * DAY}) >= e.en WHERE SIZE > 0)"""


@query("ob_snapshot_entries", f"WITH {ENTRIES} SELECT user_id, make_timestamp(en) AS ts, BUY_SELL_FLAG, PRICE, sum(SIZE)::BIGINT AS SIZE, max(ts) AS UPDATE_TIME FROM lv GROUP BY user_id, en, BUY_SELL_FLAG, PRICE")
def _(spark, sf):
    out = ob.ob_snapshot(_entries(spark, sf), B3, state_key=["VENUE"], max_inactivity_sec=10 * 86400)
    return out.df.select("user_id", "ts", "BUY_SELL_FLAG", "PRICE", "SIZE", "UPDATE_TIME")


@query("ob_snapshot_full_detail", f"""
WITH {ENTRIES}, bk AS (SELECT *, dense_rank() OVER (PARTITION BY user_id, en, BUY_SELL_FLAG ORDER BY CASE WHEN BUY_SELL_FLAG = 0 THEN -PRICE ELSE PRICE END) AS LEVEL FROM lv)
SELECT user_id, make_timestamp(en) AS ts, BUY_SELL_FLAG, LEVEL, PRICE, SIZE, VENUE, event_id FROM bk WHERE LEVEL <= 2""")
def _(spark, sf):
    out = ob.ob_snapshot(_entries(spark, sf), B3, state_key=["VENUE"], max_inactivity_sec=10 * 86400, max_levels=2, show_full_detail=True)
    return out.df.select("user_id", "ts", "BUY_SELL_FLAG", "LEVEL", "PRICE", "SIZE", "VENUE", "event_id")


def _crossing(spark, sf):
    """Level updates whose sides overlap: bids and asks on one price grid around 50."""
    s = events(spark, sf)
    side = F.when(F.col("event_type").isin("view", "click"), 0).otherwise(1)
    price = F.when(side == 0, 52.0 - F.floor("value") % 12).otherwise(48.0 + F.floor("value") % 12)
    return s.using(s.df.select("user_id", "ts", "event_id", price.alias("PRICE"), (F.col("event_id") % 5 * 100).alias("SIZE"), side.alias("BUY_SELL_FLAG")))


@query("ob_snapshot_uncrossed", f"""
WITH u AS (SELECT user_id, ts, event_id, CASE WHEN event_type IN ('view', 'click') THEN 52.0 - floor(value) % 12 ELSE 48.0 + floor(value) % 12 END::DOUBLE AS PRICE,
  event_id % 5 * 100 AS SIZE, CASE WHEN event_type IN ('view', 'click') THEN 0 ELSE 1 END AS BUY_SELL_FLAG FROM events),
iv AS (SELECT *, epoch_us(ts) AS us, lead(epoch_us(ts), 1, {S1} + 1) OVER (PARTITION BY user_id, BUY_SELL_FLAG, PRICE ORDER BY ts, event_id) AS nx FROM u),
x AS (SELECT a.event_id, min(b.us) AS at FROM iv a JOIN iv b ON a.user_id = b.user_id AND a.BUY_SELL_FLAG <> b.BUY_SELL_FLAG AND b.SIZE > 0
  AND (b.us > a.us OR (b.us = a.us AND b.event_id > a.event_id)) AND CASE WHEN a.BUY_SELL_FLAG = 0 THEN b.PRICE <= a.PRICE ELSE b.PRICE >= a.PRICE END GROUP BY a.event_id),
e AS (SELECT {S0} + (unnest(range(0, 10)) + 1) * {3 * DAY} AS en)
SELECT user_id, make_timestamp(en) AS ts, BUY_SELL_FLAG, PRICE, SIZE, ts AS UPDATE_TIME
FROM iv LEFT JOIN x USING (event_id) JOIN e ON iv.us < e.en AND least(nx, coalesce(x.at, nx)) >= e.en WHERE SIZE > 0""")
def _(spark, sf):
    out = ob.ob_snapshot(_crossing(spark, sf), B3, uncross=True)
    return out.df.select("user_id", "ts", "BUY_SELL_FLAG", "PRICE", "SIZE", "UPDATE_TIME")


@query("ob_snapshot_depth_shares", f"""
WITH {BOOK}, c AS (SELECT *, coalesce(sum(SIZE) OVER (PARTITION BY user_id, en, BUY_SELL_FLAG ORDER BY LEVEL ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bf FROM bk)
SELECT user_id, make_timestamp(en) AS ts, BUY_SELL_FLAG, LEVEL, PRICE, least(SIZE, 500 - bf)::BIGINT AS SIZE FROM c WHERE bf < 500""")
def _(spark, sf):
    out = ob.ob_snapshot(_updates(spark, sf), B3, max_depth_shares=500)
    return out.df.select("user_id", "ts", "BUY_SELL_FLAG", "LEVEL", "PRICE", "SIZE")


@query("ob_snapshot_depth_price", f"""
WITH {BOOK}, c AS (SELECT *, first_value(PRICE) OVER (PARTITION BY user_id, en, BUY_SELL_FLAG ORDER BY LEVEL) AS best FROM bk)
SELECT user_id, make_timestamp(en) AS ts, BUY_SELL_FLAG, LEVEL, PRICE FROM c WHERE CASE WHEN BUY_SELL_FLAG = 0 THEN PRICE >= best * 0.95 ELSE PRICE <= best * 1.05 END""")
def _(spark, sf):
    out = ob.ob_snapshot(_updates(spark, sf), B3, max_depth_for_price=0.05)
    return out.df.select("user_id", "ts", "BUY_SELL_FLAG", "LEVEL", "PRICE")


@query("ob_snapshot_spread", f"""
WITH {BOOK}, c AS (SELECT *, (max(CASE WHEN BUY_SELL_FLAG = 0 THEN PRICE END) OVER w + min(CASE WHEN BUY_SELL_FLAG = 1 THEN PRICE END) OVER w) / 2 AS mid FROM lv WINDOW w AS (PARTITION BY user_id, en))
SELECT user_id, make_timestamp(en) AS ts, BUY_SELL_FLAG, PRICE FROM c WHERE abs(mid - PRICE) <= 4""")
def _(spark, sf):
    return ob.ob_snapshot(_updates(spark, sf), B3, max_spread=8).df.select("user_id", "ts", "BUY_SELL_FLAG", "PRICE")


@query("ob_snapshot_clear", f"""
WITH {UPDATES}, x AS (SELECT *, epoch_us(ts) AS us, min(CASE WHEN clears THEN epoch_us(ts) END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS cl FROM u),
  iv AS (SELECT *, least(lead(us, 1, {S1} + 1) OVER (PARTITION BY user_id, BUY_SELL_FLAG, PRICE ORDER BY ts, event_id), coalesce(cl, {S1} + 1)) AS nx FROM x WHERE NOT clears), e AS (SELECT {S0} + (unnest(range(0, 10)) + 1) * {3 * DAY} AS en)
SELECT user_id, make_timestamp(en) AS ts, count(*) AS levels, sum(SIZE)::BIGINT AS SIZE FROM iv JOIN e ON us < en AND nx >= en WHERE SIZE > 0 GROUP BY 1, 2""")
def _(spark, sf):
    out = ob.ob_snapshot(_updates(spark, sf), B3, clear=F.col("clears"))
    return out.df.groupBy("user_id", "ts").agg(F.count("*").alias("levels"), F.sum("SIZE").alias("SIZE"))


@query("ob_snapshot_wide", f"""
WITH {BOOK}, b AS (SELECT * FROM bk WHERE BUY_SELL_FLAG = 0), a AS (SELECT * FROM bk WHERE BUY_SELL_FLAG = 1)
SELECT coalesce(b.user_id, a.user_id) AS user_id, make_timestamp(coalesce(b.en, a.en)) AS ts, coalesce(b.LEVEL, a.LEVEL) AS LEVEL, coalesce(b.PRICE, -1) AS BID_PRICE, coalesce(b.SIZE, -1) AS BID_SIZE,
       coalesce(a.PRICE, -1) AS ASK_PRICE, coalesce(a.SIZE, -1) AS ASK_SIZE FROM b FULL JOIN a ON a.user_id = b.user_id AND a.en = b.en AND a.LEVEL = b.LEVEL""")
def _(spark, sf):
    df = ob.ob_snapshot_wide(_updates(spark, sf), B3).df
    return df.select("user_id", "ts", "LEVEL", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("BID_PRICE", "BID_SIZE", "ASK_PRICE", "ASK_SIZE")])


@query("ob_snapshot_flat", f"""
WITH {BOOK}
SELECT user_id, make_timestamp(en) AS ts, {', '.join(f"coalesce(max(CASE WHEN BUY_SELL_FLAG = {f} AND LEVEL = {k} THEN {c} END), -1) AS {n}_{c}{k}" for k in (1, 2) for f, n in ((0, 'BID'), (1, 'ASK')) for c in ('PRICE', 'SIZE'))}
FROM bk WHERE LEVEL <= 2 GROUP BY user_id, en""")
def _(spark, sf):
    df = ob.ob_snapshot_flat(_updates(spark, sf), 2, B3).df
    cols = [f"{n}_{c}{k}" for k in (1, 2) for n in ("BID", "ASK") for c in ("PRICE", "SIZE")]
    return df.select("user_id", "ts", *[F.coalesce(c, F.lit(-1)).alias(c) for c in cols])


@query("ob_summary", f"""
WITH {BOOK}
SELECT user_id, make_timestamp(en) AS ts, coalesce(sum(SIZE) FILTER (BUY_SELL_FLAG = 0), 0)::BIGINT AS BID_SIZE, {R('coalesce(sum(PRICE * SIZE) FILTER (BUY_SELL_FLAG = 0) / sum(SIZE) FILTER (BUY_SELL_FLAG = 0), -1)')} AS BID_VWAP,
       coalesce(max(PRICE) FILTER (BUY_SELL_FLAG = 0), -1) AS BEST_BID_PRICE, coalesce(max(PRICE) FILTER (BUY_SELL_FLAG = 1), -1) AS WORST_ASK_PRICE, count(*) FILTER (BUY_SELL_FLAG = 1) AS NUM_ASK_LEVELS FROM bk GROUP BY user_id, en""")
def _(spark, sf):
    df = ob.ob_summary(_updates(spark, sf), B3).df
    return df.select("user_id", "ts", "BID_SIZE", r(F.coalesce("BID_VWAP", F.lit(-1.0))).alias("BID_VWAP"), F.coalesce("BEST_BID_PRICE", F.lit(-1.0)).alias("BEST_BID_PRICE"),
                     F.coalesce("WORST_ASK_PRICE", F.lit(-1.0)).alias("WORST_ASK_PRICE"), "NUM_ASK_LEVELS")


@query("ob_size_vwap_levels", f"""
WITH {BOOK}
SELECT user_id, make_timestamp(en) AS ts, coalesce(sum(SIZE) FILTER (BUY_SELL_FLAG = 0), 0)::DOUBLE AS size_bid, coalesce(sum(SIZE) FILTER (BUY_SELL_FLAG = 1), 0)::DOUBLE AS size_ask,
       {R('coalesce(sum(PRICE * SIZE) FILTER (BUY_SELL_FLAG = 1) / sum(SIZE) FILTER (BUY_SELL_FLAG = 1), -1)')} AS vwap_ask, count(*) FILTER (BUY_SELL_FLAG = 0) AS n_bid FROM bk GROUP BY user_id, en""")
def _(spark, sf):
    u = _updates(spark, sf)
    size = ob.ob_size(u, B3).df.select("user_id", "ts", F.col("BID_VALUE").alias("size_bid"), F.col("ASK_VALUE").alias("size_ask"))
    vwap = ob.ob_vwap(u, B3).df.select("user_id", "ts", r(F.coalesce("ASK_VALUE", F.lit(-1.0))).alias("vwap_ask"))
    n = ob.ob_num_levels(u, B3).df.select("user_id", "ts", F.col("BID_VALUE").alias("n_bid"))
    return size.join(vwap, ["user_id", "ts"]).join(n, ["user_id", "ts"])


def _quotes(spark, sf):
    q = quotes(spark, sf)
    return q.using(q.df.withColumns({c: r(F.col(c), 2) for c in ("BID_PRICE", "ASK_PRICE")}))


@query("virtual_ob", f"""
WITH {QUOTES_SQL}, q AS (SELECT user_id, ts, event_id, {R('BID_PRICE', 2)} AS b, {R('ASK_PRICE', 2)} AS a FROM quotes),
  x AS (SELECT *, lag(b) OVER w AS pb, lag(a) OVER w AS pa FROM q WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id, 0 AS BUY_SELL_FLAG, b AS PRICE, 100::BIGINT AS SIZE FROM x WHERE pb IS DISTINCT FROM b UNION ALL SELECT user_id, event_id, 0, pb, -100 FROM x WHERE pb <> b
UNION ALL SELECT user_id, event_id, 1, a, 100 FROM x WHERE pa IS DISTINCT FROM a UNION ALL SELECT user_id, event_id, 1, pa, -100 FROM x WHERE pa <> a""")
def _(spark, sf):
    return ob.virtual_ob(_quotes(spark, sf)).df.select("user_id", "event_id", "BUY_SELL_FLAG", "PRICE", "SIZE")


@query("book_diff", f"""
WITH {BOOK}, n AS (SELECT user_id, en, BUY_SELL_FLAG f, PRICE p, SIZE s FROM bk WHERE LEVEL <= 2),
  t AS (SELECT user_id, en, lead(en) OVER (PARTITION BY user_id ORDER BY en) AS nen FROM (SELECT DISTINCT user_id, en FROM n)),
  old AS (SELECT n.user_id, t.nen AS en, f, p, s FROM n JOIN t USING (user_id, en) WHERE t.nen IS NOT NULL), c AS (SELECT n.* FROM n JOIN t ON t.user_id = n.user_id AND t.nen = n.en)
SELECT user_id, make_timestamp(en) AS ts, f AS BUY_SELL_FLAG, p AS PRICE, 0::BIGINT AS SIZE FROM old WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.user_id = old.user_id AND c.en = old.en AND c.f = old.f AND c.p = old.p)
UNION ALL SELECT user_id, make_timestamp(en), f, p, s FROM c WHERE NOT EXISTS (SELECT 1 FROM old WHERE c.user_id = old.user_id AND c.en = old.en AND c.f = old.f AND c.p = old.p AND c.s = old.s)""")
def _(spark, sf):
    flat = ob.ob_snapshot_flat(_updates(spark, sf), 2, B3)
    return ob.book_diff(flat.using(flat.df, slice_us=30 * DAY), 2).df.select("user_id", "ts", "BUY_SELL_FLAG", "PRICE", "SIZE")


@query("pnl_realized", f"""
WITH {TRADES_SQL}, t AS (SELECT *, event_id % 2 AS f FROM trades),
  c AS (SELECT *, sum(SIZE) OVER (PARTITION BY user_id, f ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS hi FROM t),
  b AS (SELECT *, hi - SIZE AS lo FROM c WHERE f = 0), s AS (SELECT *, hi - SIZE AS lo FROM c WHERE f = 1),
  m AS (SELECT greatest(b.event_id, s.event_id) AS event_id, sum((least(b.hi, s.hi) - greatest(b.lo, s.lo)) * (s.PRICE - b.PRICE)) AS pnl FROM b JOIN s ON b.user_id = s.user_id AND b.lo < s.hi AND s.lo < b.hi GROUP BY 1)
SELECT t.user_id, t.event_id, {R('coalesce(m.pnl, 0)')} AS PNL_REALIZED FROM t LEFT JOIN m USING (event_id)""")
def _(spark, sf):
    t = trades(spark, sf)
    out = tr.pnl_realized(t.using(t.df.withColumn("BUY_SELL_FLAG", F.col("event_id") % 2)), quantity_slice=50)
    return out.df.select("user_id", "event_id", r("PNL_REALIZED").alias("PNL_REALIZED"))


def _options(spark, sf):
    s = events(spark, sf)
    df = s.df.select("user_id", "ts", "event_id", (F.col("value") + 50).alias("PRICE"), F.when(F.col("event_id") % 2 == 0, "CALL").otherwise("PUT").alias("OPTION_TYPE"),
                     (F.col("value") + 48 + F.col("event_id") % 5).alias("STRIKE_PRICE"), (F.col("event_id") % 300 + 30).alias("DAYS_TILL_EXPIRATION"))
    return s.using(df)


@query("option_price")
def _(spark, sf):
    out = tr.option_price(_options(spark, sf), volatility=0.25, interest_rate=0.03, greeks=["DELTA", "VEGA"])
    return out.df.select("user_id", r("VALUE", 6).alias("VALUE"), r("DELTA", 6).alias("DELTA"), r("VEGA", 6).alias("VEGA"))


@query("option_price_tree")
def _(spark, sf):
    out = tr.option_price(_options(spark, sf), volatility=0.25, interest_rate=0.03, model="CRR", steps=64)
    return out.df.select("user_id", r("VALUE", 6).alias("VALUE"))


@query("implied_vol", "SELECT DISTINCT user_id, 0.25::DOUBLE AS VALUE FROM events")
def _(spark, sf):
    s = _options(spark, sf)
    priced = tr.black_scholes(F.col("PRICE"), F.col("STRIKE_PRICE"), F.col("DAYS_TILL_EXPIRATION") / 365.0, F.lit(0.03), F.lit(0.25), F.col("OPTION_TYPE") == "CALL")
    out = tr.implied_vol(s.using(s.df.withColumn("OPTION_PRICE", priced["VALUE"])), interest_rate=0.03)
    return out.df.select("user_id", r("VALUE", 6).alias("VALUE"))


# ---------------------------------------------------------------------------
# Recipes
# ---------------------------------------------------------------------------



def _known(c):
    """A rounded value; -1 where the trade has no quote or the order no fill."""
    return r(F.coalesce(F.col(c), F.lit(-1.0)))


def _buy():
    return F.col("event_id") % 2 == 0


TQ = f"{TRADES_SQL}, {QUOTES_SQL}, j AS (SELECT t.*, q.BID_PRICE AS bid, q.ASK_PRICE AS ask, (q.BID_PRICE + q.ASK_PRICE) / 2 AS mid, CASE WHEN t.event_id % 2 = 0 THEN 1.0 ELSE -1.0 END AS sg FROM trades t ASOF LEFT JOIN quotes q ON t.user_id = q.user_id AND t.ts >= q.ts)"


@query("recipe_arrival_prices", f"WITH {TQ} SELECT user_id, event_id, {R('coalesce(bid, -1)')} AS bid, {R('coalesce(ask, -1)')} AS ask, {R('coalesce(mid, -1)')} AS mid FROM j")
def _(spark, sf):
    df = rc.arrival_prices(trades(spark, sf), quotes(spark, sf)).df
    return df.select("user_id", "event_id", _known("ARRIVAL_BID").alias("bid"), _known("ARRIVAL_ASK").alias("ask"), _known("ARRIVAL_MID").alias("mid"))


@query("recipe_effective_spread", f"""
WITH {TQ} SELECT user_id, event_id, {R('coalesce(2 * sg * (PRICE - mid), -1)')} AS es, {R('coalesce(2 * sg * (PRICE - mid) * SIZE, -1)')} AS ns, {R('coalesce(2 * sg * (PRICE - mid) / (ask - bid), -1)')} AS etq, {R('coalesce(sg * (PRICE - mid) / (ask - bid), -1)')} AS n FROM j""")
def _(spark, sf):
    df = rc.effective_spread(trades(spark, sf), quotes(spark, sf), _buy()).df
    return df.select("user_id", "event_id", _known("EFFECTIVE_SPREAD").alias("es"), _known("NOTIONAL_SPREAD").alias("ns"), _known("ETQ").alias("etq"), _known("NUM_SPREADS").alias("n"))


@query("recipe_touch", f"WITH {TQ} SELECT user_id, event_id, {R('coalesce(CASE WHEN sg > 0 THEN bid ELSE ask END, -1)')} AS near, {R('coalesce(CASE WHEN sg > 0 THEN ask ELSE bid END, -1)')} AS far FROM j")
def _(spark, sf):
    df = rc.touch(trades(spark, sf), quotes(spark, sf), _buy()).df
    return df.select("user_id", "event_id", _known("NEAR_TOUCH").alias("near"), _known("FAR_TOUCH").alias("far"))


@query("recipe_window_quote", f"""
WITH {TRADES_SQL}, {QUOTES_SQL}
SELECT t.user_id, t.event_id, {R('coalesce(min(q.ASK_PRICE), -1)')} AS lo, {R('coalesce(max(q.BID_PRICE), -1)')} AS hi FROM trades t
LEFT JOIN quotes q ON t.user_id = q.user_id AND q.ts >= t.ts - INTERVAL 12 HOUR AND q.ts < t.ts + INTERVAL 12 HOUR GROUP BY 1, 2""")
def _(spark, sf):
    df = rc.window_quote(trades(spark, sf), quotes(spark, sf), 12 * HOUR, 12 * HOUR).df
    return df.select("user_id", "event_id", r(F.coalesce("MIN_ASK", F.lit(-1.0))).alias("lo"), r(F.coalesce("MAX_BID", F.lit(-1.0))).alias("hi"))


@query("recipe_window_touch", f"""
WITH {TRADES_SQL}, {QUOTES_SQL},
w AS (SELECT t.user_id, t.event_id, max(q.ASK_PRICE) AS ask, min(q.BID_PRICE) AS bid FROM trades t
      LEFT JOIN quotes q ON t.user_id = q.user_id AND q.ts >= t.ts - INTERVAL 6 HOUR AND q.ts < t.ts + INTERVAL 18 HOUR GROUP BY 1, 2)
SELECT user_id, event_id, {R('coalesce(CASE WHEN event_id % 2 = 0 THEN bid ELSE ask END, -1)')} AS near, {R('coalesce(CASE WHEN event_id % 2 = 0 THEN ask ELSE bid END, -1)')} AS far
FROM w""")
def _(spark, sf):
    df = rc.window_touch(trades(spark, sf), quotes(spark, sf), _buy(), 6 * HOUR, 18 * HOUR).df
    return df.select("user_id", "event_id", _known("WINDOW_NT").alias("near"), _known("WINDOW_FT").alias("far"))


@query("recipe_price_improvement", f"""
WITH {TQ}, g AS (SELECT *, sg * (CASE WHEN sg > 0 THEN ask ELSE bid END - PRICE) AS gain FROM j)
SELECT user_id, event_id, {R('coalesce(CASE WHEN gain IS NULL THEN -1 ELSE greatest(gain, 0) * SIZE END, -1)')} AS better, {R('coalesce(CASE WHEN gain IS NULL THEN -1 ELSE greatest(-gain, 0) * SIZE END, -1)')} AS offside FROM g""")
def _(spark, sf):
    df = rc.price_improvement(trades(spark, sf), quotes(spark, sf), _buy()).df
    return df.select("user_id", "event_id", _known("IMPROVEMENT").alias("better"), _known("OFFSIDE_VALUE").alias("offside"))


@query("recipe_shortfall", f"""
WITH p AS (SELECT o_orderkey, o_custkey % 2 = 0 AS buy, 400 AS qty, 0.9 * o_totalprice / 100 AS arr, o_totalprice / 100 AS ex FROM orders),
  f AS (SELECT l_orderkey, sum(l_quantity) q, sum(l_extendedprice) v FROM lineitem GROUP BY 1)
SELECT o_orderkey, {R('CASE WHEN buy THEN 1 ELSE -1 END * (coalesce(v, 0) - coalesce(q, 0) * arr)')} AS executed, {R('CASE WHEN buy THEN 1 ELSE -1 END * (qty - coalesce(q, 0)) * (ex - arr)')} AS missed
FROM p LEFT JOIN f ON f.l_orderkey = p.o_orderkey""")
def _(spark, sf):
    price = F.col("o_totalprice") / 100
    parents = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 2 == 0).alias("buy"), F.lit(400).alias("QTY"), (0.9 * F.col("o_totalprice") / 100).alias("ARRIVAL_MID"), price.alias("EXIT_MID"))
    fills = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_quantity").alias("SIZE"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("PRICE"))
    df = rc.implementation_shortfall(parents, fills, ["o_orderkey"], F.col("buy"))
    return df.select("o_orderkey", r("EXECUTION_COST").alias("executed"), r("OPPORTUNITY_COST").alias("missed"))


@query("recipe_markouts", f"""
WITH {TRADES_SQL}, {QUOTES_SQL}, o AS (SELECT * FROM (VALUES (0), (3600000), (21600000)) AS t(off)), p AS (SELECT t.*, o.off, t.ts + INTERVAL 1 MILLISECOND * o.off AS at, CASE WHEN t.event_id % 2 = 0 THEN 1.0 ELSE -1.0 END AS sg FROM trades t, o),
  j AS (SELECT p.*, sg * ((q.BID_PRICE + q.ASK_PRICE) / 2 - PRICE) AS mv FROM p ASOF JOIN quotes q ON p.user_id = q.user_id AND p.at >= q.ts)
SELECT user_id, event_id, off::BIGINT AS "OFFSET", {R('mv')} AS m, CASE WHEN mv > 0 THEN 1 ELSE 0 END::BIGINT AS rw FROM j""")
def _(spark, sf):
    df = rc.markouts(trades(spark, sf), quotes(spark, sf), _buy(), [0, 3_600_000, 21_600_000]).df
    return df.select("user_id", "event_id", "OFFSET", r("MARKOUT").alias("m"), F.col("RIGHT_WAY").alias("rw"))


PWP = f"""{TRADES_SQL}, m AS (SELECT *, sum(SIZE) OVER w AS cv, sum(PRICE * SIZE) OVER w AS cn FROM trades WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
  o AS (SELECT user_id, event_id, ts, 5 AS qty FROM events WHERE event_type = 'signup'),
  b AS (SELECT o.*, coalesce(m.cv, 0) AS v0, coalesce(m.cn, 0) AS n0, coalesce(m.cv, 0) + 10.0 AS v1 FROM o ASOF LEFT JOIN m ON o.user_id = m.user_id AND o.ts > m.ts),
  d AS (SELECT b.*, m.cv, m.cn, m.PRICE FROM b ASOF LEFT JOIN m ON b.user_id = m.user_id AND b.v1 <= m.cv),
  pw AS (SELECT user_id, event_id, (cn - (cv - v1) * PRICE - n0) / (v1 - v0) AS pwp FROM d)"""


def _pwp(spark, sf):
    s = events(spark, sf, "signup")
    o = s.using(s.df.select("user_id", "ts", "event_id", F.lit(5).cast("long").alias("QTY")))
    return rc.participation_price(o, trades(spark, sf), 0.5)


@query("recipe_participation_price", f"WITH {PWP} SELECT user_id, event_id, {R('coalesce(pwp, -1)')} AS pwp FROM pw")
def _(spark, sf):
    return _pwp(spark, sf).select("user_id", "event_id", _known("PWP").alias("pwp"))


@query("recipe_relative_performance", f"""
WITH {PWP}, f AS (SELECT user_id, sum(PRICE * SIZE) / sum(SIZE) AS v FROM trades GROUP BY 1)
SELECT user_id, event_id, {R('coalesce(CASE WHEN event_id % 2 = 0 THEN 1.0 ELSE -1.0 END * (pwp - v) / pwp, -1)')} AS rpm FROM pw LEFT JOIN f USING (user_id)""")
def _(spark, sf):
    df = rc.relative_performance(_pwp(spark, sf), ["user_id"], trades(spark, sf).df, _buy())
    return df.select("user_id", "event_id", _known("RPM").alias("rpm"))


@query("recipe_volatility", f"""
WITH x AS (SELECT user_id, ts, ln(value / lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS ret FROM events)
SELECT user_id, (epoch_us(ts) - {S0}) // {5 * DAY} AS bucket, {R('coalesce(stddev_samp(ret), -1)')} AS v, count(*) AS n FROM x WHERE ret IS NOT NULL GROUP BY 1, 2""")
def _(spark, sf):
    from tickloom.core import micros

    df = rc.volatility(events(spark, sf), "value", 5 * 86400).df
    bucket = F.floor((micros("ts") - S0) / (5 * DAY)) - 1
    return df.select("user_id", bucket.alias("bucket"), r(F.coalesce("VOLATILITY", F.lit(-1.0))).alias("v"), F.col("N").alias("n"))


@query("recipe_takeout", f"""
WITH {TQ}, a AS (SELECT j.*, q.BID_PRICE b2, q.ASK_PRICE a2 FROM j ASOF LEFT JOIN quotes q ON j.user_id = q.user_id AND j.ts + INTERVAL 1 DAY >= q.ts)
SELECT user_id, event_id, CASE WHEN CASE WHEN sg > 0 THEN a2 > ask ELSE b2 < bid END THEN 1 ELSE 0 END::BIGINT AS ok FROM a""")
def _(spark, sf):
    df = rc.takeout_success(trades(spark, sf), quotes(spark, sf), _buy(), DAY).df
    return df.select("user_id", "event_id", F.col("SUCCESS").alias("ok"))
