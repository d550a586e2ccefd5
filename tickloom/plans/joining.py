"""Queries over joins, merges and multi-series operators."""

from __future__ import annotations


from pyspark.sql import functions as F

from tickloom.core import DAY, HOUR, MINUTE, Series, from_micros
from tickloom.operators import aggregate as ag
from tickloom.operators import joins as jn
from tickloom.operators import merging as mg
from tickloom.operators import scripting as sc
from tickloom.operators.buckets import Buckets
from tickloom.plans.recipes import ohlcv
from tickloom.plans.registry import QUOTES_SQL, R, S0, S1, TRADES_SQL, events, lineitems, orders, query, quotes, r, table, trades

VIEWS = "v AS (SELECT user_id, ts, event_id AS vid, value AS vval FROM events WHERE event_type = 'view')"
BUYS = "b AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'purchase')"


def _views(spark, sf):
    s = events(spark, sf, "view")
    return s.using(s.df.select("user_id", "ts", F.col("event_id").alias("vid"), F.col("value").alias("vval")), seq=("vid",))


def _buys(spark, sf):
    s = events(spark, sf, "purchase")
    return s.using(s.df.select("user_id", "ts", "event_id", "value"))


@query("bars_with_quotes", f"""
WITH {TRADES_SQL}, {QUOTES_SQL},
     bars AS (SELECT user_id, make_timestamp({S0} + ((epoch_us(ts) - {S0}) // {6 * HOUR} + 1) * {6 * HOUR}) AS ts, arg_min(PRICE, event_id) AS OPEN, max(PRICE) AS HIGH, min(PRICE) AS LOW,
                     arg_max(PRICE, event_id) AS CLOSE, sum(SIZE)::BIGINT AS VOLUME, {R('sum(PRICE * SIZE) / sum(SIZE)')} AS VWAP
              FROM trades GROUP BY user_id, (epoch_us(ts) - {S0}) // {6 * HOUR})
SELECT bars.*, {R('coalesce(BID_PRICE, -1)')} AS BID, {R('coalesce(ASK_PRICE, -1)')} AS ASK FROM bars ASOF LEFT JOIN quotes ON bars.user_id = quotes.user_id AND bars.ts >= quotes.ts""")
def _(spark, sf):
    bars = ohlcv(trades(spark, sf), 6 * 3600)
    out = jn.asof(bars, quotes(spark, sf), {"BID": "BID_PRICE", "ASK": "ASK_PRICE"})
    return out.df.select(
        "user_id", "ts", "OPEN", "HIGH", "LOW", "CLOSE", "VOLUME", r("VWAP").alias("VWAP"),
        r(F.coalesce("BID", F.lit(-1.0))).alias("BID"), r(F.coalesce("ASK", F.lit(-1.0))).alias("ASK"))


@query("join_equi_inner", """
SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "custkey")
    c = table(spark, sf, "customer").withColumnRenamed("c_custkey", "custkey")
    return jn.join(o, c, ["custkey"]).select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query("join_left_outer_defaults", """
SELECT c_custkey, coalesce(o.n, 0)::BIGINT AS n, coalesce(o.last, '') AS last
FROM customer LEFT JOIN (SELECT o_custkey, count(*) n, max(o_orderpriority) last FROM orders GROUP BY 1) o ON o_custkey = c_custkey""")
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"))
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.count("*").alias("n"), F.max("o_orderpriority").alias("last"))
    return jn.join(c, o, ["custkey"], "left_outer", typed_defaults=True).withColumnRenamed("custkey", "c_custkey")


@query("join_prefix_clash", """
SELECT a.n_nationkey, a.n_name, b.n_name AS RIGHT_n_name FROM nation a JOIN nation b ON a.n_nationkey = b.n_regionkey""")
def _(spark, sf):
    n = table(spark, sf, "nation")
    left = n.select("n_nationkey", "n_name")
    right = n.select(F.col("n_regionkey").alias("n_nationkey"), "n_name")
    return jn.join(left, right, ["n_nationkey"])


@query("join_condition", """
SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_extendedprice, p_retailprice FROM lineitem JOIN part ON l_partkey = p_partkey AND l_extendedprice > 50 * p_retailprice""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return jn.join(li, p, (F.col("l_partkey") == F.col("p_partkey")) & (F.col("l_extendedprice") > 50 * F.col("p_retailprice"))).drop("p_partkey")


@query("join_same_size", """
WITH a AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) n FROM events),
     b AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) n FROM events)
SELECT a.user_id, a.event_id, b.value AS mirrored FROM a JOIN b ON a.user_id = b.user_id AND a.n = b.n""")
def _(spark, sf):
    s = events(spark, sf)
    left = s.using(s.df.select("user_id", "ts", "event_id"))
    back = s.df.select("user_id", from_micros(F.lit(S1) - (s.us - S0)).alias("ts"), (-F.col("event_id")).alias("event_id"), F.col("value").alias("mirrored"))
    return jn.join_same_size(left, s.using(back)).select("user_id", "event_id", "mirrored")


@query("join_by_time_default", f"""
WITH {BUYS}, {VIEWS}
SELECT b.user_id, b.event_id, b.ts, b.value, coalesce(v.vval, -1.0) AS vval FROM b ASOF LEFT JOIN v ON b.user_id = v.user_id AND b.ts > v.ts""")
def _(spark, sf):
    out = jn.join_by_time([_buys(spark, sf), _views(spark, sf)])
    return out.df.select("user_id", "event_id", "ts", "value", F.coalesce("vval", F.lit(-1.0)).alias("vval"))


@query("join_by_time_inner", f"""
WITH {BUYS}, {VIEWS}, c AS (SELECT user_id, ts, value AS cval FROM events WHERE event_type = 'click')
SELECT b.user_id, b.event_id, v.vval, c.cval FROM b ASOF JOIN v ON b.user_id = v.user_id AND b.ts > v.ts ASOF JOIN c ON b.user_id = c.user_id AND b.ts > c.ts""")
def _(spark, sf):
    c = events(spark, sf, "click")
    c = c.using(c.df.select("user_id", "ts", F.col("event_id").alias("cid"), F.col("value").alias("cval")), seq=("cid",))
    out = jn.join_by_time([_buys(spark, sf), _views(spark, sf), c], how="inner")
    return out.df.select("user_id", "event_id", "vval", "cval")


@query("join_by_time_all_leading", f"""
WITH {BUYS}, {VIEWS}, u AS (SELECT user_id, ts, event_id AS o, value, NULL AS vval FROM b UNION ALL SELECT user_id, ts, vid, NULL, vval FROM v)
SELECT user_id, ts, coalesce(last_value(value IGNORE NULLS) OVER w, -1.0) AS value, coalesce(last_value(vval IGNORE NULLS) OVER w, -1.0) AS vval FROM u
WINDOW w AS (PARTITION BY user_id ORDER BY ts, o ROWS UNBOUNDED PRECEDING)""")
def _(spark, sf):
    out = jn.join_by_time([_buys(spark, sf), _views(spark, sf)], leading="all")
    return out.df.select("user_id", "ts", F.coalesce("value", F.lit(-1.0)).alias("value"), F.coalesce("vval", F.lit(-1.0)).alias("vval"))


URGENT = "o_orderpriority = '1-URGENT'"


@query("join_by_time_latest_ticks", f"""
WITH o AS (SELECT o_custkey, o_orderdate, max(o_orderkey) k FROM orders WHERE {URGENT} GROUP BY 1, 2),
     x AS (SELECT o_custkey, o_orderdate, arg_max(o_totalprice, o_orderkey) p FROM orders WHERE NOT {URGENT} GROUP BY 1, 2)
SELECT o.o_custkey, o.o_orderdate, o.k AS o_orderkey, coalesce(x.p, -1.0) AS price FROM o ASOF LEFT JOIN x ON o.o_custkey = x.o_custkey AND o.o_orderdate >= x.o_orderdate""")
def _(spark, sf):
    a, b = _order_pair(spark, sf)
    out = jn.join_by_time([a, b], policy="latest_ticks")
    return out.df.select("o_custkey", "o_orderdate", "o_orderkey", F.coalesce("price", F.lit(-1.0)).alias("price"))


@query("join_by_time_each_for_leader", f"""
WITH o AS (SELECT o_custkey, o_orderdate, o_orderkey FROM orders WHERE {URGENT}),
     f AS (SELECT o_custkey, o_orderdate, arg_min(o_totalprice, o_orderkey) p FROM orders WHERE NOT {URGENT} GROUP BY 1, 2),
     l AS (SELECT o_custkey, o_orderdate, arg_max(o_totalprice, o_orderkey) p FROM orders WHERE NOT {URGENT} GROUP BY 1, 2)
SELECT o.o_custkey, o.o_orderkey, 'first' AS policy, coalesce(f.p, -1.0) AS price FROM o ASOF LEFT JOIN f ON o.o_custkey = f.o_custkey AND o.o_orderdate >= f.o_orderdate
UNION ALL SELECT o.o_custkey, o.o_orderkey, 'latest', coalesce(l.p, -1.0) FROM o ASOF LEFT JOIN l ON o.o_custkey = l.o_custkey AND o.o_orderdate >= l.o_orderdate""")
def _(spark, sf):
    a, b = _order_pair(spark, sf)
    out = None
    for p in ("first", "latest"):
        df = jn.join_by_time([a, b], policy=f"each_for_leader_with_{p}").df
        df = df.select("o_custkey", "o_orderkey", F.lit(p).alias("policy"), F.coalesce("price", F.lit(-1.0)).alias("price"))
        out = df if out is None else out.unionByName(df)
    return out


def _order_pair(spark, sf):
    o = orders(spark, sf)
    a = o.using(o.df.where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey", "o_orderdate", "o_orderkey"))
    b = o.df.where(F.col("o_orderpriority") != "1-URGENT").select("o_custkey", "o_orderdate", F.col("o_orderkey").alias("okey"), F.col("o_totalprice").alias("price"))
    return a, o.using(b, seq=("okey",))


@query("join_identical_times", f"""
WITH o AS (SELECT o_custkey, o_orderdate, max(o_orderkey) k FROM orders WHERE {URGENT} GROUP BY 1, 2),
     x AS (SELECT o_custkey, o_orderdate, arg_max(o_totalprice, o_orderkey) p FROM orders WHERE NOT {URGENT} GROUP BY 1, 2)
SELECT o.o_custkey, o.o_orderdate, o.k AS o_orderkey, x.p AS price FROM o JOIN x ON o.o_custkey = x.o_custkey AND o.o_orderdate = x.o_orderdate""")
def _(spark, sf):
    a, b = _order_pair(spark, sf)
    return jn.join_by_time([a, b], how="inner", match_if_identical_times=True).df.select("o_custkey", "o_orderdate", "o_orderkey", "price")


@query("join_by_time_on_field", f"""
WITH a AS (SELECT l_suppkey AS k, l_partkey AS p, l_shipdate AS ts, count(*) n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2, 3),
     b AS (SELECT l_suppkey AS k, l_partkey AS p, l_shipdate AS ts, sum(l_quantity) q FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2, 3)
SELECT a.k AS l_suppkey, a.p AS l_partkey, a.ts, a.n, coalesce(b.q, -1.0) AS q FROM a ASOF LEFT JOIN b ON a.k = b.k AND a.p = b.p AND a.ts > b.ts""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", F.col("l_shipdate").alias("ts"), "l_returnflag", "l_quantity")
    ids = ["l_suppkey", "l_partkey", "ts"]
    a = li.where("l_returnflag = 'R'").groupBy(*ids).agg(F.count("*").alias("n"))
    b = li.where("l_returnflag <> 'R'").groupBy(*ids).agg(F.sum("l_quantity").alias("q"))
    s = Series(a, seq=(), keys=("l_suppkey",), slice_us=365 * DAY)
    out = jn.join_by_time([s, s.using(b)], on=["l_partkey"])
    return out.df.select(*ids, "n", F.coalesce("q", F.lit(-1.0)).alias("q"))


@query("asof_delayed", f"""
WITH {BUYS}, {VIEWS}
SELECT b.user_id, b.event_id, coalesce(v.vval, -1.0) AS vval FROM b ASOF LEFT JOIN v ON b.user_id = v.user_id AND b.ts - INTERVAL 3 HOUR >= v.ts""")
def _(spark, sf):
    out = jn.asof(_buys(spark, sf), _views(spark, sf), {"vval": "vval"}, delay_us=3 * HOUR)
    return out.df.select("user_id", "event_id", F.coalesce("vval", F.lit(-1.0)).alias("vval"))


@query("aggregated_window_cumulative", f"""
WITH {BUYS}, {VIEWS}
SELECT b.user_id, b.event_id, count(v.vid) AS n, {R('coalesce(sum(v.vval), 0)')} AS s, coalesce(max(v.vval), -1.0) AS hi
FROM b LEFT JOIN v ON b.user_id = v.user_id AND v.ts < b.ts GROUP BY 1, 2""")
def _(spark, sf):
    out = jn.join_with_aggregated_window(_views(spark, sf), _buys(spark, sf), {"n": ag.count(), "s": ag.sum_("vval"), "hi": ag.max_("vval")})
    return out.df.select("user_id", "event_id", "n", r("s").alias("s"), F.coalesce("hi", F.lit(-1.0)).alias("hi"))


@query("aggregated_window_time", f"""
WITH {BUYS}, {VIEWS}
SELECT b.user_id, b.event_id, count(v.vid) AS n, {R('coalesce(avg(v.vval), -1)')} AS m
FROM b LEFT JOIN v ON b.user_id = v.user_id AND v.ts <= b.ts - INTERVAL 1 HOUR AND v.ts > b.ts - INTERVAL 73 HOUR GROUP BY 1, 2""")
def _(spark, sf):
    out = jn.join_with_aggregated_window(_views(spark, sf), _buys(spark, sf), {"n": ag.count(), "m": ag.average("vval")},
                                         boundary="previous", delay_ms=3_600_000, window=72 * 3600)
    return out.df.select("user_id", "event_id", "n", r(F.coalesce("m", F.lit(-1.0))).alias("m"))


@query("aggregated_window_ticks", f"""
WITH {BUYS}, {VIEWS}, w AS (SELECT *, sum(vval) OVER x AS s, min(vval) OVER x AS lo FROM v WINDOW x AS (PARTITION BY user_id ORDER BY ts, vid ROWS 2 PRECEDING))
SELECT b.user_id, b.event_id, {R('coalesce(w.s, 0)')} AS s, coalesce(w.lo, -1.0) AS lo FROM b ASOF LEFT JOIN w ON b.user_id = w.user_id AND b.ts > w.ts""")
def _(spark, sf):
    out = jn.join_with_aggregated_window(_views(spark, sf), _buys(spark, sf), {"s": ag.sum_("vval"), "lo": ag.min_("vval")}, window=3, unit="ticks")
    return out.df.select("user_id", "event_id", r("s").alias("s"), F.coalesce("lo", F.lit(-1.0)).alias("lo"))


@query("join_with_query_window", f"""
WITH {BUYS}, {VIEWS}
SELECT b.user_id, b.event_id, count(v.vid) AS n, {R('coalesce(sum(v.vval), 0)')} AS s
FROM b LEFT JOIN v ON b.user_id = v.user_id AND v.ts >= b.ts - INTERVAL 1 DAY AND v.ts < b.ts + INTERVAL 2 DAY GROUP BY 1, 2""")
def _(spark, sf):
    out = jn.window_join(_buys(spark, sf), _views(spark, sf), {"n": ag.count(), "s": ag.sum_("vval")}, -DAY, 2 * DAY)
    return out.df.select("user_id", "event_id", "n", r("s").alias("s"))


@query("join_with_query_window_extremes", f"""
WITH {BUYS}, {VIEWS}
SELECT b.user_id, b.event_id, coalesce(min(v.vval), -1.0) AS lo, coalesce(arg_max(v.vval, v.vid), -1.0) AS l
FROM b LEFT JOIN v ON b.user_id = v.user_id AND v.ts >= b.ts - INTERVAL 1 DAY AND v.ts < b.ts + INTERVAL 2 DAY GROUP BY 1, 2""")
def _(spark, sf):
    out = jn.window_join(_buys(spark, sf), _views(spark, sf), {"lo": ag.min_("vval"), "l": ag.last("vval")}, -DAY, 2 * DAY)
    return out.df.select("user_id", "event_id", F.coalesce("lo", F.lit(-1.0)).alias("lo"), F.coalesce("l", F.lit(-1.0)).alias("l"))


@query("join_with_query_outer", f"""
WITH {BUYS}, {VIEWS}, h AS (SELECT b.event_id, v.vid, v.vval, v.ts AS vts FROM b JOIN v ON b.user_id = v.user_id AND v.ts >= b.ts - INTERVAL 1 DAY AND v.ts < b.ts
  AND v.vval > b.value * 0.5 WHERE b.event_id % 3 > 0)
SELECT b.user_id, b.event_id, coalesce(h.vid, -1) AS view_vid, coalesce(h.vval, 0.5) AS view_vval, coalesce(h.vts, TIMESTAMP '1970-01-01') AS seen
FROM b LEFT JOIN h USING (event_id)""")
def _(spark, sf):
    """Views of the day before each purchase, of more than half its value, for two purchases of three."""
    b, v = _buys(spark, sf), _views(spark, sf)
    out = jn.join_with_query(
        b, v, -DAY, 0, params={"least": F.col("value") * 0.5}, condition=lambda p, t: t["vval"] > p["least"], where=F.col("event_id") % 3 > 0,
        fields={"vid": lambda p, t: t["vid"], "vval": lambda p, t: t["vval"]}, prefix="view_", keep_time="seen",
        defaults={"vid": F.lit(-1), "vval": F.lit(0.5)})
    return out.df.select("user_id", "event_id", "view_vid", "view_vval", "seen")


@query("join_with_query_inner", f"""
WITH {BUYS}, {VIEWS}
SELECT b.user_id, b.event_id, v.vid, {R('v.vval + b.value')} AS total FROM b JOIN v ON v.user_id = b.user_id + 1 AND v.ts >= b.ts AND v.ts < b.ts + INTERVAL 6 HOUR""")
def _(spark, sf):
    """Views of the next user in the six hours after a purchase."""
    b, v = _buys(spark, sf), _views(spark, sf)
    out = jn.join_with_query(
        b, v, 0, 6 * HOUR, how="inner", symbol={"user_id": F.col("user_id") + 1}, params={"value": F.col("value")},
        fields={"vid": lambda p, t: t["vid"], "total": lambda p, t: t["vval"] + p["value"]})
    return out.df.select("user_id", "event_id", "vid", r("total").alias("total"))


@query("interval_join", """
WITH i AS (SELECT user_id, event_id AS iid, ts AS b, ts + INTERVAL 8 HOUR AS e FROM events WHERE event_type = 'signup')
SELECT x.user_id, x.event_id, i.iid FROM events x JOIN i ON x.user_id = i.user_id AND x.ts >= i.b AND x.ts < i.e WHERE x.event_type <> 'signup'""")
def _(spark, sf):
    s = events(spark, sf)
    sign = s.df.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("iid"), s.us.alias("b"))
    rest = s.using(s.df.where("event_type <> 'signup'"))
    return jn.interval_join(rest, sign, F.col("b"), F.col("b") + 8 * HOUR, bin_us=8 * HOUR, longest_us=8 * HOUR).select("user_id", "event_id", "iid")


@query("interval_join_long", """
WITH i AS (SELECT user_id, event_id AS iid, ts AS b, ts + to_microseconds(CASE event_id % 4 WHEN 0 THEN 60000000 WHEN 1 THEN 36000000000 WHEN 2 THEN 864000000000 ELSE 31536000000000 END) AS e
           FROM events WHERE event_type = 'signup')
SELECT x.user_id, x.event_id, i.iid FROM events x LEFT JOIN i ON x.user_id = i.user_id AND x.ts >= i.b AND x.ts < i.e WHERE x.event_type = 'click'""")
def _(spark, sf):
    """Intervals of a minute, hours, days and a year side by side, on bins of one hour."""
    s = events(spark, sf)
    n = F.col("event_id") % 4
    length = F.when(n == 0, 60_000_000).when(n == 1, 10 * HOUR).when(n == 2, 10 * DAY).otherwise(365 * DAY)
    sign = s.df.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("iid"), s.us.alias("b"), (s.us + length).alias("e"))
    clicks = s.using(s.df.where("event_type = 'click'"))
    return jn.interval_join(clicks, sign, F.col("b"), F.col("e"), "left", bin_us=HOUR, longest_us=365 * DAY).select("user_id", "event_id", "iid")


@query("reference_lookup", """
WITH ref AS (SELECT user_id, ts, event_type AS tag, ts + INTERVAL 3 DAY AS until FROM events WHERE event_type IN ('signup', 'error')),
     x AS (SELECT e.user_id, e.event_id, e.ts, ref.tag, ref.until FROM events e ASOF LEFT JOIN ref ON e.user_id = ref.user_id AND e.ts >= ref.ts WHERE e.event_type = 'click')
SELECT user_id, event_id, CASE WHEN ts < until THEN tag ELSE '' END AS tag FROM x""")
def _(spark, sf):
    s = events(spark, sf)
    ref = s.df.where(F.col("event_type").isin("signup", "error")).select(
        "user_id", "ts", "event_id", F.col("event_type").alias("tag"), F.timestamp_add("DAY", F.lit(3), F.col("ts")).alias("until"))
    out = jn.valid_at(events(spark, sf, "click"), s.using(ref), ["tag"], until="until")
    return out.df.select("user_id", "event_id", F.coalesce("tag", F.lit("")).alias("tag"))


@query("point_in_time", f"""
WITH {BUYS}, {VIEWS}, o AS (SELECT * FROM (VALUES (-7200000), (0), (3600000)) AS t(off)), p AS (SELECT b.*, o.off, b.ts + INTERVAL 1 MILLISECOND * o.off AS at FROM b, o)
SELECT p.user_id, p.event_id, p.off::BIGINT AS "OFFSET", v.vval, v.ts AS "TICK_TIME" FROM p ASOF JOIN v ON p.user_id = v.user_id AND p.at >= v.ts""")
def _(spark, sf):
    out = jn.point_in_time(_buys(spark, sf), _views(spark, sf), [-7_200_000, 0, 3_600_000])
    return out.df.select("user_id", "event_id", "OFFSET", "vval", "TICK_TIME")


@query("point_in_time_ticks", f"""
WITH {BUYS}, {VIEWS}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, vid) rn FROM v),
     a AS (SELECT b.user_id, b.event_id, coalesce(n.rn, 0) rn FROM b ASOF LEFT JOIN n ON b.user_id = n.user_id AND b.ts >= n.ts), o AS (SELECT * FROM (VALUES (-1), (1), (2)) AS t(off))
SELECT a.user_id, a.event_id, o.off::BIGINT AS "OFFSET", n.vval FROM a, o JOIN n ON n.user_id = a.user_id AND n.rn = a.rn + o.off""")
def _(spark, sf):
    out = jn.point_in_time(_buys(spark, sf), _views(spark, sf), [-1, 1, 2], "num_ticks")
    return out.df.select("user_id", "event_id", "OFFSET", "vval")


@query("join_with_collection", """
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT e.user_id, e.event_id, coalesce(c.n, 0)::BIGINT AS n FROM events e LEFT JOIN c ON e.user_id = c.user_id AND e.event_type = c.event_type""")
def _(spark, sf):
    s = events(spark, sf)
    c = s.df.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return jn.join_with_collection(s, c, ["user_id", "event_type"]).select("user_id", "event_id", F.coalesce("n", F.lit(0)).alias("n"))


@query("join_with_snapshot", """
WITH x AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events WHERE event_type = 'view')
SELECT e.user_id, e.event_id, coalesce(x.value, -1.0) AS last_view FROM events e LEFT JOIN x ON x.user_id = e.user_id AND x.rn = 1""")
def _(spark, sf):
    from tickloom.sources.writers import snapshot

    snap = snapshot(events(spark, sf, "view")).select("user_id", F.col("value").alias("last_view"))
    return jn.join_with_snapshot(events(spark, sf).df, snap, ["user_id"]).select("user_id", "event_id", F.coalesce("last_view", F.lit(-1.0)).alias("last_view"))


@query("merge_sources", """
SELECT user_id AS k, ts, 'EVT' AS TICK_TYPE, 0 AS SOURCE_INDEX, value AS v FROM events
UNION ALL SELECT o_custkey, o_orderdate, 'ORD', 1, o_totalprice FROM orders""")
def _(spark, sf):
    a = table(spark, sf, "events").select(F.col("user_id").alias("k"), "ts", F.col("value").alias("v"), F.col("event_id").alias("seq"))
    b = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("v"), F.col("o_orderkey").alias("seq"))
    out = mg.merge([Series(a, keys=("k",)), Series(b, keys=("k",))], identify=["EVT", "ORD"])
    return out.df.select("k", "ts", "TICK_TYPE", "SOURCE_INDEX", "v")


@query("merge_align_schema", """
SELECT l_suppkey AS k, l_quantity AS q, '' AS name, l_linenumber::BIGINT AS n FROM lineitem UNION ALL SELECT s_suppkey, -1.0, s_name, s_nationkey FROM supplier""")
def _(spark, sf):
    a = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_quantity").alias("q"), F.col("l_linenumber").alias("n"), F.col("l_shipdate").alias("ts"))
    b = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("n"), F.expr("TIMESTAMP_NTZ'1995-01-01'").alias("ts"))
    out = mg.merge([Series(a, seq=(), keys=("k",)), Series(b, seq=(), keys=("k",))])
    return out.df.select("k", F.coalesce("q", F.lit(-1.0)).alias("q"), F.coalesce("name", F.lit("")).alias("name"), F.col("n").cast("long").alias("n"))


@query("coalesce_feeds", f"""
WITH a AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'view'), b AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'click'),
     c AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'error')
SELECT 'A' AS SOURCE, user_id, event_id FROM a
UNION ALL SELECT 'B', user_id, event_id FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.user_id = b.user_id AND abs(epoch_us(a.ts) - epoch_us(b.ts)) <= {6 * HOUR})
UNION ALL SELECT 'C', user_id, event_id FROM c WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.user_id = c.user_id AND abs(epoch_us(a.ts) - epoch_us(c.ts)) <= {6 * HOUR})
   AND NOT EXISTS (SELECT 1 FROM b WHERE b.user_id = c.user_id AND abs(epoch_us(b.ts) - epoch_us(c.ts)) <= {6 * HOUR})""")
def _(spark, sf):
    feeds = [events(spark, sf, k) for k in ("view", "click", "error")]
    return mg.coalesce(feeds, 6 * HOUR, ["A", "B", "C"]).df.select("SOURCE", "user_id", "event_id")


DIFF_SQL = """
WITH l AS (SELECT l_suppkey, l_shipdate, l_quantity, l_linenumber, count(*) n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2, 3, 4),
     q AS (SELECT l_suppkey, l_shipdate, l_quantity, l_linenumber, count(*) n FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2, 3, 4),
     j AS (SELECT coalesce(l.l_suppkey, q.l_suppkey) k, coalesce(l.l_shipdate, q.l_shipdate) d, coalesce(l.n, 0) a, coalesce(q.n, 0) b
           FROM l FULL JOIN q ON l.l_suppkey = q.l_suppkey AND l.l_shipdate = q.l_shipdate AND l.l_quantity = q.l_quantity AND l.l_linenumber = q.l_linenumber),
     s AS (SELECT k, d, sum(least(a, b)) m, sum(a - least(a, b)) ua, sum(b - least(a, b)) ub FROM j GROUP BY 1, 2),
     o AS (SELECT k, d, 1 AS st, m AS n FROM s UNION ALL SELECT k, d, 0, least(ua, ub) FROM s UNION ALL SELECT k, d, 2, abs(ua - ub) FROM s)
SELECT k AS l_suppkey, d AS l_shipdate, st::BIGINT AS MATCH_STATUS, n::BIGINT AS n FROM o WHERE n > 0"""


@query("diff_series", DIFF_SQL)
def _(spark, sf):
    li = lineitems(spark, sf)
    cols = ["l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity"]

    def side(flag):
        df = li.df.where(F.col("l_returnflag") == flag).select(*cols)
        return li.using(df.withColumn("line", F.col("l_linenumber")))

    out = mg.diff(side("A"), side("N"), fields=["l_quantity", "line"], show="all")
    return out.groupBy("l_suppkey", "l_shipdate", "MATCH_STATUS").agg(F.count("*").alias("n"))


@query("lee_and_ready", f"""
WITH {TRADES_SQL}, {QUOTES_SQL},
     j AS (SELECT t.*, (q.BID_PRICE + q.ASK_PRICE) / 2 AS mid, lag(t.PRICE) OVER (PARTITION BY t.user_id ORDER BY t.ts, t.event_id) AS prev
           FROM trades t ASOF LEFT JOIN quotes q ON t.user_id = q.user_id AND t.ts - INTERVAL 1 MINUTE >= q.ts),
     c AS (SELECT *, CASE WHEN PRICE > mid THEN 1 WHEN PRICE < mid THEN -1 WHEN PRICE > prev THEN 1 WHEN PRICE < prev THEN -1 END AS own FROM j)
SELECT user_id, event_id, coalesce(last_value(own IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 0)::BIGINT AS "BuySellFlag" FROM c""")
def _(spark, sf):
    return mg.lee_and_ready(trades(spark, sf), quotes(spark, sf), MINUTE).df.select("user_id", "event_id", "BuySellFlag")


@query("estimate_ts_delay", f"""
WITH a AS (SELECT (epoch_us(ts) - {S0}) // {HOUR} c, avg(value) x FROM events WHERE event_type = 'view' GROUP BY 1), b AS (SELECT (epoch_us(ts) - {S0}) // {HOUR} c, avg(value) y FROM events WHERE event_type = 'click' GROUP BY 1),
     g AS (SELECT unnest(range(-12, 13)) AS lag), k AS (SELECT lag, corr(x, y) r FROM a, g, b WHERE b.c = a.c + lag GROUP BY 1)
SELECT lag::BIGINT AS lag, {R('r', 6)} AS correlation FROM k ORDER BY r DESC, abs(lag), lag DESC LIMIT 1""")
def _(spark, sf):
    a, b = events(spark, sf, "view"), events(spark, sf, "click")
    out = mg.estimate_ts_delay(a.using(a.df, keys=()), b.using(b.df, keys=()), "value", "value", HOUR, 12)
    return out.select("lag", r("correlation", 6).alias("correlation"))


@query("corp_actions", f"""
WITH {TRADES_SQL}, f AS (SELECT user_id, ts, 1 / (1 + (event_id % 3)) AS factor FROM events WHERE event_type = 'signup')
SELECT t.user_id, t.event_id, {R('t.PRICE * coalesce(exp(sum(ln(f.factor))), 1)')} AS "PRICE"
FROM trades t LEFT JOIN f ON f.user_id = t.user_id AND f.ts > t.ts AND f.ts <= TIMESTAMP '2024-01-25' GROUP BY t.user_id, t.event_id, t.PRICE""")
def _(spark, sf):
    s = events(spark, sf, "signup")
    f = s.using(s.df.select("user_id", "ts", "event_id", (1.0 / (1 + F.col("event_id") % 3)).alias("FACTOR")))
    out = mg.corp_actions(trades(spark, sf), f, adjustment="2024-01-25")
    return out.df.select("user_id", "event_id", r("PRICE").alias("PRICE"))


@query("nested_subquery", f"""
SELECT user_id, count(*) AS n, {R('sum(value)')} AS s FROM events WHERE event_type = 'view' AND value > 5 GROUP BY user_id""")
def _(spark, sf):
    def large(s, limit):
        return s.using(s.df.where(F.col("value") > limit))

    s = events(spark, sf, "view").pipe(large, 5)
    out = ag.agg(s, {"n": ag.count(), "s": ag.sum_("value")})
    return out.df.select("user_id", "n", r("s").alias("s"))


@query("eval_scalar", f"SELECT event_id, {R('value / (SELECT max(value) FROM events)', 6)} AS share FROM events")
def _(spark, sf):
    df = table(spark, sf, "events")
    return df.select("event_id", r(F.col("value") / sc.eval_scalar(df.agg(F.max("value"))), 6).alias("share"))


@query("eval_symbols", "SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events WHERE value > 100)")
def _(spark, sf):
    s = events(spark, sf)
    return sc.eval_symbols(s, s.df.where("value > 100")).df.select("event_id", "user_id")


@query("symbol_params", f"SELECT e.event_id, coalesce(c.c_mktsegment, 'none') AS c_mktsegment, {R('e.value * coalesce(c.c_acctbal, 0)', 2)} AS weighted FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id")
def _(spark, sf):
    params = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_acctbal")
    out = sc.with_symbol_params(events(spark, sf), params).df
    balance = F.coalesce("c_acctbal", F.lit(0.0))
    return out.select("event_id", F.coalesce("c_mktsegment", F.lit("none")).alias("c_mktsegment"), r(F.col("value") * balance, 2).alias("weighted"))


@query("sql_text", "SELECT user_id, event_type, count(*) AS n, max(value) AS hi FROM events GROUP BY user_id, event_type")
def _(spark, sf):
    return sc.sql(spark, "SELECT user_id, event_type, count(*) AS n, max(value) AS hi FROM {ticks} GROUP BY user_id, event_type", ticks=events(spark, sf))


@query("process_by_group", """
SELECT user_id, event_type, event_id, value - lag(value, 1, value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS step FROM events""")
def _(spark, sf):
    from tickloom.operators.project import lag

    def steps(s):
        out = lag(s, {"p": ("value", 1)})
        return s.using(out.df.withColumn("step", F.col("value") - F.coalesce("p", F.col("value"))))

    return sc.process_by_group(events(spark, sf), steps, ["event_type"]).df.select("user_id", "event_type", "event_id", "step")


@query("generic_per_bucket", f"""
WITH x AS (SELECT *, (epoch_us(ts) - {S0}) // {DAY} AS b FROM events),
     y AS (SELECT *, row_number() OVER (PARTITION BY user_id, b ORDER BY value DESC, ts, event_id) rn FROM x)
SELECT user_id, make_timestamp({S0} + (b + 1) * {DAY}) AS ts, value FROM y WHERE rn = 1""")
def _(spark, sf):
    from tickloom.operators.ticks import high_tick

    return sc.generic(events(spark, sf), lambda s: high_tick(s, "value"), Buckets(1, "days")).select("user_id", "ts", "value")


@query("script_rows", """
SELECT event_id, value, 0 AS copy FROM events WHERE event_type <> 'error' UNION ALL SELECT event_id, value * 2, 1 FROM events WHERE event_type = 'purchase'""")
def _(spark, sf):
    def fn(row):
        if row["event_type"] == "error":
            return False
        rows = [{"event_id": row["event_id"], "value": row["value"], "copy": 0}]
        if row["event_type"] == "purchase":
            rows.append({"event_id": row["event_id"], "value": row["value"] * 2, "copy": 1})
        return rows

    return sc.script(table(spark, sf, "events").select("event_id", "event_type", "value"), fn, "event_id long, value double, copy int")


@query("state_running_max", """
SELECT user_id, event_id, coalesce(max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS before FROM events""")
def _(spark, sf):
    out = sc.state_var(events(spark, sf), "before", "max", F.col("value"), exclusive=True)
    return out.df.select("user_id", "event_id", F.coalesce("before", F.lit(0.0)).alias("before"))


@query("state_from_query", """
WITH a AS (SELECT e.event_id, (SELECT max(v.value) FROM events v WHERE v.event_type = 'view' AND v.user_id = e.user_id AND v.ts >= e.ts - INTERVAL 5 DAY AND v.ts < e.ts) AS f FROM events e WHERE event_type = 'purchase'),
     x AS (SELECT e.user_id, e.event_id, a.f, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, e.event_id ROWS UNBOUNDED PRECEDING) AS g FROM events e LEFT JOIN a USING (event_id))
SELECT event_id, CASE WHEN g = 0 THEN 0.0 ELSE max(f) OVER (PARTITION BY user_id, g) END AS best FROM x""")
def _(spark, sf):
    s, views = events(spark, sf), events(spark, sf, "view")
    out = sc.state_from_query(s, "best", views, ag.max_("value"), -5 * DAY, 0, where=F.col("event_type") == "purchase", initial=F.lit(0.0))
    return out.df.select("event_id", "best")


@query("state_deque", f"""
WITH x AS (SELECT user_id, event_id, sum(value) OVER w AS s, count(*) OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 3 PRECEDING))
SELECT user_id, event_id, {R('s')} AS s, n FROM x""")
def _(spark, sf):
    out = sc.last_n(events(spark, sf), "deque", "value", 4)
    total = F.aggregate("deque", F.lit(0.0), lambda a, x: a + x)
    return out.df.select("user_id", "event_id", r(total).alias("s"), F.size("deque").cast("long").alias("n"))


@query("state_set_oldest", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def _(spark, sf):
    return sc.oldest_by(events(spark, sf), ["event_type"]).df.select("user_id", "event_type", "event_id")


@query("state_set_present", """
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) > 1 AS seen FROM events""")
def _(spark, sf):
    return sc.present_before(events(spark, sf), "seen", ["event_type"]).df.select("user_id", "event_id", "seen")


@query("state_set_find_latest", f"""
WITH {BUYS}, {VIEWS}
SELECT b.user_id, b.event_id, coalesce(v.vid, -1)::BIGINT AS vid FROM b ASOF LEFT JOIN v ON b.user_id = v.user_id AND b.ts >= v.ts""")
def _(spark, sf):
    out = sc.find_latest(_buys(spark, sf), _views(spark, sf), {"found": "vid"})
    return out.df.select("user_id", "event_id", F.coalesce("found", F.lit(-1)).alias("vid"))
