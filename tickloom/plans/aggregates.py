"""Queries over bucketed, running, sliding and whole-tick aggregations."""

from __future__ import annotations


from pyspark.sql import functions as F

from tickloom.core import DAY, HOUR
from tickloom.operators import aggregate as ag
from tickloom.operators import statistics as st
from tickloom.operators import ticks as tk
from tickloom.operators.buckets import BUCKET, Buckets
from tickloom.plans.registry import L0, R, S0, S1, TRADES_SQL, events, lineitems, query, r, table, trades

H6 = 6 * HOUR
B6 = f"(epoch_us(ts) - {S0}) // {H6}"


@query("agg_hourly_buckets", f"""
WITH a AS (SELECT user_id, {B6} AS b, count(*) n, sum(value) s, avg(value) m, min(value) lo, max(value) hi,
                  min(ts) ft, max(ts) lt, arg_min(value, event_id) f, arg_max(value, event_id) l FROM events GROUP BY 1, 2)
SELECT user_id, make_timestamp({S0} + (b + 1) * {H6}) AS ts, n, {R('s')} AS s, {R('m')} AS m, lo, hi, ft, lt, f, l FROM a""")
def _(spark, sf):
    out = ag.agg(events(spark, sf), {
        "n": ag.count(), "s": ag.sum_("value"), "m": ag.average("value"), "lo": ag.min_("value"), "hi": ag.max_("value"),
        "ft": ag.first_time(), "lt": ag.last_time(), "f": ag.first("value"), "l": ag.last("value")},
        Buckets(6 * 3600), fill_empty=False)
    return out.df.withColumns({"s": r("s"), "m": r("m")})


@query("agg_empty_buckets", f"""
WITH k AS (SELECT DISTINCT user_id FROM events), d AS (SELECT unnest(range(0, 30)) AS b),
     a AS (SELECT user_id, (epoch_us(ts) - {S0}) // {DAY} AS b, count(*) n, sum(value) s FROM events WHERE event_type = 'view' GROUP BY 1, 2),
     k2 AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'view')
SELECT k2.user_id, make_timestamp({S0} + d.b * {DAY}) AS ts, coalesce(n, 0)::BIGINT AS n, {R('coalesce(s, 0)')} AS s
FROM k2 CROSS JOIN d LEFT JOIN a ON a.user_id = k2.user_id AND a.b = d.b""")
def _(spark, sf):
    out = ag.agg(events(spark, sf, "view"), {"n": ag.count(), "s": ag.sum_("value")}, Buckets(1, "days", stamp="start"))
    return out.df.withColumn("s", r("s"))


@query("agg_month_buckets", f"""
SELECT l_suppkey, date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS l_shipdate, count(*) AS n, {R('sum(l_quantity)')} AS q
FROM lineitem GROUP BY 1, 2""")
def _(spark, sf):
    out = ag.agg(lineitems(spark, sf), {"n": ag.count(), "q": ag.sum_("l_quantity")}, Buckets(1, "months"), fill_empty=False)
    return out.df.withColumn("q", r("q"))


@query("agg_tick_buckets", f"""
WITH x AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 10 AS b FROM events)
SELECT user_id, CASE WHEN count(*) < 10 THEN TIMESTAMP '2024-01-31' ELSE max(ts) END AS ts, count(*) AS n, {R('sum(value)')} AS s
FROM x GROUP BY user_id, b""")
def _(spark, sf):
    out = ag.agg(events(spark, sf), {"n": ag.count(), "s": ag.sum_("value")}, Buckets(10, "ticks"))
    return out.df.withColumn("s", r("s"))


@query("agg_flexible_buckets", f"""
WITH x AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS b FROM events),
     g AS (SELECT user_id, b, count(*) n, sum(value) s, min(ts) ft FROM x GROUP BY 1, 2)
SELECT user_id, coalesce(lead(ft) OVER (PARTITION BY user_id ORDER BY b), TIMESTAMP '2024-01-31') AS ts, n, {R('s')} AS s FROM g""")
def _(spark, sf):
    out = ag.agg(events(spark, sf), {"n": ag.count(), "s": ag.sum_("value")},
                 Buckets(unit="flexible", condition=F.col("event_type") == "signup"))
    return out.df.withColumn("s", r("s"))


@query("agg_session_buckets", f"""
WITH x AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) p FROM events),
     y AS (SELECT *, sum(CASE WHEN epoch_us(ts) - epoch_us(p) > {12 * HOUR} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) b FROM x)
SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n FROM y GROUP BY user_id, b""")
def _(spark, sf):
    from tickloom.operators.project import lag

    s = lag(events(spark, sf), {"p": ("ts", 1)})
    gap = F.timestamp_diff("MICROSECOND", F.col("p"), F.col("ts")) > 12 * HOUR
    out = ag.agg(s, {"first_ts": ag.first_time(), "last_ts": ag.last_time(), "n": ag.count()}, Buckets(unit="flexible", condition=gap))
    return out.df.select("user_id", "first_ts", "last_ts", "n")


@query("agg_group_by", f"""
SELECT event_type, value > 10 AS GROUP_1, make_timestamp({S0} + ((epoch_us(ts) - {S0}) // {DAY} + 1) * {DAY}) AS ts, count(*) AS n, max(value) AS hi
FROM events GROUP BY 1, 2, 3""")
def _(spark, sf):
    s = events(spark, sf)
    out = ag.agg(s.using(s.df, keys=()), {"n": ag.count(), "hi": ag.max_("value")}, Buckets(1, "days"),
                 group_by=["event_type", F.col("value") > 10], groups_to_display="event_in_last_bucket")
    return out.df.select("event_type", "GROUP_1", "ts", "n", "hi")


@query("agg_groups_display_all", f"""
WITH x AS (SELECT *, (epoch_us(ts) - {S0}) // {H6} AS b FROM events),
     g AS (SELECT event_type, user_id, min(b) since FROM x GROUP BY 1, 2), d AS (SELECT unnest(range(0, 120)) AS b),
     a AS (SELECT user_id, event_type, b, count(*) n FROM x GROUP BY 1, 2, 3)
SELECT g.user_id, g.event_type, make_timestamp({S0} + (d.b + 1) * {H6}) AS ts, coalesce(a.n, 0)::BIGINT AS n
FROM g JOIN d ON d.b >= g.since LEFT JOIN a ON a.user_id = g.user_id AND a.event_type = g.event_type AND a.b = d.b""")
def _(spark, sf):
    s = events(spark, sf)
    return ag.agg(s, {"n": ag.count()}, Buckets(6 * 3600), group_by=["event_type"]).df.select("user_id", "event_type", "ts", "n")


@query("agg_all_fields_high", f"""
SELECT user_id, make_timestamp({S0} + ((epoch_us(ts) - {S0}) // {DAY} + 1) * {DAY}) AS ts,
       arg_max(event_id, (value, -epoch_us(ts))) AS event_id, max(value) AS hi, count(*) AS n
FROM events GROUP BY user_id, (epoch_us(ts) - {S0}) // {DAY}""")
def _(spark, sf):
    out = ag.agg(events(spark, sf), {"hi": ag.max_("value"), "n": ag.count()}, Buckets(1, "days"), all_fields="high:value", fill_empty=False)
    return out.df.select("user_id", "ts", "event_id", "hi", "n")


@query("agg_state_series", f"""
WITH k AS (SELECT DISTINCT user_id FROM events), d AS (SELECT unnest(range(0, 30)) AS b),
     a AS (SELECT user_id, (epoch_us(ts) - {S0}) // {DAY} AS b, max(value) hi, arg_max(value, event_id) l FROM events GROUP BY 1, 2),
     j AS (SELECT k.user_id, d.b, a.hi, a.l FROM k CROSS JOIN d LEFT JOIN a ON a.user_id = k.user_id AND a.b = d.b),
     p AS (SELECT *, last_value(l IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) prev FROM j)
SELECT user_id, make_timestamp({S0} + (b + 1) * {DAY}) AS ts, coalesce(greatest(hi, prev), -1.0) AS hi FROM p""")
def _(spark, sf):
    out = ag.agg(events(spark, sf), {"hi": ag.max_("value")}, Buckets(1, "days"), time_series_type="state_ts")
    return out.df.select("user_id", "ts", F.coalesce("hi", F.lit(-1.0)).alias("hi"))


@query("agg_moments", f"""
WITH m AS (SELECT event_type, (epoch_us(ts) - {S0}) // {DAY} b, avg(value) a, stddev_pop(value) sd FROM events GROUP BY 1, 2),
     x AS (SELECT e.event_type, m.b, e.value, m.a, m.sd FROM events e JOIN m ON m.event_type = e.event_type AND m.b = (epoch_us(e.ts) - {S0}) // {DAY})
SELECT event_type, make_timestamp({S0} + (b + 1) * {DAY}) AS ts, {R('var_pop(value)')} AS vp, {R('var_samp(value)')} AS vs, {R('stddev_pop(value)')} AS sp,
       {R('avg(pow((value - a) / sd, 3))')} AS m3, {R('avg(pow((value - a) / sd, 4))')} AS m4, {R('avg(pow((value - a) / sd, 5))', 2)} AS m5
FROM x GROUP BY event_type, b""")
def _(spark, sf):
    s = events(spark, sf)
    out = ag.agg(s.using(s.df, keys=("event_type",)), {
        "vp": ag.variance("value"), "vs": ag.variance("value", False), "sp": ag.stddev("value"), "m3": ag.standardized_moment("value", 3),
        "m4": ag.standardized_moment("value", 4), "m5": ag.standardized_moment("value", 5)}, Buckets(1, "days"), fill_empty=False)
    return out.df.select("event_type", "ts", *[r(c).alias(c) for c in ("vp", "vs", "sp", "m3", "m4")], r("m5", 2).alias("m5"))


@query("agg_correlation_regression", f"""
SELECT l_suppkey, {R('corr(l_quantity, l_extendedprice)', 6)} AS c, {R('regr_slope(l_extendedprice, l_quantity)')} AS slope,
       {R('regr_intercept(l_extendedprice, l_quantity)', 3)} AS intercept FROM lineitem GROUP BY l_suppkey""")
def _(spark, sf):
    out = ag.agg(lineitems(spark, sf), {
        "c": ag.correlation("l_quantity", "l_extendedprice"), "slope": ag.slope("l_extendedprice", "l_quantity"),
        "intercept": ag.intercept("l_extendedprice", "l_quantity")})
    return out.df.select("l_suppkey", r("c", 6).alias("c"), r("slope").alias("slope"), r("intercept", 3).alias("intercept"))


@query("agg_vwap", f"SELECT l_suppkey, {R('sum(l_extendedprice * l_quantity) / sum(l_quantity)')} AS vwap, count(*) AS n FROM lineitem GROUP BY l_suppkey")
def _(spark, sf):
    out = ag.agg(lineitems(spark, sf), {"vwap": ag.vwap("l_extendedprice", "l_quantity"), "n": ag.count()})
    return out.df.select("l_suppkey", r("vwap").alias("vwap"), "n")


@query("agg_high_low_time", f"""
SELECT user_id, arg_max(ts, (value, -epoch_us(ts))) AS ht, arg_max(ts, (value, epoch_us(ts))) AS ht_last, arg_min(ts, (value, epoch_us(ts))) AS lt
FROM events GROUP BY user_id""")
def _(spark, sf):
    out = ag.agg(events(spark, sf), {"ht": ag.high_time("value"), "ht_last": ag.high_time("value", "last"), "lt": ag.low_time("value")})
    return out.df.select("user_id", "ht", "ht_last", "lt")


@query("agg_large_integers", """
SELECT user_id, max(9007199254740993 + event_id)::BIGINT AS hi, sum(CAST(value AS DECIMAL(18, 2)))::DECIMAL(38, 2)::VARCHAR AS total FROM events GROUP BY user_id""")
def _(spark, sf):
    s = events(spark, sf)
    df = s.df.withColumns({"big": F.col("event_id") + 9007199254740993, "money": F.col("value").cast("decimal(18,2)")})
    out = ag.agg(s.using(df), {"hi": ag.max_("big"), "total": ag.sum_("money")})
    return out.df.select("user_id", "hi", F.col("total").cast("string").alias("total"))


@query("first_last_ticks", """
WITH x AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id, (epoch_us(ts) - 1704067200000000) // 86400000000 ORDER BY ts, event_id) a,
                  row_number() OVER (PARTITION BY user_id, (epoch_us(ts) - 1704067200000000) // 86400000000 ORDER BY ts DESC, event_id DESC) z FROM events)
SELECT 'first' AS pick, user_id, event_id, value FROM x WHERE a <= 2 UNION ALL SELECT 'last', user_id, event_id, value FROM x WHERE z <= 1""")
def _(spark, sf):
    s, b = events(spark, sf), Buckets(1, "days")
    cols = ["user_id", "event_id", "value"]
    a = tk.first_tick(s, 2, b).df.select(F.lit("first").alias("pick"), *cols)
    return a.unionByName(tk.last_tick(s, 1, b).df.select(F.lit("last").alias("pick"), *cols))


@query("first_tick_default", f"""
WITH k AS (SELECT DISTINCT user_id FROM events), d AS (SELECT unnest(range(0, 30)) AS b),
     a AS (SELECT user_id, (epoch_us(ts) - {S0}) // {DAY} AS b, arg_min(value, event_id) v FROM events GROUP BY 1, 2)
SELECT k.user_id, make_timestamp({S0} + (d.b + 1) * {DAY}) AS ts, coalesce(a.v, -1.0) AS value
FROM k CROSS JOIN d LEFT JOIN a ON a.user_id = k.user_id AND a.b = d.b""")
def _(spark, sf):
    out = tk.first_tick(events(spark, sf), 1, Buckets(1, "days"), keep_timestamp=False, default={"value": F.lit(-1.0)})
    return out.df.select("user_id", "ts", "value")


@query("high_low_ticks", """
WITH x AS (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, ts, event_id) a,
                  row_number() OVER (PARTITION BY event_type ORDER BY value, ts, event_id) z FROM events)
SELECT 'high' AS pick, event_type, event_id, value FROM x WHERE a <= 5 UNION ALL SELECT 'low', event_type, event_id, value FROM x WHERE z <= 5""")
def _(spark, sf):
    s = events(spark, sf)
    s = s.using(s.df, keys=("event_type",))
    cols = ["event_type", "event_id", "value"]
    a = tk.high_tick(s, "value", 5).df.select(F.lit("high").alias("pick"), *cols)
    return a.unionByName(tk.low_tick(s, "value", 5).df.select(F.lit("low").alias("pick"), *cols))


@query("distinct_ticks", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def _(spark, sf):
    return tk.distinct(events(spark, sf), ["event_type"], key_attrs_only=False).select("user_id", "event_type", "event_id")


@query("distinct_keys", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def _(spark, sf):
    return tk.distinct(lineitems(spark, sf), ["l_returnflag", "l_linestatus"]).select("l_suppkey", "l_returnflag", "l_linestatus")


@query("num_distinct", f"SELECT l_suppkey, (epoch_us(l_shipdate) - {L0}) // {30 * DAY} AS bucket, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1, 2")
def _(spark, sf):
    out = tk.num_distinct(lineitems(spark, sf), ["l_partkey"], Buckets(30 * 86400), "n")
    return out.select("l_suppkey", F.col(BUCKET).alias("bucket"), "n")


@query("running_num_distinct", """
WITH x AS (SELECT user_id, event_id, ts, CASE WHEN row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1 THEN 1 ELSE 0 END f FROM events)
SELECT user_id, event_id, (sum(f) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS n FROM x""")
def _(spark, sf):
    return tk.running_num_distinct(events(spark, sf), ["event_type"], "n").df.select("user_id", "event_id", "n")


@query("running_cumulative", f"""
SELECT user_id, event_id, count(*) OVER w AS n, {R('sum(value) OVER w')} AS s, {R('avg(value) OVER w')} AS m, min(value) OVER w AS lo, max(value) OVER w AS hi,
       {R('coalesce(stddev_pop(value) OVER w, 0)', 3)} AS sd, first_value(value) OVER w AS f
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def _(spark, sf):
    out = ag.running_agg(events(spark, sf), {
        "n": ag.count(), "s": ag.sum_("value"), "m": ag.average("value"), "lo": ag.min_("value"), "hi": ag.max_("value"),
        "sd": ag.stddev("value"), "f": ag.first("value")})
    return out.df.select("user_id", "event_id", "n", r("s").alias("s"), r("m").alias("m"), "lo", "hi", r("sd", 3).alias("sd"), "f")


W = 36 * HOUR
FRAME = f"(PARTITION BY user_id ORDER BY us RANGE BETWEEN {W - 1} PRECEDING AND CURRENT ROW)"


@query("sliding_arrival", f"""
WITH x AS (SELECT *, epoch_us(ts) AS us FROM events)
SELECT user_id, event_id, count(*) OVER w AS n, {R('sum(value) OVER w')} AS s, {R('avg(value) OVER w')} AS m FROM x WINDOW w AS {FRAME}""")
def _(spark, sf):
    out = ag.running_agg(events(spark, sf), {"n": ag.count(), "s": ag.sum_("value"), "m": ag.average("value")}, W, emit="arrival")
    return out.df.select("user_id", "event_id", "n", r("s").alias("s"), r("m").alias("m"))


@query("sliding_min_max", f"""
WITH x AS (SELECT *, epoch_us(ts) AS us FROM events)
SELECT user_id, event_id, min(value) OVER w AS lo, max(value) OVER w AS hi, first_value(value) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN {W - 1} PRECEDING AND CURRENT ROW) AS f
FROM x WINDOW w AS {FRAME}""")
def _(spark, sf):
    out = ag.running_agg(events(spark, sf), {"lo": ag.min_("value"), "hi": ag.max_("value"), "f": ag.first("value")}, W, emit="arrival")
    return out.df.select("user_id", "event_id", "lo", "hi", "f")


@query("sliding_arrival_and_exit", f"""
WITH x AS (SELECT user_id, epoch_us(ts) AS us, value FROM events),
     p AS (SELECT user_id, us FROM x UNION SELECT user_id, us + {W} FROM x WHERE us + {W} < {S1})
SELECT p.user_id, make_timestamp(p.us) AS ts, count(x.us) AS n, {R('coalesce(sum(x.value), 0)')} AS s
FROM p LEFT JOIN x ON x.user_id = p.user_id AND x.us > p.us - {W} AND x.us <= p.us GROUP BY p.user_id, p.us""")
def _(spark, sf):
    out = ag.running_agg(events(spark, sf), {"n": ag.count(), "s": ag.sum_("value")}, W, emit="both")
    return out.df.select("user_id", "ts", "n", r("s").alias("s"))


@query("sliding_exit", f"""
WITH x AS (SELECT user_id, event_id, epoch_us(ts) AS us, value FROM events)
SELECT user_id, event_id, {R('s')} AS s, n FROM (
  SELECT user_id, event_id, us, sum(value) OVER w AS s, count(*) OVER w AS n FROM x
  WINDOW w AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN CURRENT ROW AND {W - 1} FOLLOWING)) WHERE us + {W} < {S1}""")
def _(spark, sf):
    out = ag.running_agg(events(spark, sf), {"n": ag.count(), "s": ag.sum_("value")}, W, emit="exit")
    return out.df.select("user_id", "event_id", r("s").alias("s"), "n")


@query("sliding_vwap_by_group", f"""
WITH x AS (SELECT *, epoch_us(ts) AS us FROM events)
SELECT user_id, event_type, event_id, {R('sum(value * (event_id % 5 + 1)) OVER w / sum(event_id % 5 + 1) OVER w')} AS v FROM x
WINDOW w AS (PARTITION BY user_id, event_type ORDER BY us RANGE BETWEEN {5 * DAY - 1} PRECEDING AND CURRENT ROW)""")
def _(spark, sf):
    s = events(spark, sf)
    s = s.using(s.df.withColumn("q", F.col("event_id") % 5 + 1))
    out = ag.running_agg(s, {"v": ag.vwap("value", "q")}, 5 * DAY, group_by=["event_type"], emit="arrival")
    return out.df.select("user_id", "event_type", "event_id", r("v").alias("v"))


#: Values with infinities, sixteen digits beside units, and a common offset of 1e8.
ROUGH = "CASE WHEN event_id % 101 = 0 THEN 'Infinity'::DOUBLE WHEN event_id % 7 = 0 THEN 1e16 ELSE event_id % 10 END"
OFFSET = "100000000 + event_id % 11"


def _rough(s: Series) -> Series:
    n = F.col("event_id")
    rough = F.when(n % 101 == 0, F.lit(float("inf"))).when(n % 7 == 0, F.lit(1e16)).otherwise((n % 10).cast("double"))
    return s.using(s.df.withColumns({"x": rough, "y": (n % 11 + 100_000_000).cast("double"), "z": (n % 13).cast("double")}))


@query("sliding_recovers", f"""
WITH x AS (SELECT user_id, event_id, epoch_us(ts) AS us, {ROUGH} AS x FROM events)
SELECT a.user_id, a.event_id, CASE WHEN max(b.x) >= 1e16 THEN -1 ELSE {R('sum(b.x)')} END AS s, count(*) AS n FROM x a JOIN x b
ON a.user_id = b.user_id AND b.us <= a.us AND b.us > a.us - {W} GROUP BY ALL""")
def _(spark, sf):
    """Sums after an infinity or a very large value has left the window."""
    out = ag.running_agg(_rough(events(spark, sf)), {"s": ag.sum_("x"), "n": ag.count()}, W, emit="arrival")
    return out.df.select("user_id", "event_id", F.when(F.col("s") >= 1e16, -1.0).otherwise(r("s")).alias("s"), "n")


MOMENTS_SQL = f"""CASE WHEN count(*) OVER w > 0 THEN {R('stddev_pop(event_id % 11) OVER w', 3)} END AS sd, {R('coalesce(var_samp(event_id % 11) OVER w, 0)', 2)} AS v,
  {R('CASE WHEN isfinite(corr(event_id % 11, event_id % 13) OVER w) THEN corr(event_id % 11, event_id % 13) OVER w ELSE 0 END', 3)} AS c,
  {R('CASE WHEN isfinite(regr_slope(event_id % 13, event_id % 11) OVER w) THEN regr_slope(event_id % 13, event_id % 11) OVER w ELSE 0 END', 3)} AS b"""


def _moments(out):
    return out.df.select(
        "user_id", "event_id", r("sd", 3).alias("sd"), r(F.coalesce("v", F.lit(0.0)), 2).alias("v"),
        r(F.coalesce(F.when(~F.isnan("c"), F.col("c")), F.lit(0.0)), 3).alias("c"), r(F.coalesce("b", F.lit(0.0)), 3).alias("b"))


def _moment_aggs():
    return {"sd": ag.stddev("y"), "v": ag.variance("y", biased=False), "c": ag.correlation("y", "z"), "b": ag.slope("z", "y")}


@query("running_moments", f"SELECT user_id, event_id, {MOMENTS_SQL} FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)")
def _(spark, sf):
    """Spread, correlation and slope of values with a common offset of 1e8, to the digits they have without it."""
    return _moments(ag.running_agg(_rough(events(spark, sf)), _moment_aggs()))


@query("sliding_moments", f"WITH x AS (SELECT *, epoch_us(ts) AS us FROM events) SELECT user_id, event_id, {MOMENTS_SQL} FROM x WINDOW w AS {FRAME}")
def _(spark, sf):
    return _moments(ag.running_agg(_rough(events(spark, sf)), _moment_aggs(), W, emit="arrival"))


@query("sliding_ticks", f"""
SELECT user_id, event_id, count(*) OVER w AS n, {R('sum(value) OVER w')} AS s, {R('avg(value) OVER w')} AS m, min(value) OVER w AS lo, max(value) OVER w AS hi,
  first_value(event_type) OVER w AS f, {R('stddev_pop(value) OVER w', 3)} AS sd
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 19 PRECEDING)""")
def _(spark, sf):
    out = ag.running_agg(events(spark, sf), {
        "n": ag.count(), "s": ag.sum_("value"), "m": ag.average("value"), "lo": ag.min_("value"), "hi": ag.max_("value"), "f": ag.first("event_type"),
        "sd": ag.stddev("value")}, ticks=20)
    return out.df.select("user_id", "event_id", "n", r("s").alias("s"), r("m").alias("m"), "lo", "hi", "f", r("sd", 3).alias("sd"))


@query("sliding_ticks_by_group", f"""
SELECT user_id, event_type, event_id, {R('sum(value * (event_id % 5 + 1)) OVER w / sum(event_id % 5 + 1) OVER w')} AS v
FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS 4 PRECEDING)""")
def _(spark, sf):
    s = events(spark, sf)
    s = s.using(s.df.withColumn("q", F.col("event_id") % 5 + 1))
    out = ag.running_agg(s, {"v": ag.vwap("value", "q")}, ticks=5, group_by=["event_type"])
    return out.df.select("user_id", "event_type", "event_id", r("v").alias("v"))


@query("sliding_num_distinct", f"""
WITH x AS (SELECT user_id, event_id, epoch_us(ts) AS us, event_type, event_id % 9 AS q FROM events)
SELECT a.user_id, a.event_id, count(DISTINCT (b.event_type, b.q)) AS n FROM x a JOIN x b
ON a.user_id = b.user_id AND b.us <= a.us AND b.us > a.us - {W} GROUP BY ALL""")
def _(spark, sf):
    s = events(spark, sf)
    s = s.using(s.df.withColumn("q", F.col("event_id") % 9))
    return tk.sliding_num_distinct(s, ["event_type", "q"], W, name="n").df.select("user_id", "event_id", "n")


@query("sliding_num_distinct_ticks", """
WITH x AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events)
SELECT a.user_id, a.event_id, count(DISTINCT b.event_type) AS n FROM x a JOIN x b ON a.user_id = b.user_id AND b.i BETWEEN a.i - 5 AND a.i GROUP BY ALL""")
def _(spark, sf):
    return tk.sliding_num_distinct(events(spark, sf), ["event_type"], ticks=6, name="n").df.select("user_id", "event_id", "n")


@query("sliding_median", f"""
WITH x AS (SELECT *, epoch_us(ts) AS us FROM events)
SELECT user_id, event_id, {R('median(value) OVER w')} AS median FROM x WINDOW w AS {FRAME}""")
def _(spark, sf):
    return st.sliding_median(events(spark, sf), "value", W).df.select("user_id", "event_id", r("median").alias("median"))


@query("sliding_quantiles_ticks", f"""
SELECT user_id, event_id, {R('quantile_cont(value, 0.1) OVER w')} AS p10, {R('quantile_cont(value, 0.75) OVER w')} AS p75
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 14 PRECEDING)""")
def _(spark, sf):
    out = st.sliding_quantiles(events(spark, sf), "value", {"p10": 0.1, "p75": 0.75}, ticks=15)
    return out.df.select("user_id", "event_id", r("p10").alias("p10"), r("p75").alias("p75"))


@query("sliding_quantiles_nearest", f"""
WITH x AS (SELECT *, epoch_us(ts) AS us FROM events)
SELECT user_id, event_id, quantile_disc(value, 0.3) OVER w AS p30, quantile_disc(value, 0.9) OVER w AS p90 FROM x WINDOW w AS {FRAME}""")
def _(spark, sf):
    out = st.sliding_quantiles(events(spark, sf), "value", {"p30": 0.3, "p90": 0.9}, W, interpolate=False)
    return out.df.select("user_id", "event_id", "p30", "p90")


# ---------------------------------------------------------------------------
# Order statistics and weights
# ---------------------------------------------------------------------------


@query("median", f"SELECT l_suppkey, (epoch_us(l_shipdate) - {L0}) // {365 * DAY} AS bucket, {R('median(l_extendedprice)')} AS median FROM lineitem GROUP BY 1, 2")
def _(spark, sf):
    out = st.median(lineitems(spark, sf), "l_extendedprice", Buckets(365 * 86400))
    return out.select("l_suppkey", F.col(BUCKET).alias("bucket"), r("median").alias("median"))


@query("median_global", f"SELECT {R('median(l_extendedprice)')} AS median FROM lineitem")
def _(spark, sf):
    s = lineitems(spark, sf)
    return st.median(s.using(s.df, keys=()), "l_extendedprice").select(r("median").alias("median"))


@query("percentile_rows", """
WITH x AS (SELECT l_suppkey, l_extendedprice, l_quantity, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_quantity) - 1 AS pos,
                  count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem), q AS (SELECT unnest(range(1, 10)) AS k)
SELECT l_suppkey, l_extendedprice, l_quantity, k::BIGINT AS QUANTILE FROM x JOIN q ON x.pos = (q.k * x.n) // 10""")
def _(spark, sf):
    out = st.percentile(lineitems(spark, sf), ["l_extendedprice", ("l_quantity", "asc")], 10)
    return out.select("l_suppkey", "l_extendedprice", "l_quantity", "QUANTILE")


PR = """WITH c AS (SELECT event_type, value, count(*) n FROM events GROUP BY 1, 2),
     d AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY value) - n AS b, sum(n) OVER (PARTITION BY event_type) AS t FROM c),
     p AS (SELECT *, (b + n / 2.0) / t * 100.0 AS pr FROM d)"""


@query("find_value_for_percentile", f"""
{PR}, a AS (SELECT event_type, arg_max(value, pr) av, max(pr) ap FROM p WHERE pr <= 90 GROUP BY 1), z AS (SELECT event_type, arg_min(value, pr) zv, min(pr) zp FROM p WHERE pr >= 90 GROUP BY 1)
SELECT a.event_type, {R('CASE WHEN zp = ap THEN av ELSE av + (zv - av) * (90 - ap) / (zp - ap) END')} AS interpolated, zv AS first_ge FROM a JOIN z USING (event_type)""")
def _(spark, sf):
    s = events(spark, sf)
    s = s.using(s.df, keys=("event_type",))
    a = st.find_value_for_percentile(s, "value", 90, "interpolated_value").select("event_type", r("value").alias("interpolated"))
    z = st.find_value_for_percentile(s, "value", 90, "first_value_with_ge_percentile").select("event_type", F.col("value").alias("first_ge"))
    return a.join(z, "event_type")


@query("find_value_nearest_percentile", f"{PR} SELECT event_type, first(value ORDER BY abs(pr - 37), value) AS value FROM p GROUP BY event_type")
def _(spark, sf):
    s = events(spark, sf)
    return st.find_value_for_percentile(s.using(s.df, keys=("event_type",)), "value", 37, "nearest").select("event_type", "value")


@query("ranking_order", """
SELECT user_id, event_id, rank() OVER (PARTITION BY user_id ORDER BY value DESC)::BIGINT AS RANKING FROM events""")
def _(spark, sf):
    return st.ranking(events(spark, sf), ["value"]).select("user_id", "event_id", "RANKING")


@query("ranking_percent", f"""
WITH x AS (SELECT event_id, count(*) OVER (PARTITION BY event_type) AS n, rank() OVER (PARTITION BY event_type ORDER BY floor(value)) - 1 AS b,
                  count(*) OVER (PARTITION BY event_type, floor(value)) AS e FROM events)
SELECT event_id, {R('(n - b - e) * 100.0 / (n - 1)')} AS lt, {R('(n - b) * 100.0 / n')} AS le FROM x""")
def _(spark, sf):
    s = events(spark, sf)
    s = s.using(s.df.withColumn("v", F.floor("value")), keys=("event_type",))
    lt = st.ranking(s, [("v", "asc")], "percent_lt_values").withColumnRenamed("RANKING", "lt")
    both = st.ranking(s.using(lt), [("v", "asc")], "percent_le_values")
    return both.select("event_id", r("lt").alias("lt"), r("RANKING").alias("le"))


@query("tw_average", f"""
WITH x AS (SELECT user_id, epoch_us(ts) us, value, lead(epoch_us(ts), 1, {S1}) OVER (PARTITION BY user_id ORDER BY ts, event_id) nx FROM events), d AS (SELECT unnest(range(0, 30)) AS b),
     c AS (SELECT user_id, b, value, least(nx, {S0} + (b + 1) * {DAY}) - greatest(us, {S0} + b * {DAY}) AS w FROM x JOIN d ON us < {S0} + (b + 1) * {DAY} AND nx > {S0} + b * {DAY})
SELECT user_id, b AS bucket, {R('sum(value * w) / sum(w)')} AS v FROM c WHERE w > 0 GROUP BY 1, 2""")
def _(spark, sf):
    out = st.tw_average(events(spark, sf), "value", Buckets(86400))
    return out.select("user_id", F.col(BUCKET).alias("bucket"), r("tw_average").alias("v"))


@query("tw_average_groups", f"""
WITH x AS (SELECT user_id, event_type, epoch_us(ts) us, value, lead(epoch_us(ts), 1, {S1}) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) nx FROM events),
     d AS (SELECT b, {S0} + b * 7 * {DAY} AS f, least({S0} + (b + 1) * 7 * {DAY}, {S1}) AS t FROM (SELECT unnest(range(0, 5)) AS b)),
     c AS (SELECT user_id, event_type, b, value, least(nx, t) - greatest(us, f) AS w FROM x JOIN d ON us < t AND nx > f)
SELECT user_id, event_type, b AS bucket, {R('sum(value * w) / sum(w)')} AS v FROM c WHERE w > 0 GROUP BY 1, 2, 3""")
def _(spark, sf):
    out = st.tw_average(events(spark, sf), "value", Buckets(7, "days"), group_by=["event_type"])
    return out.select("user_id", "event_type", F.col(BUCKET).alias("bucket"), r("tw_average").alias("v"))


@query("tw_average_ticks", f"""
WITH n AS (SELECT user_id, epoch_us(ts) us, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
     x AS (SELECT user_id, us, value, (lead(rn, 1, rn) OVER w - 1) // 10 AS b, lead(us, 1, CASE WHEN rn % 10 = 0 THEN us ELSE {S1} END) OVER w - us AS h FROM n WINDOW w AS (PARTITION BY user_id ORDER BY rn))
SELECT user_id, b AS bucket, {R('sum(value * h) / nullif(sum(h), 0)')} AS v FROM x GROUP BY 1, 2""")
def _(spark, sf):
    out = st.tw_average(events(spark, sf), "value", Buckets(10, "ticks"))
    return out.select("user_id", F.col(BUCKET).alias("bucket"), r("tw_average").alias("v"))


@query("tw_average_ticks_groups", f"""
WITH x AS (SELECT user_id, event_type, event_id, ts, epoch_us(ts) us, value, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 20 AS b FROM events),
     g AS (SELECT user_id, b, CASE WHEN count(*) = 20 THEN max(us) ELSE {S1} END AS en FROM x GROUP BY 1, 2),
     e AS (SELECT *, lag(en, 1, {S0}) OVER (PARTITION BY user_id ORDER BY b) AS bg, max(b) OVER (PARTITION BY user_id) AS top FROM g),
     h AS (SELECT *, lead(us, 1, {S1}) OVER w AS nx, lead(b) OVER w AS nb FROM x WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)),
     c AS (SELECT h.user_id, event_type, e.b, value, greatest(least(nx, en), greatest(us, bg)) - greatest(us, bg) AS w FROM h JOIN e ON h.user_id = e.user_id AND e.b BETWEEN h.b AND coalesce(nb, top))
SELECT user_id, event_type, b AS bucket, {R('sum(value * w) / nullif(sum(w), 0)')} AS v FROM c GROUP BY 1, 2, 3""")
def _(spark, sf):
    out = st.tw_average(events(spark, sf), "value", Buckets(20, "ticks"), group_by=["event_type"])
    return out.select("user_id", "event_type", F.col(BUCKET).alias("bucket"), r("tw_average").alias("v"))


RATE = "(ln(2) / 43200.0)"


@query("exp_tw_average_flexible", f"""
WITH x AS (SELECT user_id, epoch_us(ts) us, value, lead(epoch_us(ts), 1, {S1}) OVER w nx, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS b
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
     c AS (SELECT user_id, b, value, (us - max(nx) OVER (PARTITION BY user_id, b)) / 1e6 AS f, (nx - max(nx) OVER (PARTITION BY user_id, b)) / 1e6 AS t FROM x)
SELECT user_id, b::BIGINT AS bucket, {R(f'sum(value * (exp(t * {RATE}) - exp(f * {RATE}))) / nullif(sum(exp(t * {RATE}) - exp(f * {RATE})), 0)')} AS v FROM c GROUP BY 1, 2""")
def _(spark, sf):
    out = st.exp_tw_average(events(spark, sf), "value", 43200, Buckets(unit="flexible", condition=F.col("event_type") == "signup"))
    return out.select("user_id", F.col(BUCKET).alias("bucket"), r("exp_tw_average").alias("v"))


@query("exp_tw_average", f"""
WITH x AS (SELECT user_id, epoch_us(ts) us, value, lead(epoch_us(ts), 1, {S1}) OVER (PARTITION BY user_id ORDER BY ts, event_id) nx FROM events), d AS (SELECT unnest(range(0, 30)) AS b),
     c AS (SELECT user_id, b, value, (greatest(us, {S0} + b * {DAY}) - ({S0} + (b + 1) * {DAY})) / 1e6 AS f, (least(nx, {S0} + (b + 1) * {DAY}) - ({S0} + (b + 1) * {DAY})) / 1e6 AS t
           FROM x JOIN d ON us < {S0} + (b + 1) * {DAY} AND nx > {S0} + b * {DAY})
SELECT user_id, b AS bucket, {R(f'sum(value * (exp(t * {RATE}) - exp(f * {RATE}))) / sum(exp(t * {RATE}) - exp(f * {RATE}))')} AS v FROM c WHERE t > f GROUP BY 1, 2""")
def _(spark, sf):
    out = st.exp_tw_average(events(spark, sf), "value", 43200, Buckets(86400))
    return out.select("user_id", F.col(BUCKET).alias("bucket"), r("exp_tw_average").alias("v"))


@query("exp_w_average", f"""
WITH x AS (SELECT user_id, value, (epoch_us(ts) - {S0}) // {DAY} AS b, row_number() OVER (PARTITION BY user_id, (epoch_us(ts) - {S0}) // {DAY} ORDER BY ts DESC, event_id DESC) - 1 AS a FROM events)
SELECT user_id, b AS bucket, {R('sum(value * exp(-0.5 * a)) / sum(exp(-0.5 * a))')} AS v FROM x GROUP BY 1, 2""")
def _(spark, sf):
    out = st.exp_w_average(events(spark, sf), "value", 0.5, Buckets(86400), "lambda", "event_ts")
    return out.select("user_id", F.col(BUCKET).alias("bucket"), r("exp_w_average").alias("v"))


@query("exp_w_average_groups", f"""
WITH x AS (SELECT user_id, event_type, value, (epoch_us(ts) - {S0}) // (7 * {DAY}) AS b, row_number() OVER (PARTITION BY user_id, event_type, (epoch_us(ts) - {S0}) // (7 * {DAY}) ORDER BY ts DESC, event_id DESC) - 1 AS a FROM events)
SELECT user_id, event_type, b AS bucket, {R('sum(value * exp(-0.5 * a)) / sum(exp(-0.5 * a))')} AS v FROM x GROUP BY 1, 2, 3""")
def _(spark, sf):
    out = st.exp_w_average(events(spark, sf), "value", 0.5, Buckets(7, "days"), "lambda", "event_ts", ["event_type"])
    return out.select("user_id", "event_type", F.col(BUCKET).alias("bucket"), r("exp_w_average").alias("v"))


@query("return_ep", f"""
WITH k AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'), d AS (SELECT unnest(range(0, 30)) AS b), {TRADES_SQL},
     a AS (SELECT user_id, (epoch_us(ts) - {S0}) // {DAY} AS b, arg_min(PRICE, event_id) f, arg_max(PRICE, event_id) l FROM trades GROUP BY 1, 2),
     j AS (SELECT k.user_id, d.b, a.f, a.l, last_value(a.l IGNORE NULLS) OVER (PARTITION BY k.user_id ORDER BY d.b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) p
           FROM k CROSS JOIN d LEFT JOIN a ON a.user_id = k.user_id AND a.b = d.b)
SELECT user_id, make_timestamp({S0} + (b + 1) * {DAY}) AS ts, {R('coalesce(coalesce(l, p) / coalesce(p, f), -1)')} AS ret FROM j""")
def _(spark, sf):
    out = st.return_ep(trades(spark, sf), "PRICE", Buckets(86400))
    return out.df.select("user_id", "ts", r(F.coalesce("return", F.lit(-1.0))).alias("ret"))


LAST_CARRIED = f"""k AS (SELECT DISTINCT user_id FROM trades), d AS (SELECT unnest(range(0, 30)) AS b),
     a AS (SELECT user_id, (epoch_us(ts) - {S0}) // {DAY} AS b, arg_max(PRICE, event_id) l, arg_max(SIZE, event_id) w FROM trades GROUP BY 1, 2),
     j AS (SELECT k.user_id, d.b, last_value(a.l IGNORE NULLS) OVER x l, last_value(a.w IGNORE NULLS) OVER x w FROM k CROSS JOIN d LEFT JOIN a ON a.user_id = k.user_id AND a.b = d.b
           WINDOW x AS (PARTITION BY k.user_id ORDER BY d.b ROWS UNBOUNDED PRECEDING))"""


@query("portfolio_price", f"WITH {TRADES_SQL}, {LAST_CARRIED} SELECT b AS bucket, {R('sum(l * w)')} AS VALUE, count(l) AS NUM_SYMBOLS FROM j WHERE l IS NOT NULL GROUP BY b")
def _(spark, sf):
    out = st.portfolio_price(trades(spark, sf), weight="SIZE", buckets=Buckets(86400))
    return out.select(F.col(BUCKET).alias("bucket"), r("VALUE").alias("VALUE"), "NUM_SYMBOLS")


@query("multi_portfolio_price", f"""
WITH {TRADES_SQL}, {LAST_CARRIED}, m AS (SELECT c_custkey AS user_id, c_mktsegment AS p, c_nationkey - 12.0 AS wt FROM customer)
SELECT b AS bucket, p AS PORTFOLIO_NAME, {R('coalesce(sum(l * wt) FILTER (wt > 0) / sum(abs(wt)) FILTER (wt > 0), -1)')} AS VALUE, count(l) FILTER (wt > 0) AS NUM_SYMBOLS FROM j JOIN m USING (user_id) WHERE l IS NOT NULL GROUP BY 1, 2""")
def _(spark, sf):
    members = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("PORTFOLIO_NAME"), (F.col("c_nationkey") - 12.0).alias("WEIGHT"))
    out = st.multi_portfolio_price(trades(spark, sf), members, side="long", weight_type="relative", buckets=Buckets(86400))
    value = F.coalesce("VALUE", F.lit(-1.0))  # a portfolio may hold nothing long
    return out.select(F.col(BUCKET).alias("bucket"), "PORTFOLIO_NAME", r(value).alias("VALUE"), "NUM_SYMBOLS")


@query("partition_evenly", """
WITH RECURSIVE sums AS (
  SELECT l_returnflag, l_suppkey, CAST(sum(l_quantity) AS DOUBLE) AS w, md5(CAST(l_suppkey AS VARCHAR)) AS name FROM lineitem GROUP BY l_returnflag, l_suppkey),
placed AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY w DESC, l_suppkey) AS i FROM sums),
greedy AS (
  SELECT DISTINCT l_returnflag, CAST(0 AS BIGINT) AS i, l_suppkey * 0 AS l_suppkey, CAST([0, 0, 0, 0] AS DOUBLE[]) AS loads, CAST(-1 AS BIGINT) AS g FROM sums
  UNION ALL
  SELECT l_returnflag, i, l_suppkey, list_transform(loads, lambda x, j: CASE WHEN j = pick THEN x + w ELSE x END), pick - 1
  FROM (SELECT p.l_returnflag, p.i, p.l_suppkey, p.w, q.loads, CAST(list_position(q.loads, list_min(q.loads)) AS BIGINT) AS pick
        FROM greedy q JOIN placed p ON p.l_returnflag = q.l_returnflag AND p.i = q.i + 1 WHERE p.i <= 32)),
held AS (
  SELECT l_returnflag, unnest(loads) AS load, generate_subscripts(loads, 1) AS j
  FROM (SELECT l_returnflag, arg_max(loads, i) AS loads FROM greedy GROUP BY l_returnflag)),
rest AS (SELECT l_returnflag, sum(w) AS rest FROM placed WHERE i > 32 GROUP BY l_returnflag),
levels AS (
  SELECT l_returnflag, min((rest + below) / m) AS level
  FROM (SELECT l_returnflag, sum(load) OVER (PARTITION BY l_returnflag ORDER BY load, j) AS below, row_number() OVER (PARTITION BY l_returnflag ORDER BY load, j) AS m FROM held)
  JOIN rest USING (l_returnflag) GROUP BY l_returnflag),
ends AS (
  SELECT l_returnflag, sum(greatest(level - load, 0)) OVER (PARTITION BY l_returnflag ORDER BY j) AS upto FROM held JOIN levels USING (l_returnflag)),
middles AS (
  SELECT l_returnflag, l_suppkey, sum(w) OVER (PARTITION BY l_returnflag ORDER BY name, l_suppkey) - w / 2 AS middle FROM placed WHERE i > 32)
SELECT l_returnflag, l_suppkey, g AS GROUP_ID FROM greedy WHERE i > 0
UNION ALL
SELECT l_returnflag, l_suppkey, least(count_if(upto <= middle), 3) AS GROUP_ID FROM middles JOIN ends USING (l_returnflag) GROUP BY l_returnflag, l_suppkey
""")
def _(spark, sf):
    s = lineitems(spark, sf)
    out = st.partition_evenly_into_groups(s.using(s.df, keys=("l_returnflag",)), "l_suppkey", "l_quantity", 4, heaviest=8)
    return out.select("l_returnflag", "l_suppkey", "GROUP_ID")


@query("cut_bins", """
WITH b AS (SELECT min(value) lo, max(value) hi FROM events)
SELECT event_id, CASE WHEN value <= lo + (hi - lo) * (1 / 4.0) THEN 'a' WHEN value <= lo + (hi - lo) * (2 / 4.0) THEN 'b' WHEN value <= lo + (hi - lo) * (3 / 4.0) THEN 'c' ELSE 'd' END AS bin
FROM events, b""")
def _(spark, sf):
    df = table(spark, sf, "events")
    return df.select("event_id", st.cut(df, "value", 4, ["a", "b", "c", "d"]).alias("bin"))


@query("qcut_bins", """
WITH x AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS i, count(*) OVER () AS n FROM events),
     e AS (SELECT max(CASE WHEN i = (n + 2) // 3 - 1 THEN value END) e1, max(CASE WHEN i = (2 * n + 2) // 3 - 1 THEN value END) e2 FROM x)
SELECT event_id, CASE WHEN value <= e1 THEN 'a' WHEN value <= e2 THEN 'b' ELSE 'c' END AS bin FROM events, e""")
def _(spark, sf):
    df = table(spark, sf, "events")
    return df.select("event_id", st.qcut(df, "value", 3, ["a", "b", "c"]).alias("bin"))
