"""Queries over sources, projections, filters and time manipulation."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tickloom.core import DAY, HOUR
from tickloom.operators import filters as fi
from tickloom.operators import project as pj
from tickloom.operators import timing as tm
from tickloom.plans.registry import R, S0, SIZE_SQL, TRADES_SQL, events, orders, query, r, table, trades
from tickloom.sources import readers as rd
from tickloom.sources import writers as wr

KEY = "user_id, event_id, ts"


@query("scan_interval_symbols", """
SELECT user_id, event_id, ts, value FROM events
WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12' AND event_type IN ('view', 'purchase')""")
def _(spark, sf):
    s = rd.data_source(f"{sf}/events.parquet", spark, seq=("event_id",), keys=("event_type",),
                       start="2024-01-05", end="2024-01-12", symbols=["view", "purchase"])
    return s.df.select("user_id", "event_id", "ts", "value")


@query("scan_symbols_from_query", """
SELECT e.user_id, e.event_id, e.ts FROM events e
WHERE e.user_id IN (SELECT user_id FROM events GROUP BY user_id HAVING sum(value) > (SELECT 1.1 * sum(value) / count(DISTINCT user_id) FROM events))""")
def _(spark, sf):
    s = events(spark, sf)
    mean = s.df.agg(F.sum("value") / F.count_distinct("user_id") * 1.1).scalar()
    rich = s.df.groupBy("user_id").agg(F.sum("value").alias("v")).where(F.col("v") > mean)
    return rd.data_source(s.df, seq=("event_id",), keys=("user_id",), symbols=rich).df.select("user_id", "event_id", "ts")


@query("scan_date", "SELECT user_id, event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'")
def _(spark, sf):
    return rd.data_source(f"{sf}/events.parquet", spark, seq=("event_id",), keys=("user_id",), date="2024-01-15").df.select(
        "user_id", "event_id", "ts")


@query("scan_schema_policy", """
SELECT event_id, CAST(user_id AS DOUBLE) AS user_id, value, 0::BIGINT AS VOLUME, '' AS COND FROM events""")
def _(spark, sf):
    df = table(spark, sf, "events")
    return rd.conform(df, {"event_id": "long", "user_id": "double", "value": "double", "VOLUME": "long", "COND": "string"},
                      "tolerant_strict")


@query("scan_identify", "SELECT event_id, CAST(user_id AS VARCHAR) AS SYMBOL_NAME, 'EVT' AS TICK_TYPE FROM events")
def _(spark, sf):
    s = rd.data_source(table(spark, sf, "events"), seq=("event_id",), keys=("user_id",), identify="EVT")
    return s.df.select("event_id", "SYMBOL_NAME", "TICK_TYPE")


@query("scan_back_to_first_tick", """
WITH b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events
           WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15')
SELECT user_id, event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'
UNION ALL SELECT user_id, event_id, TIMESTAMP '2024-01-15', value FROM b WHERE rn <= 2""")
def _(spark, sf):
    s = events(spark, sf)
    s = s.using(s.df, start=datetime(2024, 1, 15), end=datetime(2024, 1, 16))
    return tm.back_to_first_tick(s, 7 * DAY, n=2).df.select("user_id", "event_id", "ts", "value")


@query("scan_parquet_projection", "SELECT event_id, value, TIMESTAMP '2024-01-01' AS ts FROM events WHERE value > 20")
def _(spark, sf):
    s = rd.read_parquet(spark, f"{sf}/events.parquet", where=F.col("value") > 20, fields=["event_id", "value"],
                        start=datetime(2024, 1, 1), end=datetime(2024, 1, 31), seq=("event_id",))
    return s.df.select("event_id", "value", "ts")


@query("scan_trades_preset", f"SELECT event_id, value AS PRICE, {SIZE_SQL} AS SIZE FROM events WHERE event_type = 'purchase'")
def _(spark, sf):
    t = trades(spark, sf)
    return rd.preset("trades", t.df, seq=("event_id",), keys=("user_id",)).df.select("event_id", "PRICE", "SIZE")


@query("scan_generated_ticks", """
WITH d AS (SELECT unnest(range(0, 720)) AS seq),
     n AS (SELECT (epoch_us(ts) - 1704067200000000) // 3600000000 AS seq, count(*) c FROM events GROUP BY 1)
SELECT TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * d.seq AS ts, d.seq::BIGINT AS seq, coalesce(n.c, 0)::BIGINT AS n
FROM d LEFT JOIN n USING (seq)""")
def _(spark, sf):
    grid = rd.tick(spark, {}, datetime(2024, 1, 1), datetime(2024, 1, 31), every_us=HOUR)
    s = events(spark, sf)
    counts = s.df.groupBy(F.floor((s.us - S0) / HOUR).alias("seq")).agg(F.count("*").alias("c"))
    return grid.df.join(counts, "seq", "left").select("ts", "seq", F.coalesce("c", F.lit(0)).cast("long").alias("n"))


@query("symbols_like", "SELECT DISTINCT p_brand FROM part WHERE p_brand LIKE 'Brand#1%'")
def _(spark, sf):
    s = orders(spark, sf)
    return rd.symbols(s.using(table(spark, sf, "part"), keys=("p_brand",)), "Brand#1%")


@query("split_by_symbol", "SELECT event_type, min(ts) AS first_ts, count(*) AS n FROM events GROUP BY event_type")
def _(spark, sf):
    s = rd.by_symbol(events(spark, sf), "event_type")
    return s.df.groupBy(*s.keys).agg(F.min("ts").alias("first_ts"), F.count("*").alias("n"))


@query("inspect_dates", "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events")
def _(spark, sf):
    return rd.dates(events(spark, sf)).select(F.col("date").cast("string").alias("day"))


@query("inspect_last_date", "SELECT strftime(max(ts), '%Y-%m-%d') AS last_day FROM events")
def _(spark, sf):
    return rd.last_date(events(spark, sf)).select(F.col("last_date").cast("string").alias("last_day"))


@query("daily_ohlcv", f"""
WITH {TRADES_SQL}
SELECT user_id, date_trunc('day', ts) + INTERVAL 1 DAY AS ts, arg_min(PRICE, event_id) AS OPEN, max(PRICE) AS HIGH,
       min(PRICE) AS LOW, arg_max(PRICE, event_id) AS CLOSE, sum(SIZE)::BIGINT AS VOLUME
FROM trades GROUP BY user_id, date_trunc('day', ts)""")
def _(spark, sf):
    from tickloom.plans.recipes import ohlcv

    return ohlcv(trades(spark, sf), 1, "days").df.select("user_id", "ts", "OPEN", "HIGH", "LOW", "CLOSE", "VOLUME")


@query("change_only_series", """
WITH l AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) p FROM events)
SELECT user_id, event_id, event_type FROM l WHERE p IS DISTINCT FROM event_type""")
def _(spark, sf):
    s = pj.lag(events(spark, sf), {"p": ("event_type", 1)})
    return s.df.where(F.col("p").isNull() | (F.col("p") != F.col("event_type"))).select("user_id", "event_id", "event_type")


@query("snapshot_last_n", """
WITH x AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) rn FROM events)
SELECT user_id, event_type, event_id, value FROM x WHERE rn <= 3""")
def _(spark, sf):
    return wr.snapshot(events(spark, sf), 3, ["event_type"]).select("user_id", "event_type", "event_id", "value")


@query("head_ticks", "SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 25")
def _(spark, sf):
    return fi.head(events(spark, sf), 25).select("event_id", "ts", "value")


@query("tail_ticks", "SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 25")
def _(spark, sf):
    return fi.tail(events(spark, sf), 25).select("event_id", "ts", "value")


@query("text_sink_rows", "SELECT CAST(event_id AS VARCHAR) AS event_id, printf('%.2f', value) AS value, strftime(ts, '%Y/%m/%d %H:%M') AS ts FROM events")
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value", "ts")
    return wr.as_text(df, {"value": "%.2f", "ts": "%Y/%m/%d %H:%M"})


# ---------------------------------------------------------------------------
# Columns
# ---------------------------------------------------------------------------


@query("add_fields", f"SELECT event_id, value * 2 AS doubled, {R('value / 3')} AS third, upper(event_type) AS kind FROM events")
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value", "event_type")
    df = pj.add_fields(df, {"doubled": F.col("value") * 2, "third": r(F.col("value") / 3), "kind": F.upper("event_type")})
    return df.select("event_id", "doubled", "third", "kind")


@query("update_where", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS value,
       CASE WHEN event_type = 'error' THEN 'bad' ELSE upper(event_type) END AS event_type FROM events""")
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value", "event_type")
    return pj.update(df, {"value": F.lit(0.0), "event_type": F.lit("bad")}, {"event_type": F.upper("event_type")},
                     where=F.col("event_type") == "error")


@query("table_schema", "SELECT CAST(event_id AS INTEGER) AS event_id, value, '' AS NOTE FROM events")
def _(spark, sf):
    return pj.table(table(spark, sf, "events"), {"event_id": "int", "value": "double", "NOTE": "string"})


@query("select_regex", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def _(spark, sf):
    return pj.select(table(spark, sf, "lineitem"), "l_.*key", regex=True)


@query("drop_regex", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(spark, sf):
    return pj.drop(table(spark, sf, "orders"), "o_order[a-z]*(status|date|priority)", regex=True)


@query("rename_regex", "SELECT p_partkey AS key_p, p_size AS size_p FROM part")
def _(spark, sf):
    return pj.rename(table(spark, sf, "part").select("p_partkey", "p_size"), {r"p_(?:part)?(.*)": r"\1_p"}, regex=True)


@query("add_prefix_suffix", "SELECT n_nationkey AS L_n_nationkey_X, n_name AS L_n_name_X FROM nation")
def _(spark, sf):
    df = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return pj.add_suffix(pj.add_prefix(df, "L_"), "_X")


@query("row_mean_unite", f"""
SELECT l_orderkey, l_linenumber, {R('(l_quantity + l_extendedprice + l_discount) / 3.0')} AS m,
       l_returnflag || '-' || l_linestatus || '-' || CAST(l_linenumber AS VARCHAR) AS u FROM lineitem""")
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", r(pj.row_mean("l_quantity", "l_extendedprice", "l_discount")).alias("m"),
        pj.unite_columns("-", "l_returnflag", "l_linestatus", "l_linenumber").alias("u"))


@query("transpose_rows", """
WITH x AS (SELECT user_id, event_id, ts, value, row_number() OVER w rn, lag(value, 1) OVER w v2, lag(value, 2) OVER w v3
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id, ts, value AS value_1, v2 AS value_2, v3 AS value_3 FROM x WHERE rn % 3 = 0""")
def _(spark, sf):
    s = events(spark, sf)
    return pj.transpose_rows(s.using(s.df.drop("event_type")), 3, ["value"]).df


@query("transpose_columns", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, 'l_quantity' AS field, l_quantity AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, 'l_tax', l_tax FROM lineitem""")
def _(spark, sf):
    return pj.transpose_columns(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"],
                                ["l_quantity", "l_tax"], "field", "amount")


@query("where_branches", """
SELECT 'match' AS branch, event_id FROM events WHERE value > 10 AND event_type = 'view'
UNION ALL SELECT 'other', event_id FROM events WHERE NOT (value > 10 AND event_type = 'view')""")
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value", "event_type")
    yes, no = fi.where_clause(df, (F.col("value") > 10) & (F.col("event_type") == "view"))
    return yes.select(F.lit("match").alias("branch"), "event_id").unionByName(no.select(F.lit("other").alias("branch"), "event_id"))


@query("stop_on_first_mismatch", """
WITH x AS (SELECT *, min(CASE WHEN value < 25 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) ok FROM events)
SELECT user_id, event_id FROM x WHERE ok = 1""")
def _(spark, sf):
    return fi.stop_on_first_mismatch(events(spark, sf), F.col("value") < 25).df.select("user_id", "event_id")


@query("switch_cases", """
SELECT event_id, CASE WHEN event_type = 'view' THEN 'a' WHEN event_type IN ('click', 'error') THEN 'b' ELSE 'rest' END AS branch FROM events""")
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "event_type")
    parts = fi.switch(df, F.col("event_type"), {"a": "view", "b": ("click", "error")}, default="rest")
    out = None
    for name, part in parts.items():
        part = part.select("event_id", F.lit(name).alias("branch"))
        out = part if out is None else out.unionByName(part)
    return out


@query("if_else", "SELECT event_id, CASE WHEN value > 10 THEN 'high' ELSE 'low' END AS level FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", fi.if_else(F.col("value") > 10, F.lit("high"), F.lit("low")).alias("level"))


HOLES = "CASE WHEN event_type = 'error' THEN NULL ELSE value END"


@query("dropna", f"SELECT event_id, {HOLES} AS v FROM events WHERE event_type <> 'error'")
def _(spark, sf):
    df = table(spark, sf, "events")
    v = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return fi.dropna(df.select("event_id", v.alias("v")))


@query("fillna_value", f"SELECT event_id, coalesce({HOLES}, -1.0) AS v FROM events")
def _(spark, sf):
    v = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return pj.fillna(table(spark, sf, "events").select("event_id", v.alias("v")), -1.0)


@query("fill_forward", f"""
SELECT user_id, event_id, coalesce(last_value({HOLES} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), -1.0) AS v
FROM events""")
def _(spark, sf):
    s = events(spark, sf)
    v = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    out = pj.fill_forward(s.using(s.df.withColumn("v", v)), ["v"])
    return out.df.select("user_id", "event_id", F.coalesce("v", F.lit(-1.0)).alias("v"))


@query("time_filter_clock", """
SELECT event_id, ts FROM events
WHERE epoch_us(ts) % 86400000000 >= 34200000000 AND epoch_us(ts) % 86400000000 < 57600000000 AND dayofweek(ts) BETWEEN 1 AND 5""")
def _(spark, sf):
    return fi.time_filter(table(spark, sf, "events"), "ts", "093000000", "160000000", "0.0.12345").select("event_id", "ts")


@query("time_filter_zone", """
WITH l AS (SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS t FROM events)
SELECT event_id FROM l WHERE epoch_us(t) % 86400000000 >= 34200000000 AND epoch_us(t) % 86400000000 < 57600000000""")
def _(spark, sf):
    return fi.time_filter(table(spark, sf, "events"), "ts", "093000000", "160000000", timezone="America/New_York").select("event_id")


@query("character_present", "SELECT p_partkey FROM part WHERE regexp_matches(p_name, '[zgw]')")
def _(spark, sf):
    return fi.character_present(table(spark, sf, "part"), "p_name", "zgw").select("p_partkey")


@query("value_present", "SELECT event_id FROM events WHERE event_type IN ('view', 'signup')")
def _(spark, sf):
    return fi.value_present(table(spark, sf, "events"), "event_type", ["view", "signup"]).select("event_id")


@query("primary_exchange", """
WITH p AS (SELECT user_id, ts, event_type AS prim FROM events WHERE value > 30),
     x AS (SELECT e.user_id, e.event_id, e.event_type, p.prim FROM events e ASOF JOIN p ON e.user_id = p.user_id AND e.ts >= p.ts)
SELECT user_id, event_id FROM x WHERE event_type = prim""")
def _(spark, sf):
    s = events(spark, sf)
    ref = s.using(s.df.where(F.col("value") > 30).select("user_id", "ts", "event_id", F.col("event_type").alias("PRIMARY")))
    return fi.primary_exchange(s, ref, exchange="event_type").df.select("user_id", "event_id")


@query("hidden_ticks", "SELECT event_id FROM events WHERE event_type <> 'error'")
def _(spark, sf):
    df = table(spark, sf, "events").withColumn("TICK_STATUS", F.when(F.col("event_type") == "error", 26).otherwise(0))
    return fi.hide_ticks(df).select("event_id")


@query("skip_bad_tick")
def _(spark, sf):
    from tickloom.operators.outliers import skip_bad_tick

    return skip_bad_tick(events(spark, sf), "value", 3.0).df.select("user_id", "event_id", "value")


@query("skip_bad_tick_symmetric", """
WITH x AS (SELECT user_id, event_id, value, lag(value) OVER w p, lead(value) OVER w n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
     y AS (SELECT *, (CASE WHEN greatest(value / p, p / value) > 3 THEN 1 ELSE 0 END) + (CASE WHEN greatest(value / n, n / value) > 3 THEN 1 ELSE 0 END) AS far,
                  (CASE WHEN p IS NULL THEN 0 ELSE 1 END) + (CASE WHEN n IS NULL THEN 0 ELSE 1 END) AS known FROM x)
SELECT user_id, event_id FROM y WHERE far * 2 <= known""")
def _(spark, sf):
    return fi.skip_bad_tick_symmetric(events(spark, sf), "value", 3.0).df.select("user_id", "event_id")


@query("row_slice", """
WITH x AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 i, count(*) OVER (PARTITION BY user_id) n FROM events)
SELECT user_id, event_id FROM x WHERE i >= greatest(n - 20, 0) AND i < n - 3 AND (i - greatest(n - 20, 0)) % 4 = 0""")
def _(spark, sf):
    return fi.row_slice(events(spark, sf), -20, -3, 4).df.select("user_id", "event_id")


@query("limit_per_symbol", """
WITH x AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) rn FROM events)
SELECT user_id, event_id FROM x WHERE rn > 2 AND rn <= 7""")
def _(spark, sf):
    return fi.limit(events(spark, sf), 5, 2).df.select("user_id", "event_id")


@query("limit_across_symbols", "SELECT user_id, event_id FROM events ORDER BY ts, event_id LIMIT 40 OFFSET 10")
def _(spark, sf):
    return fi.limit(events(spark, sf), 40, 10, across_symbols=True).df.select("user_id", "event_id")


@query("insert_tick", """
SELECT event_id, ts, value, 0 AS sub FROM events
UNION ALL SELECT event_id, ts, -value, s FROM events, (VALUES (-2), (-1)) AS t(s) WHERE event_type = 'purchase'""")
def _(spark, sf):
    s = events(spark, sf)
    out = pj.insert_tick(s, {"value": -F.col("value")}, where=F.col("event_type") == "purchase", num_ticks=2)
    return out.df.select("event_id", "ts", "value", "sub")


@query("insert_at_end", """
SELECT user_id, ts, 0 AS AT_END FROM events
UNION ALL SELECT DISTINCT user_id, TIMESTAMP '2024-01-31', 1 FROM events""")
def _(spark, sf):
    return pj.insert_at_end(events(spark, sf)).df.select("user_id", "ts", "AT_END")


@query("quality_events", """
SELECT event_id, 'SUSPECT' AS DQ_EVENT FROM events WHERE value > 50
UNION ALL SELECT event_id, 'NONE' FROM events""")
def _(spark, sf):
    out = fi.quality_events(events(spark, sf), F.when(F.col("value") > 50, F.lit("SUSPECT")))
    return out.df.select("event_id", F.coalesce("DQ_EVENT", F.lit("NONE")).alias("DQ_EVENT"))


@query("throw_when", "SELECT event_id FROM events")
def _(spark, sf):
    return pj.throw(table(spark, sf, "events"), F.col("value") < 0, "negative value").select("event_id")


@query("modify_symbol_name", "SELECT event_id, 'U_' || CAST(user_id AS VARCHAR) AS user_id FROM events")
def _(spark, sf):
    s = events(spark, sf)
    return pj.modify_symbol_name(s, F.concat(F.lit("U_"), F.col("user_id").cast("string"))).df.select("event_id", "user_id")


@query("lag_lead", """
SELECT user_id, event_id, coalesce(lag(value, 2) OVER w, 0.0) AS prev2, coalesce(lead(value, 1) OVER w, 0.0) AS next1
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(spark, sf):
    s = pj.lead(pj.lag(events(spark, sf), {"prev2": ("value", 2)}), {"next1": ("value", 1)})
    return s.df.select("user_id", "event_id", F.coalesce("prev2", F.lit(0.0)).alias("prev2"), F.coalesce("next1", F.lit(0.0)).alias("next1"))


@query("lag_ties", """
SELECT o_custkey, o_orderkey, coalesce(lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), 0.0) AS prev FROM orders""")
def _(spark, sf):
    s = pj.lag(orders(spark, sf), {"prev": ("o_totalprice", 1)})
    return s.df.select("o_custkey", "o_orderkey", F.coalesce("prev", F.lit(0.0)).alias("prev"))


@query("cumsum", f"""
SELECT user_id, event_id, {R('sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)')} AS total FROM events""")
def _(spark, sf):
    s = pj.cumsum(events(spark, sf), {"total": F.col("value")})
    return s.df.select("user_id", "event_id", r("total").alias("total"))


@query("cumsum_global", f"""
SELECT event_id, {R('sum(value) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)')} AS total FROM events""")
def _(spark, sf):
    s = events(spark, sf)
    return pj.cumsum(s.using(s.df, keys=()), {"total": F.col("value")}).df.select("event_id", r("total").alias("total"))


# ---------------------------------------------------------------------------
# Time
# ---------------------------------------------------------------------------


@query("sort_nan_first", f"""
SELECT event_id, row_number() OVER (ORDER BY CASE WHEN event_type = 'error' THEN 0 ELSE 1 END, CASE WHEN event_type = 'error' THEN 0 ELSE value END, event_id)::BIGINT AS pos
FROM events""")
def _(spark, sf):
    from tickloom.core import Series
    from tickloom.ordering import row_number

    v = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    df = table(spark, sf, "events").select("event_id", v.alias("v"))
    top = tm.sort(df, ["v", "event_id"])
    rank = F.when(F.isnan("v"), F.lit(-1)).otherwise(F.floor(F.col("v") * 1000)).cast("long")
    s = Series(top.withColumn("rank", rank), us_column="rank", ts="rank", seq=("event_id",), slice_us=1000)
    return row_number(s, "pos").select("event_id", "pos")


@query("set_time", "SELECT event_id, ts + INTERVAL 90 SECOND AS ts FROM events")
def _(spark, sf):
    s = events(spark, sf)
    return tm.set_time(s, F.timestamp_add("SECOND", F.lit(90), F.col("ts"))).df.select("event_id", "ts")


@query("update_timestamp", f"""
WITH x AS (SELECT user_id, event_id, epoch_us(ts) AS us, epoch_us(ts) + (floor(value)::BIGINT % 3) * 7200000000 AS nu FROM events),
     m AS (SELECT *, max(nu) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) mx FROM x)
SELECT user_id, event_id, make_timestamp(CASE WHEN mx - nu > 3600000000 THEN mx ELSE nu END) AS ts FROM m""")
def _(spark, sf):
    s = events(spark, sf)
    late = F.timestamp_add("HOUR", F.floor("value").cast("long") % 3 * 2, F.col("ts"))
    out = tm.update_timestamp(s.using(s.df.withColumn("other", late)), "other", max_delay_us=HOUR, out_of_order="use_previous")
    return out.df.select("user_id", "event_id", "ts")


_DELAYED = """
WITH x AS (SELECT user_id, event_id, epoch_us(ts) AS us, epoch_us(ts) + (floor(value)::BIGINT % 5 - 2) * 7200000000 AS nu FROM events),
     y AS (SELECT *, nu - us > 7200000000 OR us - nu > 7200000000 AS apart FROM x)
"""


def _delayed(spark, sf, handling):
    s = events(spark, sf)
    moved = F.timestamp_add("HOUR", (F.floor("value").cast("long") % 5 - 2) * 2, F.col("ts"))
    limits = {"max_delay_of_original_us": 2 * HOUR, "max_delay_of_new_us": 2 * HOUR, "delay_handling": handling}
    return tm.update_timestamp(s.using(s.df.withColumn("other", moved)), "other", **limits).df.select("user_id", "event_id", "ts")


@query("update_timestamp_discard", f"{_DELAYED} SELECT user_id, event_id, make_timestamp(nu) AS ts FROM y WHERE NOT apart")
def _(spark, sf):
    return _delayed(spark, sf, "discard")


@query("update_timestamp_original", f"{_DELAYED} SELECT user_id, event_id, make_timestamp(CASE WHEN apart THEN us ELSE nu END) AS ts FROM y")
def _(spark, sf):
    return _delayed(spark, sf, "use_original")


@query("modify_query_times", "SELECT event_id, TIMESTAMP '2024-02-01' AS ts FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'")
def _(spark, sf):
    s = tm.modify_query_times(events(spark, sf), "2024-01-10", "2024-01-11", F.expr("TIMESTAMP_NTZ'2024-02-01'"))
    return s.df.select("event_id", "ts")


@query("time_interval_shift", """
SELECT event_id, ts - INTERVAL 6 HOUR AS ts FROM events WHERE ts >= TIMESTAMP '2024-01-10 06:00' AND ts < TIMESTAMP '2024-01-20 06:00'""")
def _(spark, sf):
    s = events(spark, sf)
    return tm.time_interval_shift(s.using(s.df, start=datetime(2024, 1, 10), end=datetime(2024, 1, 20)), 6 * HOUR).df.select("event_id", "ts")


@query("time_interval_change", """
SELECT event_id, greatest(least(ts, TIMESTAMP '2024-01-20'), TIMESTAMP '2024-01-10') AS ts FROM events
WHERE ts >= TIMESTAMP '2024-01-09' AND ts < TIMESTAMP '2024-01-20 12:00'""")
def _(spark, sf):
    s = events(spark, sf)
    return tm.time_interval_change(s.using(s.df, start=datetime(2024, 1, 10), end=datetime(2024, 1, 20)), -DAY, DAY // 2).df.select("event_id", "ts")


@query("show_symbol_errors", "SELECT user_id, event_id, TIMESTAMP '2024-01-01' AS ts, 7::BIGINT AS ERROR_CODE, 'bad ' || event_type AS ERROR_MESSAGE FROM events WHERE value > 40")
def _(spark, sf):
    s = fi.throw_for_symbol(events(spark, sf), F.col("value") > 40, F.concat(F.lit("bad "), "event_type"), 7)
    return fi.show_symbol_errors(s).df


@query("intercept_symbol_errors", """
SELECT 'ticks' AS kind, event_id FROM events WHERE value <= 40 OR value IS NULL
UNION ALL SELECT 'symbols', event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE value > 40)""")
def _(spark, sf):
    s = fi.throw_for_symbol(events(spark, sf), F.col("value") > 40, "bad")
    ticks, symbols = fi.intercept_symbol_errors(s).df, fi.intercept_symbol_errors(s, whole_symbols=True).df
    return ticks.select(F.lit("ticks").alias("kind"), "event_id").unionByName(symbols.select(F.lit("symbols").alias("kind"), "event_id"))


@query("inspect_last_not_empty_date", "SELECT strftime(max(ts), '%Y-%m-%d') AS last_day FROM events WHERE event_type = 'signup' AND ts >= TIMESTAMP '2024-01-12' AND ts < TIMESTAMP '2024-01-18'")
def _(spark, sf):
    return rd.last_not_empty_date(events(spark, sf, "signup"), date(2024, 1, 17), 5).select(F.col("last_date").cast("string").alias("last_day"))


@query("mkt_activity", """
WITH c AS (SELECT date_trunc('day', ts) d FROM events GROUP BY 1),
     s AS (SELECT d + INTERVAL 9 HOUR b, d + INTERVAL 16 HOUR e, 'R' f FROM c UNION ALL SELECT d + INTERVAL 15 HOUR, d + INTERVAL 20 HOUR, 'A' FROM c)
SELECT x.event_id, coalesce((SELECT string_agg(f, '' ORDER BY f) FROM s WHERE x.ts >= s.b AND x.ts < s.e), '') AS act FROM events x""")
def _(spark, sf):
    s = events(spark, sf)
    days = s.df.select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("d")).distinct()

    def at(h):
        return F.timestamp_add("HOUR", F.lit(h), F.col("d"))

    calendar = days.select(at(9).alias("b"), at(16).alias("e"), F.lit("R").alias("f")).unionByName(
        days.select(at(15).alias("b"), at(20).alias("e"), F.lit("A").alias("f")))
    return tm.mkt_activity(s, calendar, "b", "e", "f", "act").df.select("event_id", "act")


@query("apply_times_daily", "SELECT event_id FROM events WHERE epoch_us(ts) % 86400000000 >= 32400000000 AND epoch_us(ts) % 86400000000 < 61200000000")
def _(spark, sf):
    return tm.apply_times_daily(events(spark, sf), "090000000", "170000000").df.select("event_id")
