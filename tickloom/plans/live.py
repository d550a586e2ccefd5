"""Queries that run the analytics as Structured Streaming over the stored ticks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.core import DAY, HOUR
from tickloom.plans.registry import R, query, r
from tickloom.streaming import stream as ss

HEARTBEAT = "2200-01-01 00:00:00"
SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder; a temporary one where none is named, on local masters only."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("a cluster needs a shared folder in spark.checkpoint.dir")
    return f"{root or tempfile.mkdtemp(prefix='tickloom-')}/{uuid.uuid4().hex}"


def source(spark: SparkSession, sf: str, kind: str | None = None) -> DataFrame:
    from pyspark.sql import types as T

    schema = T._parse_datatype_string(SCHEMA)
    df = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    # one tick after all others closes what is still open: buckets, sessions, ticks held back for order
    end = f"{shared_dir(spark)}/heartbeat"
    spark.sql(f"SELECT timestamp_ntz'{HEARTBEAT}' AS ts").select(*[F.col("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]).write.parquet(end)
    df = df.unionByName(spark.readStream.schema(schema).parquet(end))
    df = df.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "0 seconds")
    # conditions on the watermarked time stay above the watermark, and so does what is asked of the event type later
    live = F.col("ts") < F.lit(HEARTBEAT).cast("timestamp")
    df = df.where(live).withColumn("event_type", F.when(live, F.col("event_type")))
    return df if kind is None else df.where(F.col("event_type") == kind)


def drain(spark: SparkSession, df: DataFrame, mode: str = "append") -> DataFrame:
    """Run a query over everything there is and read back what it wrote."""
    base = shared_dir(spark)
    out = f"{base}/out"

    def sink(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch, overwritten if the batch is repeated.
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = ss.run(df, sink, f"{base}/state", mode)
    q.awaitTermination()
    fields = df.schema
    return spark.read.schema(fields).parquet(out).select(*fields.names)


def ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("stream_pass_through", "SELECT event_id, value FROM events WHERE value > 10")
def _(spark, sf):
    return drain(spark, source(spark, sf).where("value > 10").select("event_id", "value"))


@query("stream_tumbling", f"""
SELECT user_id, date_trunc('day', ts) + INTERVAL 1 DAY AS ts, count(*) AS n, {R('sum(value)')} AS s FROM events GROUP BY 1, 2""")
def _(spark, sf):
    out = ss.tumbling(source(spark, sf), "ts", "1 day", ["user_id"], {"n": F.count("*"), "s": F.sum("value")})
    return ntz(drain(spark, out), "ts").select("user_id", "ts", "n", r("s").alias("s"))


@query("stream_hopping", """
WITH w AS (SELECT user_id, value, date_trunc('day', ts) + INTERVAL 1 DAY * k AS e FROM events, (VALUES (1), (2)) AS t(k))
SELECT user_id, e AS ts, count(*) AS n, max(value) AS hi FROM w GROUP BY 1, 2""")
def _(spark, sf):
    out = ss.hopping(source(spark, sf), "ts", "2 days", "1 day", ["user_id"], {"n": F.count("*"), "hi": F.max("value")})
    return ntz(drain(spark, out), "ts").select("user_id", "ts", "n", "hi")


@query("stream_sessions", """
WITH x AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) p FROM events),
     y AS (SELECT *, sum(CASE WHEN ts >= p + INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) b FROM x)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS ts, count(*) AS n FROM y GROUP BY user_id, b""")
def _(spark, sf):
    out = ss.sessions(source(spark, sf), "ts", "6 hours", ["user_id"], {"n": F.count("*")})
    return ntz(drain(spark, out), "ts", "session_start").select("user_id", "session_start", "ts", "n")


@query("stream_deduplicate", "SELECT count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events)")
def _(spark, sf):
    out = ss.deduplicate(source(spark, sf).select("user_id", "event_type", "ts"), ["user_id", "event_type"])
    return drain(spark, out).agg(F.count("*").alias("n"))


@query("stream_symbols", "SELECT DISTINCT user_id FROM events")
def _(spark, sf):
    return drain(spark, ss.discover_symbols(source(spark, sf), "user_id"))


@query("stream_window_join", """
SELECT b.user_id, b.event_id, v.event_id AS vid FROM events b JOIN events v ON b.user_id = v.user_id AND v.ts <= b.ts AND v.ts > b.ts - INTERVAL 12 HOUR
WHERE b.event_type = 'purchase' AND v.event_type = 'view'""")
def _(spark, sf):
    b = source(spark, sf, "purchase").select("user_id", "event_id", "ts")
    v = source(spark, sf, "view").select("user_id", F.col("event_id").alias("vid"), F.col("ts").alias("vts"))
    out = ss.window_join(b, v, ["user_id"], "ts", "vts", "12 HOURS").select("user_id", "event_id", "vid")
    return drain(spark, out)


@query("stream_enrich", "SELECT e.event_id, coalesce(c.c_mktsegment, 'none') AS c_mktsegment FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id")
def _(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return drain(spark, ss.enrich(source(spark, sf), c, ["user_id"]).select("event_id", F.coalesce("c_mktsegment", F.lit("none")).alias("c_mktsegment")))


@query("stream_snapshot", """
WITH x AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events) SELECT user_id, event_id, value FROM x WHERE rn <= 2""")
def _(spark, sf):
    base = shared_dir(spark)
    sink = ss.snapshot_sink(f"{base}/snapshot", ["user_id"], ["ts", "event_id"], 2)
    ss.run(source(spark, sf).select("user_id", "event_id", "ts", "value"), sink, f"{base}/state").awaitTermination()
    return ss.read_snapshot(spark, f"{base}/snapshot").select("user_id", "event_id", "value")


@query("stream_asof", """
WITH b AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase'), v AS (SELECT user_id, ts, value FROM events WHERE event_type = 'view')
SELECT b.user_id, b.event_id, b.ts, coalesce(v.value, -1.0) AS value FROM b ASOF LEFT JOIN v ON b.user_id = v.user_id AND b.ts >= v.ts""")
def _(spark, sf):
    df = source(spark, sf)
    out = ss.asof_join_marked(df, ["user_id"], "ts", "event_id", "value", F.col("event_type") == "purchase", F.col("event_type") == "view")
    return drain(spark, out).select("user_id", "event_id", "ts", F.coalesce("value", F.lit(-1.0)).alias("value"))


@query("stream_sliding_sum", f"""
WITH x AS (SELECT *, epoch_us(ts) AS us FROM events)
SELECT user_id, event_id, {R(f'sum(value) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN {DAY - 1} PRECEDING AND CURRENT ROW)')} AS s,
       count(*) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN {DAY - 1} PRECEDING AND CURRENT ROW) AS n FROM x""")
def _(spark, sf):
    out = ss.sliding_sum(source(spark, sf), ["user_id"], "ts", "event_id", "value", DAY)
    return drain(spark, out).select("user_id", "event_id", r("total").alias("s"), "n")


@query("stream_state", """
SELECT user_id, event_id, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS state FROM events""")
def _(spark, sf):
    out = ss.running_state(source(spark, sf), ["user_id"], "ts", "event_id", "value", max, 0.0)
    return drain(spark, out).select("user_id", "event_id", "state")


@query("stream_sliding", f"""
WITH x AS (SELECT *, epoch_us(ts) AS us FROM events)
SELECT user_id, event_id, {R('sum(value) OVER w')} AS s, count(*) OVER w AS n, min(value) OVER w AS low, max(value) OVER w AS high
FROM x WINDOW w AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN {3 * DAY - 1} PRECEDING AND CURRENT ROW)""")
def _(spark, sf):
    out = ss.sliding(source(spark, sf), ["user_id"], "ts", "event_id", "value", 3 * DAY)
    return drain(spark, out).select("user_id", "event_id", r("total").alias("s"), "n", "low", "high")


@query("stream_window_folds", f"""
WITH x AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS us, CASE WHEN event_type = 'view' THEN value END AS v FROM events),
     f AS (SELECT *, sum(v) OVER w AS s, count(v) OVER w AS n, max(v) OVER w AS high
           FROM x WINDOW w AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN {DAY - 1} PRECEDING AND CURRENT ROW))
SELECT user_id, event_id, n, {R('coalesce(s, 0)')} AS s, coalesce(high, -1) AS high FROM f WHERE event_type = 'purchase'""")
def _(spark, sf):
    of = lambda kind: F.col("event_type") == kind
    out = ss.window_folds_marked(source(spark, sf), ["user_id"], "ts", "event_id", "value", DAY, of("purchase"), of("view"))
    return drain(spark, out).select(
        "user_id", "event_id", "n", r(F.coalesce("total", F.lit(0.0))).alias("s"), F.coalesce("high", F.lit(-1.0)).alias("high"))


def _late_ticks(instead: str, keep: str = "") -> str:
    return f"""
WITH x AS (SELECT user_id, event_id, epoch_us(ts) AS us, epoch_us(ts) + (floor(value)::BIGINT % 3) * 7200000000 AS nu FROM events),
     m AS (SELECT *, max(nu) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) mx FROM x)
SELECT user_id, event_id, make_timestamp(CASE WHEN mx - nu > 3600000000 THEN {instead} ELSE nu END) AS other FROM m {keep}"""


def _moved(spark, sf, policy):
    late = F.timestamp_add("HOUR", F.floor("value").cast("long") % 3 * 2, F.col("ts"))
    out = ss.update_timestamp(source(spark, sf).withColumn("other", late), ["user_id"], "ts", "event_id", "other", 3_600_000_000, policy)
    return drain(spark, out).select("user_id", "event_id", "other")


@query("stream_late_use_previous", _late_ticks("mx"))
def _(spark, sf):
    return _moved(spark, sf, "use_previous")


@query("stream_late_discard", _late_ticks("NULL", "WHERE mx - nu <= 3600000000"))
def _(spark, sf):
    return _moved(spark, sf, "discard")


@query("stream_collections", """
WITH x AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) p FROM events),
     y AS (SELECT *, sum(CASE WHEN ts > p + INTERVAL 12 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) b FROM x),
     z AS (SELECT *, row_number() OVER (PARTITION BY user_id, b, floor(value)::BIGINT % 5 ORDER BY ts, event_id) AS nth FROM y)
SELECT user_id, event_id, max(value) OVER (PARTITION BY user_id, b ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS recent,
       count(CASE WHEN nth = 1 THEN 1 END) OVER (PARTITION BY user_id, b ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS kinds, nth AS seen FROM z""")
def _(spark, sf):
    def step(us, value, recent, counts):
        recent = [*recent, value][-3:]
        kind = int(value // 1) % 5
        counts = {**counts, kind: counts.get(kind, 0) + 1}
        return (max(recent), len(counts), counts[kind]), (recent, counts)

    out = ss.keyed_state(
        source(spark, sf), ["user_id"], "ts", "event_id", "value", step, ([], {}), "recent array<double>, counts map<int, bigint>",
        "recent double, kinds bigint, seen bigint", 12 * HOUR)
    return drain(spark, out).select("user_id", "event_id", "recent", "kinds", "seen")
