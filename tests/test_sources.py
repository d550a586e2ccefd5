"""Files in and out, and streams against batch results."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import T0, at, values
from tickloom.sources import readers as rd
from tickloom.sources import writers as wr
from tickloom.streaming import stream as ss


def put(tmp_path, text):
    p = tmp_path / "in.csv"
    p.write_text(text)
    return str(p)


def test_csv_titles_name_types(spark, tmp_path):
    path = put(tmp_path, "#byte B,uint U,ulong L,string[5] S\n127,4294967295,18446744073709551615,abc\n")
    s = rd.csv(spark, path, start=T0)
    assert rd.schema_of(s)["L"] == "decimal(20,0)"
    assert [int(x) if i < 3 else x for i, x in enumerate(values(s, "B", "U", "L", "S")[0])] == [127, 4294967295, 18446744073709551615, "abc"]


def test_csv_times_and_converters(spark, tmp_path):
    path = put(tmp_path, 'Time,stock,px,note\n2003/12/01 10:00:00.250,TOP,1.5,"a \\"b\\""\n2003/12/01 09:00:00.000,TSLA,nan,c\n')
    s = rd.csv(spark, path, "Time", "%Y/%m/%d %H:%M:%S.%q", dtype={"px": float.__name__}, converters={"stock": F.lower})
    got = values(s, "ts", "stock", "note")
    assert got == [(datetime(2003, 12, 1, 9), "tsla", "c"), (datetime(2003, 12, 1, 10, 0, 0, 250000), "top", 'a "b"')]


def test_csv_epoch_nanoseconds_and_new_date(spark, tmp_path):
    path = put(tmp_path, "idx,t\n0,1656690986953602371\n")
    s = rd.csv(spark, path, "t", change_date_to="2024-01-05")
    assert values(s, "ts") == [datetime(2024, 1, 5, 15, 56, 26, 953602)]


def test_csv_without_times_counts_milliseconds(spark, tmp_path):
    s = rd.csv(spark, put(tmp_path, "1,a\n2,b\n3,c\n"), first_line_is_title=False, start=T0, auto_increase_us=1000)
    assert values(s, "ts", "COLUMN_1") == [(at(0), "1"), (at(1), "2"), (at(2), "3")]


def test_json(spark, tmp_path):
    p = tmp_path / "in.json"
    p.write_text('{"t": "2003-12-01T00:00:00", "sym": "A", "v": 1.5}\n{"t": "2003-12-01T00:00:01", "sym": "B"}\n')
    s = rd.json_file(spark, str(p), {"t": "nsectime", "sym": "string", "v": "double"}, "t", "sym")
    assert s.keys == ("sym",) and values(s, "sym", "v", order="t") == [("A", 1.5), ("B", None)]


def test_schema_policies(make):
    df = make(A=[1, 2]).df.select("A")
    assert rd.conform(df, {"A": "double", "B": "int"}).schema.simpleString() == "struct<A:double,B:int>"
    with pytest.raises(ValueError):
        rd.conform(df, {"B": "int"}, "fail")
    with pytest.raises(TypeError):
        rd.conform(make(A=["x"]).df, {"A": "int"}, "tolerant")


def test_write_replaces_only_its_days(spark, make, tmp_path):
    path = str(tmp_path / "db")
    s = make(A=[1, 2], offset=[0, 86_400_000])
    wr.write(s, path)
    wr.write(make(A=[9]), path, append=False)
    assert sorted(r["A"] for r in spark.read.parquet(path).collect()) == [2, 9]


def test_write_refuses_ticks_outside(make, tmp_path):
    s = make(A=[1, 2], offset=[0, 10**9])
    with pytest.raises(Exception, match="outside the interval"):
        wr.write(s, str(tmp_path / "a"))
    wr.write(s, str(tmp_path / "b"), out_of_range="ignore")


def test_snapshots_and_text(spark, make, tmp_path):
    s = make(A=[1, 2, 3, 4], G=["x", "y", "x", "x"])
    wr.save_snapshot(s, str(tmp_path / "s"), 2, ["G"])
    back = rd.Series(spark.read.parquet(str(tmp_path / "s")))
    assert values(back, "A") == [2, 3, 4]
    wr.write_text(s.df.select("A", "G"), str(tmp_path / "t"), separator=";", order=["G"])
    assert sorted(spark.read.option("sep", ";").option("header", True).csv(str(tmp_path / "t")).columns) == ["A", "G"]


def test_generated_ticks(spark):
    s = rd.tick(spark, {"X": F.lit(1)}, T0, T0 + timedelta(seconds=3), every_us=1_000_000)
    assert values(s, "ts", "X") == [(at(0), 1), (at(1000), 1), (at(2000), 1)]
    assert rd.empty(spark, {"A": "int"}).df.count() == 0


SCHEMA = "ts timestamp_ntz, seq long, k long, v double, kind string"


@pytest.fixture
def feed(spark, tmp_path):
    """Four files of a shuffled tick stream, and a late sentinel that moves the watermark past them."""
    rows = [(at(1000 * i), i, i % 3, float(i * 7 % 11), "ab"[i % 2]) for i in range(40)]
    batches = [rows[:12] + rows[14:15], rows[12:14] + rows[15:25], rows[25:], [(at(10**6), 99, 0, 0.0, "b")]]
    path = str(tmp_path / "feed")
    for b in batches:
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    live = ss.live(spark, path, T._parse_datatype_string(SCHEMA), "ts", "10 seconds", files_per_trigger=1)
    return rows, live, str(tmp_path)


def drain(df, base):
    out = f"{base}/out"
    ss.run(df, lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}"), f"{base}/state").awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out)


def test_streamed_sliding_sum_equals_batch(feed):
    rows, live, base = feed
    got = drain(ss.sliding_sum(live, ["k"], "ts", "seq", "v", 9_000_000), base).collect()
    want = {r[1]: sum(x[3] for x in rows if x[2] == r[2] and r[0] - timedelta(seconds=9) < x[0] <= r[0]) for r in rows}
    assert {r["seq"]: r["total"] for r in got if r["seq"] != 99} == want


def test_streamed_asof_equals_batch(feed):
    rows, live, base = feed
    out = ss.asof_join_marked(live, ["k"], "ts", "seq", "v", F.col("kind") == "a", F.col("kind") == "b")
    got = {r["seq"]: r["v"] for r in drain(out, base).collect()}
    want = {}
    for r in rows:
        if r[4] == "a":
            before = [x for x in rows if x[4] == "b" and x[2] == r[2] and x[0] <= r[0]]
            want[r[1]] = before[-1][3] if before else None
    assert got == want


def test_streamed_snapshot_keeps_the_latest(spark, feed):
    rows, live, base = feed
    sink = ss.snapshot_sink(f"{base}/snap", ["k"], ["ts", "seq"])
    ss.run(live.select("k", "ts", "seq"), sink, f"{base}/state2").awaitTermination()
    assert sorted((r["k"], r["seq"]) for r in ss.read_snapshot(spark, f"{base}/snap").collect()) == [(0, 99), (1, 37), (2, 38)]


def test_snapshot_batches_rewrite_only_their_buckets(spark, tmp_path):
    path = str(tmp_path / "snap")
    sink = ss.snapshot_sink(path, ["k"], ["seq"], buckets=16)
    first = spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("seq"))
    sink(first, 0)
    one = spark.createDataFrame([(7, 2)], "k long, seq int")
    for batch in (1, 1, 2, 3):  # a repeated batch changes nothing
        sink(one, batch)
    sink(first.limit(0), 4)
    folders = {v: len(list((tmp_path / "snap" / v).glob("snapshot_bucket=*"))) for v in ("v=0", "v=1", "v=2", "v=3", "v=4")}
    assert folders == {"v=0": 15, "v=1": 0, "v=2": 0, "v=3": 1, "v=4": 0}
    got = {r["k"]: r["seq"] for r in ss.read_snapshot(spark, path).collect()}
    assert got == {k: 2 if k == 7 else 1 for k in range(200)}
    with pytest.raises(ValueError, match="no snapshot"):
        ss.read_snapshot(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("policy", ["complain", "use_previous", "use_original", "discard"])
def test_late_ticks_of_a_stream(feed, policy):
    rows, live, base = feed
    step = F.when(F.col("seq") % 6 >= 3, -4).otherwise(0)
    moved = live.withColumn("other", F.timestamp_add("SECOND", step, F.col("ts")))
    out = ss.update_timestamp(moved, ["k"], "ts", "seq", "other", 500_000, policy)
    if policy == "complain":
        with pytest.raises(Exception, match="out of order"):
            drain(out, base)
        return
    got = {r["seq"]: r["other"] for r in drain(out, base).collect() if r["seq"] != 99}
    want, latest = {}, {}
    for ts, n, k, *_ in rows:
        new = ts - timedelta(seconds=4 if n % 6 >= 3 else 0)
        latest[k] = max(new, latest.get(k, new))
        late = latest[k] - new > timedelta(milliseconds=500)
        if not late or policy != "discard":
            want[n] = {"use_previous": latest[k], "use_original": ts}.get(policy, new) if late else new
    assert got == want


def test_collections_in_state_start_anew_after_a_pause(spark, tmp_path):
    times = [0, 1, 2, 10, 11, 40, 41]
    path = str(tmp_path / "feed")
    for part in ([0, 1, 3], [2, 4], [5], [6]):
        spark.createDataFrame([(at(1000 * times[i]), i, 1, float(i), "a") for i in part], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([(at(10**6), 99, 2, 0.0, "b")], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    live = ss.live(spark, path, T._parse_datatype_string(SCHEMA), "ts", "10 seconds", files_per_trigger=1)

    def step(us, value, held, counts):
        held = [*held, value]
        counts = {**counts, "odd" if value % 2 else "even": counts.get("odd" if value % 2 else "even", 0) + 1}
        return (len(held), counts.get("odd", 0)), (held, counts)

    out = ss.keyed_state(
        live, ["k"], "ts", "seq", "v", step, ([], {}), "held array<double>, counts map<string, bigint>", "n bigint, odd bigint", 7_000_000)
    got = {r["seq"]: (r["n"], r["odd"]) for r in drain(out, str(tmp_path)).collect() if r["k"] == 1}
    assert got == {0: (1, 0), 1: (2, 1), 2: (3, 1), 3: (1, 1), 4: (2, 1), 5: (1, 1), 6: (2, 1)}


def test_a_queue_takes_nothing_back():
    rng = np.random.default_rng(3)
    queue, held = ss._Queue([], []), []
    for t in range(400):
        if t == 200:
            queue = ss._Queue(*queue.state())
        v = [1.0, 1e16, float("inf"), 2.0][int(rng.integers(0, 4))] if t < 300 else float(t)
        queue.push(t, v)
        held.append((t, v))
        limit = t - int(rng.integers(1, 30))
        queue.leave(limit)
        held = [x for x in held if x[0] > limit]
        n, total, low, high = queue.read()
        values_ = [v for _, v in held]
        assert (n, low, high) == (len(held), min(values_), max(values_)) and total == pytest.approx(sum(values_))


def test_keys_share_state_rows(spark, tmp_path, monkeypatch):
    """Keys of any type, NULL and NaN among them, keep their own state and values although a few rows of state hold them all."""
    monkeypatch.setattr(ss, "STATE_BUCKETS", 2)
    big, day = 2**53 + 1, T0.date()
    ids = [(big, 1.5, "x", day, at(1), b"\xff"), (None, None, None, None, None, None), (0, 0.0, "", day, at(0), b""), (big, float("nan"), "x", day, at(1), b"\xff"),
           (-big, 1.5, "é", None, at(1), b"\x00")]
    schema = "ts timestamp_ntz, seq long, v double, a long, b double, c string, d date, e timestamp_ntz, f binary"
    rows = [(at(1000 * i), i, float(i), *ids[i % 5]) for i in range(30)]
    path = str(tmp_path / "feed")
    for part in (rows[:9], rows[9:20], rows[20:], [(at(10**6), 99, 0.0, *ids[0])]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    live = ss.live(spark, path, T._parse_datatype_string(schema), "ts", "3 seconds", files_per_trigger=1)
    out = ss.running_state(live, list("abcdef"), "ts", "seq", "v", lambda state, v: state + v, 0.0)
    base, q = f"{tmp_path}/out", None
    q = ss.run(out, lambda b, i: b.write.mode("overwrite").parquet(f"{base}/batch={i}"), f"{tmp_path}/state")
    q.awaitTermination()
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) <= 2
    plain = lambda v: None if v != v else bytes(v) if isinstance(v, bytearray) else v
    got = {r["seq"]: (r["state"], *[plain(r[k]) for k in "abcdef"]) for r in spark.read.schema(out.schema).parquet(base).collect() if r["seq"] != 99}
    assert got == {i: (float(sum(range(i % 5, i + 1, 5))), *[plain(v) for v in ids[i % 5]]) for i in range(30)}
