"""The same analytics on live ticks, with Structured Streaming.

Watermarks bound every state.  Event time must be TIMESTAMP for a watermark, so
:func:`live` converts a TIMESTAMP_NTZ column once, at the source.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickloom.core import TMP, col, from_micros, micros, typed_default


def live(
    spark: SparkSession, path: str, schema: T.StructType, ts: str, delay: str = "0 seconds", fmt: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of ticks from a growing directory; ``delay`` is the accepted disorder."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    df = reader.load(path)
    return df.withColumn(ts, col(ts).cast("timestamp")).withWatermark(ts, delay)


def run(
    df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", available_now: bool = True
):
    """Start a continuous query that hands every finished micro-batch to a function."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def tumbling(df: DataFrame, ts: str, width: str, keys: Sequence[str], aggs: Mapping[str, Column], start: str = "0 seconds") -> DataFrame:
    """Buckets of equal width, final once the watermark passes their end."""
    w = F.window(col(ts), width, width, start)
    out = df.groupBy(w.alias(f"{TMP}w"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(*keys, F.col(f"{TMP}w.end").alias(ts), *aggs)


def hopping(df: DataFrame, ts: str, width: str, hop: str, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Overlapping windows of ``width`` that advance by ``hop``."""
    w = F.window(col(ts), width, hop)
    out = df.groupBy(w.alias(f"{TMP}w"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(*keys, F.col(f"{TMP}w.end").alias(ts), *aggs)


def sessions(df: DataFrame, ts: str, gap: str, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Buckets closed by a pause of at least ``gap``."""
    w = F.session_window(col(ts), gap)
    out = df.groupBy(w.alias(f"{TMP}w"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(*keys, F.col(f"{TMP}w.start").alias("session_start"), F.col(f"{TMP}w.end").alias(ts), *aggs)


def deduplicate(df: DataFrame, columns: Sequence[str], within_watermark: bool = False) -> DataFrame:
    """Keep the first copy of each tick, however late the others come, as in batch.

    The state then holds every distinct value of ``columns``; naming the watermarked time among them lets
    Spark forget values behind the watermark.  ``within_watermark`` bounds the state by the delay
    instead, and copies further apart than the delay all pass.
    """
    return df.dropDuplicatesWithinWatermark(list(columns)) if within_watermark else df.dropDuplicates(list(columns))


def discover_symbols(df: DataFrame, key: str) -> DataFrame:
    """Each symbol once, when it first shows up."""
    return df.select(key).dropDuplicates([key])


def window_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, back: str
) -> DataFrame:
    """Stream-stream join of each left tick with the right ticks of the preceding ``back`` interval."""
    r = right.withColumnsRenamed({k: f"{TMP}{k}" for k in keys})
    on = (col(right_ts) <= col(left_ts)) & (col(right_ts) > col(left_ts) - F.expr(f"INTERVAL {back}"))
    for k in keys:
        on = on & (col(k) == F.col(f"{TMP}{k}"))
    return left.join(r, on).drop(*[f"{TMP}{k}" for k in keys])


def enrich(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stream-static join with a snapshot table."""
    return df.join(table, list(keys), "left")


def snapshot_sink(
    path: str, keys: Sequence[str], order: Sequence[str], num_ticks: int = 1, buckets: int = 64
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that keeps the last ``num_ticks`` ticks per key in a table.

    Keys are hashed into ``buckets``; a batch rewrites only the buckets of its keys, as a new version beside the old ones, so a
    repeated batch gives the same result and a reader never sees half a table.  A version of a bucket is removed once a later batch
    has replaced it and a further batch begins; the number of buckets must stay the same for a table.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        base = path.rstrip("/")
        rows = batch.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        touched = {r[0] for r in rows.select(_BUCKET).distinct().collect()}  # at most ``buckets`` numbers
        newest, replaced = _newest(spark, base, batch_id)
        before = [newest[b] for b in sorted(touched & newest.keys())]
        if before:
            rows = spark.read.option("basePath", base).schema(_partitioned(rows)).parquet(*before).drop("v").unionByName(rows)
        w = Window.partitionBy(_BUCKET, *keys).orderBy(*[col(o).desc() for o in order])
        kept = rows.withColumn(f"{TMP}r", F.row_number().over(w)).where(F.col(f"{TMP}r") <= num_ticks).drop(f"{TMP}r")
        kept.repartition(_BUCKET).write.partitionBy(_BUCKET).mode("overwrite").parquet(f"{base}/v={batch_id}")
        for old in replaced:
            where = spark._jvm.org.apache.hadoop.fs.Path(old)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)

    return upsert


_BUCKET = "snapshot_bucket"


def _partitioned(df: DataFrame) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField("v", T.LongType())])


def _newest(spark: SparkSession, base: str, before: float = float("inf")) -> tuple[dict[int, str], list[str]]:
    """The folder of the newest complete version of each bucket written by batches ``before`` a number, and the older folders."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    newest: dict[int, str] = {}
    replaced: list[str] = []
    if not fs.exists(root):
        return newest, replaced
    versions = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("v=")]
    for version in sorted(versions, key=lambda v: -int(v.getName()[2:])):
        if int(version.getName()[2:]) >= before or not fs.exists(jvm.org.apache.hadoop.fs.Path(version, "_SUCCESS")):
            continue
        for status in fs.listStatus(version):
            name = status.getPath().getName()
            if name.startswith(f"{_BUCKET}="):
                bucket = int(name.split("=")[1])
                if bucket in newest:
                    replaced.append(status.getPath().toString())
                else:
                    newest[bucket] = status.getPath().toString()
    return newest, replaced


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete versions that :func:`snapshot_sink` wrote."""
    base = path.rstrip("/")
    newest, _ = _newest(spark, base)
    if not newest:
        raise ValueError(f"no snapshot in {path}")
    return spark.read.option("basePath", base).parquet(*newest.values()).drop("v", _BUCKET)


# ---------------------------------------------------------------------------
# Keyed state
# ---------------------------------------------------------------------------

_PENDING = "us array<bigint>, side array<int>, seq array<bigint>, value array<double>"

#: Groups of keys that share one state row.  Fixed while a checkpoint is in use.
STATE_BUCKETS = 1024

#: How keys go to Python and back where a state would not give them back as they were.
_CODED = {
    T.TimestampType: (F.unix_micros, F.timestamp_micros), T.TimestampNTZType: (micros, from_micros),
    T.DateType: (F.unix_date, F.date_from_unix_date), T.BinaryType: (F.hex, F.unhex),
}


def _ordered_state(
    df: DataFrame, keys: Sequence[str], ts: str, seq: str, side: Column, value: Column, extra: str,
    step: Callable[[list, tuple], tuple[list, tuple]], initial: tuple, schema: str, expire_us: int | None = None,
) -> DataFrame:
    """Feed each key's ticks to ``step`` in event-time order, holding back what may still be preceded.

    Ticks wait in state until the watermark passes them; ``step`` gets the released ticks as
    (us, side, seq, value) rows with the carried state and returns output rows and new state.
    With ``expire_us`` a key starts anew after a longer pause, and its state goes when the watermark has passed the pause.

    Handing a group over to Python costs milliseconds however few its ticks, so keys are hashed into ``STATE_BUCKETS`` groups.
    """
    keys = list(keys)
    coded = {f.name: _CODED[type(f.dataType)] for f in df.select(*keys).schema.fields if type(f.dataType) in _CODED}
    key_fields = df.select(*[coded[k][0](col(k)).alias(k) if k in coded else col(k) for k in keys]).schema.fields
    # A NULL among integers would make them floats, and NaN differs from itself: both are sent as 0 or '' and a bit of the mask.
    # Both come back as NULL, as pandas has no other NaN.
    sent, mask, nan = [], F.lit(0), len(keys)
    for i, f in enumerate(key_fields):
        k = coded[f.name][0](col(f.name)) if f.name in coded else col(f.name)
        mask = mask + F.when(k.isNull(), 1 << i).otherwise(0)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            mask = mask + F.when(F.isnan(k), 1 << (nan + i)).otherwise(0)
            k, none = F.when(~F.isnan(k), k), F.lit(0).cast(f.dataType)
        else:
            none = typed_default(f.dataType)
        sent.append(F.coalesce(k, none).alias(f"{TMP}k{i}"))
    bucket = F.pmod(F.xxhash64(*[col(k) for k in keys]), F.lit(STATE_BUCKETS)) if keys else F.lit(0)
    rows = df.select(
        bucket.cast("int").alias(f"{TMP}bucket"), *sent, mask.cast("int").alias(f"{TMP}mask"), col(ts), F.unix_micros(col(ts)).alias(f"{TMP}us"),
        side.cast("int").alias(f"{TMP}side"), col(seq).cast("long").alias(f"{TMP}seq"), value.cast("double").alias(f"{TMP}v"),
    )
    out_schema = T.StructType([*key_fields, *T._parse_datatype_string(schema).fields])
    ids = [*[f"{TMP}k{i}" for i in range(len(keys))], f"{TMP}mask"]
    kept = T.StructType([*[rows.schema[n] for n in ids], *T._parse_datatype_string(f"{_PENDING}, last_us bigint{extra}").fields])
    names, width = out_schema.names, len(ids)

    def update(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list] = {}
        for entry in state.get[0] if state.exists else ():
            us, sides, seqs, values, last, *carried = entry[width:]
            held[tuple(entry[:width])] = [list(zip(us, sides, seqs, values)), last, carried]
        for pdf in batches:
            ticks = zip(*[pdf[f"{TMP}{n}"].tolist() for n in ("us", "side", "seq", "v")])
            for key, tick in zip(zip(*[pdf[n].tolist() for n in ids]), ticks):
                held.setdefault(key, [[], None, initial])[0].append(tick)
        limit = state.getCurrentWatermarkMs() * 1000
        out, entries, dues = [], [], []
        for key, (pending, last, carried) in held.items():
            pending.sort(key=lambda r: r[:3])
            ready = [r for r in pending if r[0] <= limit]
            waiting = [r for r in pending if r[0] > limit]
            shown = tuple(None if key[-1] >> i & (1 << nan | 1) else v for i, v in enumerate(key[:-1]))
            run: list[tuple] = []
            for r in ready:
                if expire_us is not None and last is not None and r[0] - last > expire_us:
                    more, _ = step(run, tuple(carried))
                    out += [(*shown, *o) for o in more]
                    run, carried = [], initial
                run.append(r)
                last = int(r[0])
            if run:
                more, carried = step(run, tuple(carried))
                out += [(*shown, *o) for o in more]
            over = expire_us is not None and last is not None and last + expire_us < limit
            if waiting or not over:
                columns = [[int(r[0]) for r in waiting], [int(r[1]) for r in waiting], [int(r[2]) for r in waiting], [float(r[3]) for r in waiting]]
                entries.append((*key, *columns, last, *carried))
                if waiting:
                    dues.append(waiting[0][0])
                elif expire_us is not None and last is not None:
                    dues.append(last + expire_us)
        if entries:
            state.update((entries,))
            if dues:
                state.setTimeoutTimestamp(max(min(dues) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame({n: pd.Series(c, dtype=object) if None in c else list(c) for n, c in zip(names, zip(*out))})

    released = rows.groupBy(f"{TMP}bucket").applyInPandasWithState(
        update, out_schema, T.StructType([T.StructField("entries", T.ArrayType(kept))]), "append", GroupStateTimeout.EventTimeTimeout
    )
    released = released.withColumns({k: back(col(k)) for k, (_, back) in coded.items()})
    return released.withColumn("us", F.timestamp_micros("us").cast("timestamp_ntz")).withColumnRenamed("us", ts)


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, seq: str, value: str) -> DataFrame:
    """Each left tick with the latest right value at or before it, exactly as in batch."""
    a = left.select(*keys, ts, seq).withColumns({value: F.lit(None).cast("double"), f"{TMP}left": F.lit(True)})
    b = right.select(*keys, ts, seq, col(value).cast("double")).withColumn(f"{TMP}left", F.lit(False))
    is_left = F.col(f"{TMP}left")
    return asof_join_marked(a.unionByName(b), keys, ts, seq, value, is_left, ~is_left)


def asof_join_marked(
    df: DataFrame, keys: Sequence[str], ts: str, seq: str, value: str, is_left: Column, is_right: Column
) -> DataFrame:
    """:func:`asof_join` of two kinds of ticks of one stream."""
    both = df.where(is_left | is_right)

    def step(ready: list, carried: tuple) -> tuple[list, tuple]:
        (last,) = carried
        out = []
        for us, side, n, v in ready:
            if side == 0:
                last = float(v)
            else:
                out.append((us, n, last))
        return out, (last,)

    return _ordered_state(
        both, keys, ts, seq, F.when(is_left, 1).otherwise(0), F.when(is_right, col(value)).otherwise(0.0), ", last double",
        step, (None,), f"us bigint, {seq} bigint, {value} double",
    )


class _Queue:
    """Count, sum, least and greatest of a queue of ticks in constant time a tick on average.

    The older block is a stack of the folds of each tick with all after it in the block, the newer one a single fold; so a tick that leaves
    is popped, and nothing is taken back from a sum.
    """

    def __init__(self, times: Sequence[int], values: Sequence[float]):
        self.older: list[tuple] = []
        self.newer: list[tuple] = list(zip(times, values))
        self.fold: tuple | None = None
        self._turn()

    @staticmethod
    def _merge(a: tuple | None, b: tuple | None) -> tuple | None:
        return b if a is None else a if b is None else (a[0] + b[0], a[1] + b[1], min(a[2], b[2]), max(a[3], b[3]))

    def _turn(self) -> None:
        fold = None
        for t, v in reversed(self.newer):
            fold = self._merge((1, v, v, v), fold)
            self.older.append((t, v, fold))
        self.newer, self.fold = [], None

    def push(self, t: int, v: float) -> None:
        self.newer.append((t, v))
        self.fold = self._merge(self.fold, (1, v, v, v))

    def leave(self, limit: int) -> None:
        """Ticks up to ``limit`` leave."""
        while self.older or self.newer:
            if not self.older:
                if self.newer[0][0] > limit:
                    return
                self._turn()
            if self.older[-1][0] > limit:
                return
            self.older.pop()

    def read(self) -> tuple:
        return self._merge(self.older[-1][2] if self.older else None, self.fold) or (0, None, None, None)

    def state(self) -> tuple[list[int], list[float]]:
        ticks = [x[:2] for x in reversed(self.older)] + self.newer
        return [t for t, _ in ticks], [v for _, v in ticks]


_FOLDS = ["n", "total", "low", "high"]


def window_folds_marked(
    df: DataFrame, keys: Sequence[str], ts: str, seq: str, value: str, window_us: int, is_left: Column, is_right: Column
) -> DataFrame:
    """Each left tick with n, total, low and high of ``value`` over the right ticks in ``(t - W, t]``; one row a left tick, no pairs.

    A tick can be both.  Values are not NULL.
    """

    def step(ready: list, carried: tuple) -> tuple[list, tuple]:
        queue, out = _Queue(*carried), []
        asking: list[tuple] = []

        def answer() -> None:
            for us, n in asking:
                queue.leave(us - window_us)
                out.append((us, n, *queue.read()))
            asking.clear()

        for us, side, n, v in ready:
            if side == 0:
                if asking and asking[-1][0] < us:
                    answer()
                queue.push(int(us), float(v))
                queue.leave(us - window_us)
            else:
                asking.append((int(us), n))
        answer()
        return out, queue.state()

    sides = df.where(is_right).withColumn(f"{TMP}asks", F.lit(0)).unionByName(df.where(is_left).withColumn(f"{TMP}asks", F.lit(1)))
    return _ordered_state(
        sides, keys, ts, seq, F.col(f"{TMP}asks"), F.when(F.col(f"{TMP}asks") == 0, col(value)).otherwise(0.0),
        ", times array<bigint>, values array<double>", step, ([], []), f"us bigint, {seq} bigint, n bigint, total double, low double, high double",
    )


def sliding(df: DataFrame, keys: Sequence[str], ts: str, seq: str, value: str, window_us: int) -> DataFrame:
    """Per tick, n, total, low and high over the trailing window ``(t - W, t]``, from the ticks still in it, in order of arrival."""

    def step(ready: list, carried: tuple) -> tuple[list, tuple]:
        queue, out = _Queue(*carried), []
        for us, _, n, v in ready:
            queue.push(int(us), float(v))
            queue.leave(us - window_us)
            out.append((us, n, *queue.read()))
        return out, queue.state()

    return _ordered_state(
        df, keys, ts, seq, F.lit(0), col(value), ", times array<bigint>, values array<double>", step, ([], []),
        f"us bigint, {seq} bigint, n bigint, total double, low double, high double",
    )


def sliding_sum(df: DataFrame, keys: Sequence[str], ts: str, seq: str, value: str, window_us: int) -> DataFrame:
    """The total and n of :func:`sliding`."""
    return sliding(df, keys, ts, seq, value, window_us).drop("low", "high")


def update_timestamp(
    df: DataFrame, keys: Sequence[str], ts: str, seq: str, new_ts: str, max_out_of_order_us: int, out_of_order: str = "complain"
) -> DataFrame:
    """Each tick's alternative time, by the rules of the batch operator, in order of the original times.

    A new time more than ``max_out_of_order_us`` before the latest one of the key so far: ``complain`` stops the stream, ``use_previous``
    gives that latest time, ``use_original`` the tick's old time (and stops if that is as late), ``discard`` leaves the tick out.
    """
    if out_of_order not in ("complain", "use_previous", "use_original", "discard"):
        raise ValueError("out_of_order is 'complain', 'use_previous', 'use_original' or 'discard'")

    def step(ready: list, carried: tuple) -> tuple[list, tuple]:
        (latest,), out = carried, []
        for us, _, n, v in ready:
            new = int(v)
            latest = new if latest is None else max(latest, new)
            if latest - new > max_out_of_order_us:
                if out_of_order == "discard":
                    continue
                new = {"use_previous": latest, "use_original": int(us)}.get(out_of_order)
                if new is None or latest - new > max_out_of_order_us:
                    raise ValueError("tick is too far out of order")
            out.append((us, n, new))
        return out, (latest,)

    moved = _ordered_state(
        df, keys, ts, seq, F.lit(0), F.unix_micros(col(new_ts).cast("timestamp")), ", latest bigint", step, (None,),
        f"us bigint, {seq} bigint, {TMP}new bigint",
    )
    return moved.withColumn(new_ts, F.timestamp_micros(f"{TMP}new").cast("timestamp_ntz")).drop(f"{TMP}new")


def keyed_state(
    df: DataFrame, keys: Sequence[str], ts: str, seq: str, value: str, step: Callable[..., tuple[tuple, tuple]], initial: tuple,
    state: str, output: str, expire_us: int | None = None,
) -> DataFrame:
    """State of any columns (lists and maps too) carried from tick to tick: ``outputs, state = step(us, value, *state)``.

    ``state`` and ``output`` are DDL schemas of what ``step`` takes and gives.  ``expire_us``: a key starts anew after a longer pause and its
    state is removed, so the state does not grow with keys that are gone.
    """

    def steps(ready: list, carried: tuple) -> tuple[list, tuple]:
        out = []
        for us, _, n, v in ready:
            row, carried = step(int(us), float(v), *carried)
            out.append((us, n, *row))
        return out, carried

    return _ordered_state(
        df, keys, ts, seq, F.lit(0), col(value), f", {state}", steps, initial, f"us bigint, {seq} bigint, {output}", expire_us
    )


def running_state(
    df: DataFrame, keys: Sequence[str], ts: str, seq: str, value: str, fn: Callable[[float, float], float], initial: float
) -> DataFrame:
    """A scalar carried from tick to tick: ``state = fn(state, value)``, emitted on every tick."""

    def step(ready: list, carried: tuple) -> tuple[list, tuple]:
        (state,) = carried
        out = []
        for us, _, n, v in ready:
            state = float(fn(state, v))
            out.append((us, n, state))
        return out, (state,)

    return _ordered_state(
        df, keys, ts, seq, F.lit(0), col(value), ", state double", step, (float(initial),),
        f"us bigint, {seq} bigint, state double",
    )
