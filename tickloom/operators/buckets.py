"""Time buckets: which bucket a row falls in, how a bucket is stamped, and the empty ones.

Buckets partition ``[start, end)`` from the query start, not from the epoch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.core import DAY, SECOND, TMP, HotKeys, Series, col, from_micros, micros
from tickloom.ordering import Fold, row_number, running, shift

BUCKET = f"{TMP}bucket"


@dataclass(frozen=True)
class Buckets:
    """How to cut the query interval.

    ``unit`` is ``seconds`` (float, at least 1 ms), ``days``, ``months``, ``ticks`` or
    ``flexible`` (``condition`` closes a bucket; ``boundary`` says whether the closing tick
    belongs to the ``new`` or the ``previous`` bucket).  ``zone`` makes day and month
    buckets follow the local calendar when timestamps are UTC.
    """

    size: float = 0
    unit: str = "seconds"
    condition: Column | None = None
    boundary: str = "new"
    per_group: bool = False
    zone: str | None = None
    stamp: str = "end"

    def __post_init__(self) -> None:
        if self.unit not in ("seconds", "days", "months", "ticks", "flexible"):
            raise ValueError(f"unknown bucket unit {self.unit!r}")
        if self.boundary not in ("new", "previous"):
            raise ValueError("boundary is 'new' or 'previous'")
        if self.stamp not in ("start", "end"):
            raise ValueError("stamp is 'start' or 'end'")
        if self.unit == "flexible" and self.condition is None:
            raise ValueError("flexible buckets need a condition")
        if self.unit == "seconds" and 0 < self.size < 0.001:
            raise ValueError("a bucket lasts at least one millisecond")

    @property
    def whole(self) -> bool:
        return self.unit in ("seconds", "days", "months") and self.size == 0

    @property
    def by_time(self) -> bool:
        return self.unit in ("seconds", "days", "months")

    @property
    def width_us(self) -> int:
        return round(self.size * SECOND)


def _local(series: Series, ts: Column, zone: str | None) -> Column:
    return F.from_utc_timestamp(ts, zone).cast("timestamp_ntz") if zone else ts


def assign(series: Series, b: Buckets, groups: Sequence[str] = ()) -> Series:
    """Add the bucket number of each row."""
    df = series.df
    if b.whole:
        return series.using(df.withColumn(BUCKET, F.lit(0).cast("long")))
    if b.unit == "seconds":
        since = series.us - F.lit(series.start_us)
        return series.using(df.withColumn(BUCKET, ((since - F.pmod(since, F.lit(b.width_us))) / b.width_us).cast("long")))
    if b.unit in ("days", "months"):
        begin = F.expr(f"TIMESTAMP_NTZ'{series.start}'")
        here, origin = _local(series, col(series.ts), b.zone), _local(series, begin, b.zone)
        if b.unit == "days":
            whole = F.floor((micros(here) - micros(origin)) / F.lit(DAY * int(b.size)))
        else:
            whole = F.floor(F.floor(F.months_between(here, origin, False)) / F.lit(int(b.size)))
        return series.using(df.withColumn(BUCKET, whole.cast("long")))
    by = [*groups] if b.per_group else []
    if b.unit == "ticks":
        numbered = row_number(series, f"{TMP}rn", by=by)
        number = F.floor((F.col(f"{TMP}rn") - 1) / F.lit(int(b.size))).cast("long")
        return series.using(numbered.withColumn(BUCKET, number).drop(f"{TMP}rn"))
    closes = F.when(F.coalesce(b.condition, F.lit(False)), 1).otherwise(0).cast("long")
    flagged = series.using(df.withColumn(f"{TMP}closes", closes))
    counted = running(flagged, {BUCKET: Fold("sum", F.col(f"{TMP}closes"))}, by=by)
    if b.boundary == "previous":
        counted = counted.withColumn(BUCKET, F.col(BUCKET) - F.col(f"{TMP}closes"))
    return series.using(counted)


def number_at(series: Series, b: Buckets, us: Column) -> Column:
    """The number of the time bucket that holds a time in microseconds."""
    if b.whole:
        return F.lit(0).cast("long")
    if b.unit == "seconds":
        since = us - F.lit(series.start_us)
        return ((since - F.pmod(since, F.lit(b.width_us))) / b.width_us).cast("long")
    here, origin = _local(series, from_micros(us), b.zone), _local(series, F.expr(f"TIMESTAMP_NTZ'{series.start}'"), b.zone)
    if b.unit == "days":
        whole = F.floor((micros(here) - micros(origin)) / F.lit(DAY * int(b.size)))
    else:
        whole = F.floor(F.floor(F.months_between(here, origin, False)) / F.lit(int(b.size)))
    return whole.cast("long")


def edges(assigned: Series, b: Buckets, groups: Sequence[str] = ()) -> DataFrame:
    """Begin and end in microseconds of each bucket of ticks or conditions: columns begin_us, end_us.

    A bucket ends with its last tick, or with the first of the next bucket where the closing tick belongs to that one; the last bucket, unless it is
    closed, ends with the interval.  It begins where the one before ends.  ``groups`` are told apart only where they have buckets of their own.
    """
    ids = [*assigned.keys, *[g for g in groups if b.per_group and g not in assigned.keys]]
    first, last, begin, end = f"{TMP}first", f"{TMP}last", f"{TMP}begin", f"{TMP}end"
    if b.unit == "ticks":
        closed = F.count(F.lit(1)) == int(b.size)
    elif b.boundary == "previous":
        flag = F.coalesce(b.condition, F.lit(False))
        closed = F.max(F.struct(assigned.order_struct.alias("o"), flag.alias("closes")))["closes"]
    else:
        closed = F.lit(False)
    ends = assigned.df.groupBy(*ids, BUCKET).agg(F.min(assigned.us).alias(first), F.max(assigned.us).alias(last), closed.alias(f"{TMP}closed"))
    until = F.lit(assigned.end_us)
    numbered = assigned.using(ends, us_column=BUCKET, ts=BUCKET, seq=(), keys=tuple(ids), slice_us=100_000, hot=_none_hot(assigned))
    if b.unit == "flexible" and b.boundary == "new":
        out = shift(numbered, {end: (F.col(first), 1)}, lead=True).withColumn(begin, F.col(first))
    else:
        numbered = numbered.using(ends.withColumn(end, F.when(F.col(f"{TMP}closed"), F.col(last)).otherwise(until)))
        out = shift(numbered, {begin: (F.col(end), 1)})
    return out.select(*ids, BUCKET, F.coalesce(begin, F.lit(assigned.start_us)).alias("begin_us"), F.coalesce(end, until).alias("end_us"))


def with_last(df: DataFrame, edges: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add the number of the last bucket of each row's key."""
    if keys:
        return df.join(edges.groupBy(*keys).agg(F.max(BUCKET).alias(name)), list(keys))
    one = f"{TMP}one"
    return df.withColumn(one, F.lit(0)).join(edges.groupBy(F.lit(0).alias(one)).agg(F.max(BUCKET).alias(name)), one).drop(one)


def bounds_us(series: Series, b: Buckets, bucket: Column) -> tuple[Column, Column]:
    """Start and end of a numbered time bucket in microseconds; the last one is cut at the end."""
    if b.whole:
        return F.lit(series.start_us), F.lit(series.end_us)
    if b.unit == "seconds":
        begin = F.lit(series.start_us) + bucket * b.width_us
        return begin, F.least(begin + b.width_us, F.lit(series.end_us))
    origin = _local(series, F.expr(f"TIMESTAMP_NTZ'{series.start}'"), b.zone)

    def edge(n: Column) -> Column:
        step = n * int(b.size)
        moved = (
            F.timestamp_add("DAY", step, origin) if b.unit == "days" else F.timestamp_add("MONTH", step, origin)
        )
        return micros(F.to_utc_timestamp(moved, b.zone) if b.zone else moved)

    return edge(bucket), F.least(edge(bucket + 1), F.lit(series.end_us))


def count(series: Series, b: Buckets) -> int:
    """Number of time buckets in the interval."""
    if b.whole:
        return 1
    span = series.end_us - series.start_us
    if b.unit == "seconds":
        return -(-span // b.width_us)
    if b.unit == "days":
        # With a zone, a day may last 23 or 25 hours; one spare bucket is dropped by its start.
        return -(-span // (DAY * int(b.size))) + (1 if b.zone else 0)
    months = 0
    first, last = series.start, series.end
    while _add_months(first, (months) * int(b.size)) < last:
        months += 1
    return months


def _add_months(t, n):
    y, m = divmod(t.month - 1 + n, 12)
    last_day = [31, 29 if (t.year + y) % 4 == 0 and ((t.year + y) % 100 or (t.year + y) % 400 == 0) else 28,
                31, 30, 31, 30, 31, 31, 30, 31, 30, 31][m]
    return t.replace(year=t.year + y, month=m + 1, day=min(t.day, last_day))


def spine(series: Series, b: Buckets, owners: DataFrame) -> DataFrame:
    """Every bucket of the interval for every row of ``owners`` (distinct keys)."""
    n = count(series, b)
    every = owners.withColumn(BUCKET, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    if b.zone:
        every = every.where(bounds_us(series, b, F.col(BUCKET))[0] < F.lit(series.end_us))
    return every


def stamp(series: Series, b: Buckets, bucket: Column) -> Column:
    begin, end = bounds_us(series, b, bucket)
    return from_micros(begin if b.stamp == "start" else end)


def _none_hot(series: Series) -> HotKeys | None:
    """A table with one row per bucket has no large keys: the interval bounds each key alike."""
    return None if not series.keys else HotKeys(series.keys, lambda: ((), None))


def carry_in(assigned: Series, b: Buckets, groups: Sequence[str] = ()) -> Series:
    """State semantics: each bucket also holds the last earlier tick, put at the bucket's start.

    Not added where a tick sits exactly at the start.  One extra row per bucket at most.
    """
    ids = [*assigned.keys, *[g for g in groups if g not in assigned.keys]]
    row = F.struct(*[col(c).alias(c) for c in assigned.df.columns if c != BUCKET])
    position = assigned.order_struct
    ends = assigned.df.groupBy(*ids, BUCKET).agg(
        F.max(F.struct(position.alias("o"), row.alias("r"))).alias(f"{TMP}end"), F.min(assigned.us).alias(f"{TMP}first")
    )
    if b.by_time:
        if ids:
            owners = ends.select(*ids).distinct()
        else:
            owners = ends.agg(F.count(F.lit(1)).alias(f"{TMP}n")).drop(f"{TMP}n")
        ends = spine(assigned, b, owners).join(ends, [*ids, BUCKET], "left")
        begin = bounds_us(assigned, b, F.col(BUCKET))[0]
    else:
        begin = F.lit(None).cast("long")
    # Buckets are ordered by number; the number stands in for the time.
    numbered = assigned.using(ends, us_column=BUCKET, ts=BUCKET, seq=(), keys=tuple(ids), slice_us=100_000, hot=_none_hot(assigned))
    before = running(numbered, {f"{TMP}prev": Fold("last", F.col(f"{TMP}end"))}, exclusive=True)
    needed = F.col(f"{TMP}prev").isNotNull() & (
        F.col(f"{TMP}first").isNull() | begin.isNull() | (F.col(f"{TMP}first") > begin)
    )
    carried = before.where(needed).select(
        BUCKET, begin.alias(f"{TMP}begin"), F.col(f"{TMP}prev.r.*")
    )
    if b.by_time:
        dtype = assigned.df.schema[assigned.ts].dataType
        carried = carried.withColumn(assigned.ts, from_micros(f"{TMP}begin").cast(dtype))
    return assigned.using(assigned.df.unionByName(carried.drop(f"{TMP}begin")))
