"""Order and time manipulation: sorting, re-stamping, query-interval changes, sessions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.core import DAY, TMP, Series, col, from_micros, interval, literal_micros, micros
from tickloom.operators.filters import _hhmmssmmm
from tickloom.operators.joins import interval_join
from tickloom.ordering import Fold, running, shift


def sort_keys(df: DataFrame, by: Sequence[str], ascending: bool | Sequence[bool] = True) -> list[Column]:
    """Sort expressions in which NaN is the smallest value of a floating-point column."""
    ups = [ascending] * len(by) if isinstance(ascending, bool) else list(ascending)
    out = []
    for c, up in zip(by, ups):
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            out.append(F.isnan(col(c)).desc() if up else F.isnan(col(c)).asc())
        out.append(col(c).asc() if up else col(c).desc())
    return out


def sort(df: DataFrame, by: str | Sequence[str], ascending: bool | Sequence[bool] = True) -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    return df.orderBy(*sort_keys(df, by, ascending))


def set_time(series: Series, expr: Column) -> Series:
    """Assign a new time; rows re-order by (new time, old arrival)."""
    return series.using(series.df.withColumn(series.ts, expr))


def update_timestamp(
    series: Series,
    field: str,
    max_delay_us: int | None = None,
    out_of_order: str = "complain",
    zero: str = "complain",
    *,
    max_delay_of_original_us: int | None = None,
    max_delay_of_new_us: int | None = None,
    delay_handling: str = "complain",
) -> Series:
    """Take the time from another timestamp field.

    ``zero`` says what an empty field does (``complain``, ``preserve`` keeps the old time);
    ``out_of_order`` what happens when the new time lies more than ``max_delay_us`` before the
    latest new time seen so far: ``complain``, ``use_previous`` (that latest time) or
    ``use_original`` (the tick's old time, an error if that is as late).

    Before that, ``delay_handling`` says what happens to a tick whose old time lies more than ``max_delay_of_original_us`` before the new
    one, or whose new time more than ``max_delay_of_new_us`` before the old one: ``complain``, ``discard``, ``use_original`` (the old time), or
    ``use_new`` (the new time, but not before the latest one so far, nor outside the interval of the series).  Read the ticks of an interval
    longer by these limits first (:func:`modify_query_times`).
    """
    if delay_handling not in ("complain", "discard", "use_original", "use_new"):
        raise ValueError("delay_handling is 'complain', 'discard', 'use_original' or 'use_new'")
    original, new = series.us, micros(field)
    missing = col(field).isNull() | (new == 0)
    if zero == "complain":
        new = F.when(missing, F.raise_error(F.lit(f"{field} is empty")).cast("long")).otherwise(new)
    elif zero == "preserve":
        new = F.when(missing, original).otherwise(new)
    else:
        raise ValueError("zero is 'complain' or 'preserve'")
    df = series.df.withColumn(f"{TMP}new", new)
    new, latest = F.col(f"{TMP}new"), F.col(f"{TMP}max")
    apart = F.lit(False)
    if max_delay_of_original_us is not None:
        apart = apart | (new - original > max_delay_of_original_us)
    if max_delay_of_new_us is not None:
        apart = apart | (original - new > max_delay_of_new_us)
    limited = max_delay_of_original_us is not None or max_delay_of_new_us is not None
    push = limited and delay_handling == "use_new"
    if limited and delay_handling == "discard":
        df = df.where(F.coalesce(~apart, F.lit(True)))
    elif limited and not push:
        instead = original if delay_handling == "use_original" else F.raise_error(F.lit("tick is delayed too much")).cast("long")
        df = df.withColumn(f"{TMP}new", F.when(apart, instead).otherwise(new))
    if push:
        inside = new
        if series.start is not None:
            inside = F.greatest(inside, F.lit(literal_micros(series.start)))
        if series.end is not None:
            inside = F.least(inside, F.lit(literal_micros(series.end)))
        df = df.withColumn(f"{TMP}apart", F.coalesce(apart, F.lit(False))).withColumn(f"{TMP}new", F.when(F.col(f"{TMP}apart"), inside).otherwise(new))
    if push or max_delay_us is not None:
        df = running(series.using(df), {f"{TMP}max": Fold("max", new)})
        if push:
            df = df.withColumn(f"{TMP}new", F.when(F.col(f"{TMP}apart"), latest).otherwise(new)).drop(f"{TMP}apart")
        if max_delay_us is not None:
            stop = F.raise_error(F.lit("tick is too far out of order")).cast("long")
            instead = {
                "complain": stop,
                "use_previous": latest,
                "use_original": F.when(latest - original > max_delay_us, stop).otherwise(original),
            }[out_of_order]
            df = df.withColumn(f"{TMP}new", F.when(latest - new > max_delay_us, instead).otherwise(new))
        df = df.drop(f"{TMP}max")
    dtype = series.df.schema[series.ts].dataType
    return series.using(df.withColumn(series.ts, from_micros(f"{TMP}new").cast(dtype)).drop(f"{TMP}new"))


def modify_query_times(series: Series, start=None, end=None, output_timestamp: Column | None = None) -> Series:
    """Read another interval than the query's, and optionally stamp its ticks anew."""
    out = interval(series, start, end)
    return out if output_timestamp is None else set_time(out, output_timestamp)


def time_interval_shift(series: Series, shift_us: int) -> Series:
    """Read the interval moved by ``shift_us`` and move its ticks back into the query interval."""
    delta = timedelta(microseconds=shift_us)
    moved = interval(series, series.start + delta, series.end + delta)
    df = moved.df.withColumn(series.ts, F.timestamp_add("MICROSECOND", F.lit(-shift_us), col(series.ts)))
    return series.using(df)


def time_interval_change(series: Series, start_change_us: int = 0, end_change_us: int = 0) -> Series:
    """Read a wider (or narrower) interval; ticks outside the query interval move to its edges."""
    wide = interval(
        series,
        series.start + timedelta(microseconds=start_change_us),
        series.end + timedelta(microseconds=end_change_us),
    )
    inside = F.greatest(F.least(micros(series.ts), F.lit(series.end_us)), F.lit(series.start_us))
    return series.using(wide.df.withColumn(series.ts, from_micros(inside)))


def back_to_first_tick(
    series: Series, back_us: int, n: int = 1, where: Column | None = None, keep_timestamp: bool = False
) -> Series:
    """The query interval plus the last ``n`` ticks of each key in ``back_us`` before its start.

    Those ticks are stamped with the start unless ``keep_timestamp``.
    """
    inside = interval(series, series.start, series.end)
    before = interval(series, series.start - timedelta(microseconds=back_us), series.start)
    earlier = before.df if where is None else before.df.where(where)
    rank = f"{TMP}rank"
    w = Window.partitionBy(*series.keys).orderBy(*[o.desc() for o in series.order])
    prior = earlier.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n).drop(rank)
    if not keep_timestamp:
        prior = prior.withColumn(series.ts, F.lit(str(series.start)).cast(series.df.schema[series.ts].dataType))
    return series.using(inside.df.unionByName(prior))


def mkt_activity(series: Series, calendar: DataFrame, begin: str, end: str, flag: str, name: str = "MKT_ACTIVITY") -> Series:
    """Flag each tick with the calendar sessions it falls into, concatenated in order.

    ``calendar`` holds one row per session: begin and end timestamps and a flag text.  Overlapping sessions are first cut into disjoint spans,
    work of the calendar's size; each tick then meets one span at most, in one join.
    """
    sb, se, at, until = f"{TMP}sb", f"{TMP}se", f"{TMP}since", f"{TMP}until"
    sessions = calendar.select(micros(begin).alias(sb), micros(end).alias(se), col(flag).alias(f"{TMP}flag")).where(F.col(se) > F.col(sb))
    borders = sessions.select(F.explode(F.array(sb, se)).alias(at)).distinct()
    axis = Series(borders, ts=at, us_column=at, seq=(), slice_us=30 * DAY)
    spans = axis.using(shift(axis, {until: (F.col(at), 1)}, lead=True).where(F.col(until).isNotNull()))
    hit = interval_join(spans, sessions, F.col(sb), F.col(se), bin_us=DAY, on=())
    flags = hit.groupBy(at, until).agg(F.array_join(F.sort_array(F.collect_set(f"{TMP}flag")), "").alias(name))
    out = interval_join(series, flags, F.col(at), F.col(until), "left", bin_us=DAY, on=()).drop(at, until)
    return series.using(out.withColumn(name, F.coalesce(F.col(name), F.lit(""))))


def apply_times_daily(series: Series, start_time: str, end_time: str) -> Series:
    """The same clock window on every day of the interval."""
    clock = F.pmod(micros(series.ts), F.lit(DAY))
    return series.using(
        series.df.where((clock >= _hhmmssmmm(start_time)) & (clock < _hhmmssmmm(end_time)))
    )
