"""Aggregations that return whole ticks: first and last, highest and lowest, distinct."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.core import TMP, Series, col, from_micros
from tickloom.operators import buckets as bk
from tickloom.operators.aggregate import ROWS_PER_SLICE
from tickloom.operators.buckets import BUCKET, Buckets
from tickloom.ordering import Fold, row_number, running, shift


def _top(series: Series, b: Buckets | None, groups: Sequence[str], n: int, order: Sequence[Column]) -> Series:
    # row_number() <= n lets Spark keep only n rows per group before the shuffle.
    b = b or Buckets()
    assigned = bk.assign(series, b, groups)
    w = Window.partitionBy(*series.keys, *groups, BUCKET).orderBy(*order)
    picked = assigned.df.withColumn(f"{TMP}rank", F.row_number().over(w)).where(F.col(f"{TMP}rank") <= n)
    return series.using(picked.drop(f"{TMP}rank"))


def _restamp(series: Series, b: Buckets | None, picked: Series, keep_timestamp: bool) -> Series:
    b = b or Buckets()
    df = picked.df
    if not keep_timestamp:
        if not b.by_time:
            raise ValueError("tick-defined buckets keep the ticks' own timestamps")
        df = df.withColumn(series.ts, bk.stamp(series, b, F.col(BUCKET)))
    return series.using(df.drop(BUCKET))


def first_tick(
    series: Series,
    n: int = 1,
    buckets: Buckets | None = None,
    group_by: Sequence[str] = (),
    keep_timestamp: bool = True,
    default: Mapping[str, Column] | None = None,
) -> Series:
    """The first ``n`` ticks of each bucket; ``default`` values stand in for an empty bucket."""
    picked = _top(series, buckets, group_by, n, [o.asc() for o in series.order])
    return _restamp(series, buckets, _with_default(series, buckets, picked, group_by, default), keep_timestamp)


def last_tick(
    series: Series,
    n: int = 1,
    buckets: Buckets | None = None,
    group_by: Sequence[str] = (),
    keep_timestamp: bool = True,
    default: Mapping[str, Column] | None = None,
) -> Series:
    """The last ``n`` ticks of each bucket."""
    picked = _top(series, buckets, group_by, n, [o.desc() for o in series.order])
    return _restamp(series, buckets, _with_default(series, buckets, picked, group_by, default), keep_timestamp)


def _with_default(
    series: Series, b: Buckets | None, picked: Series, groups: Sequence[str], default: Mapping[str, Column] | None
) -> Series:
    if default is None:
        return picked
    b = b or Buckets()
    owners = [*series.keys, *groups]
    every = bk.spine(series, b, series.df.select(*owners).distinct()) if owners else None
    if every is None:
        raise ValueError("defaults for empty buckets need a key or a group")
    seen = picked.df.select(*owners, BUCKET).distinct()
    gaps = every.join(seen, [*owners, BUCKET], "left_anti")
    begin, end = bk.bounds_us(series, b, F.col(BUCKET))
    gaps = gaps.withColumn(series.ts, from_micros(begin if b.stamp == "start" else end)).withColumns(dict(default))
    return series.using(picked.df.unionByName(gaps, allowMissingColumns=True))


def high_tick(
    series: Series, by: str, n: int = 1, buckets: Buckets | None = None, group_by: Sequence[str] = (),
    keep_timestamp: bool = True,
) -> Series:
    """The ``n`` ticks with the highest values of each bucket; earlier ticks win ties."""
    picked = _top(series, buckets, group_by, n, [col(by).desc_nulls_last(), *[o.asc() for o in series.order]])
    return _restamp(series, buckets, picked, keep_timestamp)


def low_tick(
    series: Series, by: str, n: int = 1, buckets: Buckets | None = None, group_by: Sequence[str] = (),
    keep_timestamp: bool = True,
) -> Series:
    """The ``n`` ticks with the lowest values of each bucket; earlier ticks win ties."""
    picked = _top(series, buckets, group_by, n, [col(by).asc_nulls_last(), *[o.asc() for o in series.order]])
    return _restamp(series, buckets, picked, keep_timestamp)


def distinct(
    series: Series, columns: Sequence[str], key_attrs_only: bool = True, buckets: Buckets | None = None
) -> DataFrame:
    """Distinct values per key and bucket; with ``key_attrs_only=False`` the first whole tick of each."""
    assigned = bk.assign(series, buckets or Buckets())
    ids = [*series.keys, BUCKET, *[c for c in columns if c not in series.keys]]
    if key_attrs_only:
        return assigned.df.select(*ids).distinct()
    first = Window.partitionBy(*ids).orderBy(*[o.asc() for o in series.order])
    ranked = assigned.df.withColumn(f"{TMP}rank", F.row_number().over(first))
    return ranked.where(F.col(f"{TMP}rank") <= 1).drop(f"{TMP}rank")


def num_distinct(series: Series, columns: Sequence[str], buckets: Buckets | None = None, name: str = "num_distinct") -> DataFrame:
    """Number of distinct tuples per key and bucket.

    Written as distinct-then-count, so that a bucket's tuples are counted from many tasks.
    """
    assigned = bk.assign(series, buckets or Buckets())
    ids = [*series.keys, BUCKET]
    tuples = assigned.df.select(*ids, *[c for c in columns if c not in ids]).distinct()
    return tuples.groupBy(*ids).agg(F.count(F.lit(1)).alias(name))


def running_num_distinct(series: Series, columns: Sequence[str], name: str = "num_distinct") -> Series:
    """Number of distinct tuples seen so far in each key, on every row."""
    tuple_order = series.using(series.df, keys=(*series.keys, *[c for c in columns if c not in series.keys]))
    firsts = running(tuple_order, {f"{TMP}earlier": Fold("sum", F.lit(1))}, exclusive=True)
    firsts = firsts.withColumn(f"{TMP}new", F.when(F.col(f"{TMP}earlier").isNull(), 1).otherwise(0).cast("long"))
    out = running(series.using(firsts), {name: Fold("sum", F.col(f"{TMP}new"))})
    return series.using(out.drop(f"{TMP}new", f"{TMP}earlier"))


def sliding_num_distinct(
    series: Series, columns: Sequence[str], window_us: int = 0, *, ticks: int = 0, name: str = "num_distinct"
) -> Series:
    """Number of distinct tuples in ``(t - W, t]``, or in the last ``ticks`` rows of the key, on every row.

    A tuple counts from each of its rows on until its next row, or until the window has passed it, whichever comes first.  So
    every row is linked to the next equal tuple, adds one, and takes it away again at that place: two integers per row,
    whatever the window.  NULL is a value.
    """
    if bool(window_us) == bool(ticks):
        raise ValueError("a window is a time or a number of ticks")
    axis, until, step = f"{TMP}axis", f"{TMP}until", f"{TMP}step"
    at = series.using(row_number(series, axis)) if ticks else series.using(series.df.withColumn(axis, series.us))
    tuples = at.using(at.df, keys=(*series.keys, *[c for c in columns if c not in series.keys]))
    linked = shift(tuples, {until: (F.col(axis), 1)}, lead=True)
    linked = linked.withColumn(until, F.least(F.col(until), F.col(axis) + (window_us or ticks)))
    twice = linked.withColumn(step, F.explode(F.array(F.lit(1).cast("long"), F.lit(-1).cast("long"))))
    twice = twice.withColumn(axis, F.when(F.col(step) > 0, F.col(axis)).otherwise(F.col(until)))
    changes = {"hot": None, "slice_us": ROWS_PER_SLICE} if ticks else {"hot": series.hot}
    events = series.using(twice, us_column=axis, seq_slice=None, **changes)
    out = running(events, {name: Fold("sum", F.col(step))}, order=[F.col(axis)], peers=True)
    return series.using(out.where(F.col(step) > 0).drop(axis, until, step))
