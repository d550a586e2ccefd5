"""Aggregations over buckets, cumulatively, and over sliding windows.

An aggregate is described once, by associative parts (:class:`Fold`) and a formula over
them.  Bucket mode uses Spark's own grouped aggregate; cumulative mode folds the parts
along the order; sliding mode folds them forwards inside blocks of one window's width and
backwards inside the block before, so a window of any length, in time or in ticks, costs two
rows per tick, and nothing that left a window can spoil a later one.  Windows of few ticks
are plain windows where no key is large.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.core import TMP, Series, col, from_micros
from tickloom.operators import buckets as bk
from tickloom.operators.buckets import BUCKET, Buckets
from tickloom.ordering import Comoments, Fold, Moments, row_number, running, window_folds

Parts = Mapping[str, Column]


@dataclass(frozen=True)
class Agg:
    """``grouped`` builds the aggregate inside ``groupBy``; ``parts``/``finish`` the running form.

    ``empty`` is the value of a bucket without ticks.
    """

    grouped: Callable[[Series], Column]
    parts: Callable[[Series], Mapping[str, Fold | Moments]]
    finish: Callable[[Parts], Column]
    empty: Column | None = None


def _valid(c: str | Column) -> Callable[[Series], Column]:
    """The column with NaN read as missing; other types pass unchanged."""
    e = col(c)

    def typed(s: Series) -> Column:
        schema = s.df.schema
        named = isinstance(c, str) and c in schema.names
        dtype = schema[c].dataType if named else s.df.select(e.alias("c")).schema["c"].dataType
        return F.when(~F.isnan(e), e) if isinstance(dtype, (T.DoubleType, T.FloatType)) else e

    return typed


def count() -> Agg:
    one = lambda s: {"n": Fold("sum", F.lit(1).cast("long"))}
    return Agg(lambda s: F.count(F.lit(1)), one, lambda p: F.coalesce(p["n"], F.lit(0)), F.lit(0).cast("long"))


def sum_(c: str | Column) -> Agg:
    v = _valid(c)
    return Agg(
        lambda s: F.coalesce(F.sum(v(s)), F.lit(0)),
        lambda s: {"s": Fold("sum", v(s))},
        lambda p: F.coalesce(p["s"], F.lit(0)),
        F.lit(0),
    )


def average(c: str | Column) -> Agg:
    v = _valid(c)
    return Agg(
        lambda s: F.avg(v(s)),
        lambda s: {"s": Fold("sum", v(s)), "n": Fold("sum", F.when(v(s).isNotNull(), 1).otherwise(0).cast("long"))},
        lambda p: F.try_divide(p["s"], p["n"]),
        F.lit(None).cast("double"),
    )


mean = average


def _extreme(kind: str, c: str | Column) -> Agg:
    v = _valid(c)
    return Agg(lambda s: getattr(F, kind)(v(s)), lambda s: {"m": Fold(kind, v(s))}, lambda p: p["m"])


def min_(c: str | Column) -> Agg:
    return _extreme("min", c)


def max_(c: str | Column) -> Agg:
    return _extreme("max", c)


def first(c: str | Column, skip_if: Column | None = None) -> Agg:
    """Value of the earliest tick by (time, arrival); ticks where ``skip_if`` holds do not count."""
    return _at_end("first", c, skip_if)


def last(c: str | Column, skip_if: Column | None = None) -> Agg:
    """Value of the latest tick by (time, arrival)."""
    return _at_end("last", c, skip_if)


def _at_end(kind: str, c: str | Column, skip_if: Column | None) -> Agg:
    v = col(c)
    counts = F.lit(True) if skip_if is None else ~F.coalesce(skip_if, F.lit(False))
    pick = F.min_by if kind == "first" else F.max_by
    # Running folds pass over NULL; boxed, a NULL value is a value and only skipped ticks are absent.
    box = F.when(counts, F.struct(v.alias("x")))
    return Agg(
        lambda s: pick(v, s.position if skip_if is None else F.when(counts, s.position)),
        lambda s: {"e": Fold(kind, box)},
        lambda p: p["e"]["x"],
    )


def first_time() -> Agg:
    return Agg(
        lambda s: F.min(col(s.ts)), lambda s: {"t": Fold("min", s.us)}, lambda p: from_micros(p["t"])
    )


def last_time() -> Agg:
    return Agg(
        lambda s: F.max(col(s.ts)), lambda s: {"t": Fold("max", s.us)}, lambda p: from_micros(p["t"])
    )


def _extreme_time(kind: str, c: str | Column, selection: str) -> Agg:
    if selection not in ("first", "last"):
        raise ValueError("selection is 'first' or 'last'")
    v = _valid(c)
    later_wins = (selection == "last") == (kind == "max")
    sign = 1 if later_wins else -1
    packed = lambda s: F.when(v(s).isNotNull(), F.struct(v(s).alias("v"), (s.us * sign).alias("t")))
    return Agg(
        lambda s: from_micros(getattr(F, kind)(packed(s))["t"] * sign),
        lambda s: {"m": Fold(kind, packed(s))},
        lambda p: from_micros(p["m"]["t"] * sign),
    )


def high_time(c: str | Column, selection: str = "first") -> Agg:
    return _extreme_time("max", c, selection)


def low_time(c: str | Column, selection: str = "first") -> Agg:
    return _extreme_time("min", c, selection)


def variance(c: str | Column, biased: bool = True) -> Agg:
    v = _valid(c)
    return Agg(
        lambda s: F.var_pop(v(s)) if biased else F.var_samp(v(s)),
        lambda s: {"m": Moments(v(s))},
        lambda p: F.try_divide(p["m"]["m2"], p["m"]["n"] if biased else p["m"]["n"] - 1),
    )


def stddev(c: str | Column, biased: bool = True) -> Agg:
    v = _valid(c)
    var = variance(c, biased)
    return Agg(
        lambda s: F.stddev_pop(v(s)) if biased else F.stddev_samp(v(s)), var.parts, lambda p: F.sqrt(var.finish(p))
    )


def standardized_moment(c: str | Column, degree: int = 3) -> Agg:
    """E[((x - mean) / sd)^degree] with the population deviation.

    Degrees up to 4 use numerically stable aggregates and merges; others the binomial
    expansion of raw moments, which loses digits where the mean is large against the deviation.
    """
    v = _valid(c)

    def from_central(p: Parts) -> Column:
        m, deviation = p["m"], F.sqrt(p["m"]["m2"] / p["m"]["n"])
        if degree <= 2:
            return F.when(m["m2"] > 0, F.lit(float(degree != 1)))
        return F.try_divide(m[f"m{degree}"] / m["n"], F.pow(deviation, F.lit(degree)))

    def raw(s: Series) -> dict[str, Fold]:
        x = v(s).cast("double")
        powers = {f"x{i}": Fold("sum", F.pow(x, F.lit(i))) for i in range(1, degree + 1)}
        return {"m": Moments(x), "n": Fold("sum", F.when(x.isNotNull(), 1).otherwise(0).cast("long")), **powers}

    def from_raw(p: Parts) -> Column:
        n = p["n"].cast("double")
        mean, total, binomial = p["x1"] / n, F.lit(0.0), 1
        for i in range(degree + 1):
            power = n if i == 0 else p[f"x{i}"]
            total = total + F.lit(float(binomial)) * power / n * F.pow(-mean, F.lit(degree - i))
            binomial = binomial * (degree - i) // (i + 1)
        return F.when(p["n"] > 0, F.try_divide(total, F.pow(F.sqrt(p["m"]["m2"] / n), F.lit(degree))))

    def grouped(s: Series) -> Column:
        if degree == 3:
            return F.skewness(v(s))
        if degree == 4:
            return F.kurtosis(v(s)) + 3
        if degree <= 2:
            return from_central({"m": Moments(v(s)).partial(s.us)})
        return from_raw({n: f.partial(s.us) for n, f in raw(s).items()})

    if degree <= 4:
        return Agg(grouped, lambda s: {"m": Moments(v(s), 4 if degree > 2 else 2)}, from_central)
    return Agg(grouped, raw, from_raw)


def _pair(x: Callable[[Series], Column], y: Callable[[Series], Column]) -> Callable[[Series], dict[str, Moments]]:
    def parts(s: Series) -> dict[str, Moments]:
        known = x(s).isNotNull() & y(s).isNotNull()
        return {"p": Comoments(F.when(known, F.struct(x(s).alias("x"), y(s).alias("y"))))}

    return parts


def correlation(a: str | Column, b: str | Column) -> Agg:
    x, y = _valid(a), _valid(b)
    return Agg(
        lambda s: F.corr(x(s), y(s)), _pair(x, y), lambda p: F.try_divide(p["p"]["xy"], F.sqrt(p["p"]["xx"]) * F.sqrt(p["p"]["yy"]))
    )


def slope(y: str | Column, x: str | Column) -> Agg:
    cx, cy = _valid(x), _valid(y)
    return Agg(lambda s: F.regr_slope(cy(s), cx(s)), _pair(cx, cy), lambda p: F.try_divide(p["p"]["xy"], p["p"]["xx"]))


def intercept(y: str | Column, x: str | Column) -> Agg:
    cx, cy = _valid(x), _valid(y)
    m = slope(y, x)
    return Agg(lambda s: F.regr_intercept(cy(s), cx(s)), _pair(cx, cy), lambda p: p["p"]["y"] - m.finish(p) * p["p"]["x"])


def vwap(price: str | Column, size: str | Column) -> Agg:
    """Price averaged by size."""
    p, q = _valid(price), _valid(size)

    def both(s: Series) -> tuple[Column, Column]:
        known = p(s).isNotNull() & q(s).isNotNull()
        return F.when(known, p(s) * q(s)), F.when(known, q(s))

    return Agg(
        lambda s: F.try_divide(F.sum(both(s)[0]), F.sum(both(s)[1])),
        lambda s: {"pq": Fold("sum", both(s)[0]), "q": Fold("sum", both(s)[1])},
        lambda p: F.try_divide(p["pq"], p["q"]),
    )


# ---------------------------------------------------------------------------
# Modes
# ---------------------------------------------------------------------------


def _name_groups(series: Series, group_by: Sequence[str | Column]) -> tuple[Series, list[str]]:
    names, df = [], series.df
    for i, g in enumerate(group_by):
        if isinstance(g, str):
            names.append(g)
        else:
            names.append(f"GROUP_{i}")
            df = df.withColumn(f"GROUP_{i}", g)
    return series.using(df), names


def agg(
    series: Series,
    aggs: Mapping[str, Agg],
    buckets: Buckets | None = None,
    *,
    group_by: Sequence[str | Column] = (),
    all_fields: str | None = None,
    fill_empty: bool = True,
    groups_to_display: str = "all",
    time_series_type: str = "event_ts",
) -> Series:
    """One row per (key, bucket, group), stamped by the bucket.

    ``time_series_type='state_ts'`` counts the last tick before a bucket as in force at its
    start.

    Empty buckets are produced for every key (and for every group from the bucket it first
    shows up in), unless ``fill_empty`` is off.  ``groups_to_display='event_in_last_bucket'``
    keeps only groups with a tick in the bucket.  ``all_fields`` copies the other fields from
    the ``first`` or ``last`` tick of the bucket, or from its ``high:X`` / ``low:X`` tick.
    """
    b = buckets or Buckets()
    series, groups = _name_groups(series, group_by)
    if groups_to_display not in ("all", "event_in_last_bucket"):
        raise ValueError("groups_to_display is 'all' or 'event_in_last_bucket'")
    assigned = bk.assign(series, b, groups)
    if time_series_type == "state_ts":
        assigned = bk.carry_in(assigned, b, groups)
    elif time_series_type != "event_ts":
        raise ValueError("time_series_type is 'event_ts' or 'state_ts'")
    ids = [*series.keys, *[g for g in groups if g not in series.keys], BUCKET]
    exprs = [a.grouped(assigned).alias(n) for n, a in aggs.items()]
    carried: list[str] = []
    if all_fields:
        carried = [c for c in series.df.columns if c not in ids and c not in aggs and c != series.ts]
        exprs.append(_policy_row(assigned, all_fields, carried).alias(f"{TMP}row"))
    if not b.by_time:
        exprs.append(F.max(col(series.ts)).alias(f"{TMP}last_ts"))
        exprs.append(F.min(col(series.ts)).alias(f"{TMP}first_ts"))
        exprs.append(F.count(F.lit(1)).alias(f"{TMP}n"))
    out = assigned.df.groupBy(*ids).agg(*exprs)
    if b.by_time:
        if fill_empty and groups_to_display == "all":
            out = _with_empty(series, b, out, aggs, groups, ids)
        out = out.withColumn(series.ts, bk.stamp(series, b, F.col(BUCKET)))
    else:
        out = out.withColumn(series.ts, _count_stamp(series, b, ids))
    picked = [F.col(f"{TMP}row")[c].alias(c) for c in carried]
    return series.using(
        out.select(*[c for c in ids if c != BUCKET], series.ts, *picked, *[col(n) for n in aggs]), seq=()
    )


def _policy_row(s: Series, policy: str, fields: Sequence[str]) -> Column:
    row = F.struct(*[col(f).alias(f) for f in fields])
    kind, _, by = policy.partition(":")
    if kind == "first":
        return F.min_by(row, s.position)
    if kind == "last":
        return F.max_by(row, s.position)
    if kind == "high":
        return F.max_by(row, F.struct(col(by), (-s.us).alias("t")))
    if kind == "low":
        return F.min_by(row, F.struct(col(by), s.us.alias("t")))
    raise ValueError(f"unknown tick policy {policy!r}")


def _with_empty(
    series: Series, b: Buckets, out: DataFrame, aggs: Mapping[str, Agg], groups: Sequence[str], ids: Sequence[str]
) -> DataFrame:
    owners_by = [c for c in ids if c != BUCKET]
    out = out.withColumn(f"{TMP}seen", F.lit(True))
    if owners_by:
        owners = out.groupBy(*owners_by).agg(F.min(BUCKET).alias(f"{TMP}since"))
    else:
        owners = out.agg(F.min(BUCKET).alias(f"{TMP}since"))
    every = bk.spine(series, b, owners)
    if groups:
        every = every.where(F.col(BUCKET) >= F.col(f"{TMP}since"))
    joined = every.drop(f"{TMP}since").join(out, [*ids], "left")
    filled = {
        n: F.when(F.col(f"{TMP}seen"), col(n)).otherwise(a.empty.cast(out.schema[n].dataType))
        for n, a in aggs.items()
        if a.empty is not None
    }
    return joined.withColumns(filled) if filled else joined


def _count_stamp(series: Series, b: Buckets, ids: Sequence[str]) -> Column:
    """Tick buckets carry the time of their last tick, flexible ones that of the closing tick."""
    keys = [c for c in ids if c != BUCKET] if b.per_group else [*series.keys]
    in_order = Window.partitionBy(*keys).orderBy(BUCKET) if keys else Window.orderBy(BUCKET)
    if b.stamp == "start":
        return F.col(f"{TMP}first_ts")
    end = from_micros(F.lit(series.end_us))
    if b.unit == "ticks":
        return F.when(F.col(f"{TMP}n") < int(b.size), end).otherwise(F.col(f"{TMP}last_ts"))
    following = F.lead(f"{TMP}first_ts").over(in_order)
    closing = F.col(f"{TMP}last_ts") if b.boundary == "previous" else following
    return F.when(following.isNull(), end).otherwise(closing)


def running_agg(
    series: Series,
    aggs: Mapping[str, Agg],
    window_us: int = 0,
    *,
    ticks: int = 0,
    group_by: Sequence[str | Column] = (),
    emit: str = "both",
) -> Series:
    """Cumulative (no window) or sliding aggregates.

    Cumulative: every input row gains the aggregate of all rows up to it.

    Over the last ``ticks`` rows of the key and group: every input row gains the aggregate of itself and the rows before it.

    Sliding over ``(t - W, t]``; ``emit`` chooses the rows:
      ``both``     one row per arrival or exit time (exits at or after the end are dropped)
      ``arrival``  input rows with all their fields
      ``exit``     one row per input row at ``t + W`` over ``[t, t + W)``, with its fields
    """
    if window_us and ticks:
        raise ValueError("a window is a time or a number of ticks")
    if emit not in ("both", "arrival", "exit"):
        raise ValueError("emit is 'both', 'arrival' or 'exit'")
    series, groups = _name_groups(series, group_by)
    keys = [*series.keys, *[g for g in groups if g not in series.keys]]
    if window_us:
        return _sliding(series, aggs, window_us, keys, emit)
    if 0 < ticks <= FEW_TICKS and not series.sliced:
        folds, finished = _numbered_folds(series, aggs)
        last = Window.partitionBy(*keys).orderBy(*series.order).rowsBetween(1 - ticks, Window.currentRow)
        return _finished(series, series.df.withColumns({n: f.over(last) for n, f in folds.items()}), aggs, finished)
    if ticks:
        axis = f"{TMP}row"
        numbered = series.using(row_number(series, axis, by=groups))
        out = _sliding(numbered, aggs, ticks, keys, "arrival", axis)
        return series.using(out.df.drop(axis))
    folds, finished = _numbered_folds(series, aggs)
    return _finished(series, running(series, folds, by=groups), aggs, finished)


def _numbered_folds(series: Series, aggs: Mapping[str, Agg]) -> tuple[dict[str, Fold | Moments], dict[str, Column]]:
    folds, finished = {}, {}
    for i, (name, a) in enumerate(aggs.items()):
        parts = a.parts(series)
        for p, f in parts.items():
            folds[f"{TMP}p{i}{p}"] = f
        finished[name] = a.finish({p: F.col(f"{TMP}p{i}{p}") for p in parts})
    return folds, finished


def _finished(series: Series, df: DataFrame, aggs: Mapping[str, Agg], finished: Mapping[str, Column]) -> Series:
    kept = [c for c in series.df.columns if c not in aggs]
    return series.using(df.select(*[col(c) for c in kept], *[c.alias(n) for n, c in finished.items()]))


#: Rows in a slice of an axis that counts rows.
ROWS_PER_SLICE = 1_000_000
#: Windows of so many ticks are folded anew for each row where no key is large: one sort of narrow rows, instead of two of each row twice.
FEW_TICKS = 32


def _sliding(series: Series, aggs: Mapping[str, Agg], width: int, keys: Sequence[str], emit: str, axis: str | None = None) -> Series:
    """Every row twice: at its place on the axis (its time, or ``axis``), and one window later, marked old."""
    at, old = f"{TMP}us", f"{TMP}old"
    folds, finished = _numbered_folds(series, aggs)
    placed = {n: f.positioned(series.order_struct) for n, f in folds.items()}
    base = series.df.select("*", (series.us if axis is None else col(axis)).alias(at), *[f.value.alias(n) for n, (f, _) in placed.items()])
    twice = base.withColumn(old, F.explode(F.array(F.lit(False), F.lit(True))))
    twice = twice.withColumn(at, F.col(at) + F.when(F.col(old), F.lit(width)).otherwise(F.lit(0)))
    on_rows = {} if axis is None else {"hot": None, "slice_us": ROWS_PER_SLICE}
    view = replace(series, df=twice, us_column=at, keys=tuple(keys), seq_slice=None, **on_rows)
    read = window_folds(view, width, {n: f.of(F.col(n)) for n, (f, _) in placed.items()}, F.col(old), left_closed=emit == "exit")
    out = read.withColumns({n: F.col(n)[field] for n, (_, field) in placed.items() if field}) if any(f for _, f in placed.values()) else read
    if emit == "arrival":
        return _finished(series, out.where(~F.col(old)), aggs, finished)
    out = out.withColumn(series.ts, from_micros(at)).where(~F.col(old) | (F.col(at) < series.end_us))
    if emit == "exit":
        return _finished(series, out.where(F.col(old)), aggs, finished)
    values = [c.alias(n) for n, c in finished.items()]
    return series.using(out.dropDuplicates([*keys, at]).select(*keys, series.ts, *values), seq=())
