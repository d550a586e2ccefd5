"""Order-dependent building blocks that spread one key over many tasks.

A window partitioned by symbol alone puts all rows of a symbol into one task, which
fails as soon as one symbol holds a large part of the data.  Here each key is cut into
slices of its order (see :meth:`Series.slices`).  A window runs inside each
(key, slice); what earlier slices contribute is one small row per (key, slice), folded
over the slices and joined back.

Two branches therefore need the input: the window and the per-slice totals.  Where the input
is only a scan, each branch reads its own columns from the files, and the totals are reduced
before their shuffle.  Where the input already holds a shuffle, both branches read one shuffle
by (key, slice), so that a chain of operators does not recompute what lies before it.  Either
way the join needs neither a shuffle nor a sort of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.core import TMP, Series, col, micros

KINDS = ("sum", "min", "max", "first", "last")


@dataclass(frozen=True)
class Fold:
    """An associative running aggregate: its kind and the expression it folds."""

    kind: str
    value: Column

    def of(self, value: Column) -> "Fold":
        """The same aggregate of another expression."""
        return replace(self, value=value)

    def over(self, w: WindowSpec) -> Column:
        if self.kind in ("first", "last"):
            return getattr(F, self.kind)(self.value, ignorenulls=True).over(w)
        return getattr(F, self.kind)(self.value).over(w)

    def partial(self, order: Column) -> Column:
        """The value of one slice as a group aggregate."""
        if self.kind in ("first", "last"):
            pick = F.min_by if self.kind == "first" else F.max_by
            return pick(self.value, F.when(self.value.isNotNull(), order))  # a NULL position does not count
        return getattr(F, self.kind)(self.value)

    def combine(self, earlier: Column, here: Column) -> Column:
        if self.kind == "sum":
            return F.coalesce(earlier + here, earlier, here)
        if self.kind == "min":
            return F.least(earlier, here)
        if self.kind == "max":
            return F.greatest(earlier, here)
        if self.kind == "last":
            return F.coalesce(here, earlier)
        return F.coalesce(earlier, here)

    def reversed(self) -> "Fold":
        return replace(self, kind={"first": "last", "last": "first"}.get(self.kind, self.kind))

    def positioned(self, order: Column) -> tuple["Fold", str | None]:
        """A fold that needs no order among its rows, and the field that holds its value."""
        if self.kind not in ("first", "last"):
            return self, None
        at = F.when(self.value.isNotNull(), F.struct(order.alias("o"), self.value.alias("v")))
        return Fold("min" if self.kind == "first" else "max", at), "v"


@dataclass(frozen=True)
class Moments:
    """Count, mean and central sums (of squares up to fourth powers) of a number, as one state.

    States are merged pairwise around their own means, so that a large common offset costs no digits, and
    nothing is ever taken back.
    """

    value: Column
    degree: int = 2

    def of(self, value: Column) -> "Moments":
        return replace(self, value=value)

    @property
    def fields(self) -> list[str]:
        return ["n", "mean", "m2", "m3", "m4"][: self.degree + 1]

    @property
    def type(self) -> str:
        return "struct<" + ",".join(f"{f}:double" for f in self.fields) + ">"

    def _state(self, w: WindowSpec | None) -> Column:
        at = (lambda c: c) if w is None else (lambda c: c.over(w))
        x = self.value.cast("double")
        n = at(F.count(x)).cast("double")
        m2 = at(F.var_pop(x)) * n
        parts = [n, at(F.avg(x)), m2]
        if self.degree > 2:  # without spread the shape is undefined, the sums are zero
            parts.append(F.coalesce(at(F.skewness(x)) * F.sqrt(m2 * m2 * m2 / n), m2 * 0))
            parts.append(F.coalesce((at(F.kurtosis(x)) + 3) * m2 * m2 / n, m2 * 0))
        return F.when(n > 0, F.struct(*[p.alias(f) for p, f in zip(parts, self.fields)]))

    def over(self, w: WindowSpec) -> Column:
        return self._state(w)

    def partial(self, order: Column) -> Column:
        return self._state(None)

    def combine(self, a: Column, b: Column) -> Column:
        n, d = a["n"] + b["n"], b["mean"] - a["mean"]
        parts = [n, a["mean"] + d * b["n"] / n, a["m2"] + b["m2"] + d * d * a["n"] * b["n"] / n]
        if self.degree > 2:
            parts.append(
                a["m3"] + b["m3"] + d * d * d * a["n"] * b["n"] * (a["n"] - b["n"]) / (n * n) + 3 * d * (a["n"] * b["m2"] - b["n"] * a["m2"]) / n
            )
            parts.append(
                a["m4"] + b["m4"]
                + d * d * d * d * a["n"] * b["n"] * (a["n"] * a["n"] - a["n"] * b["n"] + b["n"] * b["n"]) / (n * n * n)
                + 6 * d * d * (a["n"] * a["n"] * b["m2"] + b["n"] * b["n"] * a["m2"]) / (n * n)
                + 4 * d * (a["n"] * b["m3"] - b["n"] * a["m3"]) / n
            )
        both = F.struct(*[p.alias(f) for p, f in zip(parts, self.fields)])
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)

    def reversed(self) -> "Moments":
        return self

    def positioned(self, order: Column) -> tuple["Moments", str | None]:
        return self, None


@dataclass(frozen=True)
class Comoments(Moments):
    """Count, means, squares and products of two numbers; ``value`` is a struct of x and y, NULL where one is missing."""

    @property
    def fields(self) -> list[str]:
        return ["n", "x", "y", "xx", "yy", "xy"]

    def _state(self, w: WindowSpec | None) -> Column:
        at = (lambda c: c) if w is None else (lambda c: c.over(w))
        x, y = self.value["x"].cast("double"), self.value["y"].cast("double")
        n = at(F.count(x)).cast("double")
        parts = [n, at(F.avg(x)), at(F.avg(y)), at(F.var_pop(x)) * n, at(F.var_pop(y)) * n, at(F.covar_pop(x, y)) * n]
        return F.when(n > 0, F.struct(*[p.alias(f) for p, f in zip(parts, self.fields)]))

    def combine(self, a: Column, b: Column) -> Column:
        n, dx, dy = a["n"] + b["n"], b["x"] - a["x"], b["y"] - a["y"]
        share = a["n"] * b["n"] / n
        parts = [
            n, a["x"] + dx * b["n"] / n, a["y"] + dy * b["n"] / n, a["xx"] + b["xx"] + dx * dx * share, a["yy"] + b["yy"] + dy * dy * share,
            a["xy"] + b["xy"] + dx * dy * share,
        ]
        both = F.struct(*[p.alias(f) for p, f in zip(parts, self.fields)])
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)


def _merged_before(df: DataFrame, keys: Sequence[Column], order: Sequence[Column], total: str, name: str, f: Moments) -> DataFrame:
    """Add, per slice, the merged states of the slices before it.

    No built-in aggregate merges such states, so they are collected: over runs of 64 slices, the merged runs over 64 runs, and those
    over the key.  No row collects more than 126 states beside one for every 4,096 slices.
    """
    place = f"{name}_place"
    df = df.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)

    def before(c: str, *within: Column) -> Column:
        w = Window.partitionBy(*keys, *within).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
        return F.aggregate(F.collect_list(c).over(w), F.lit(None).cast(f.type), f.combine)

    near, mid, far, run = (f"{name}_{x}" for x in ("near", "mid", "far", "run"))
    df = df.withColumn(near, before(total, F.shiftright(place, 6)))
    df = df.withColumn(run, F.when(F.col(place) % 64 == 63, f.combine(F.col(near), F.col(total))))
    df = df.withColumn(mid, before(run, F.shiftright(place, 12)))
    df = df.withColumn(run, F.when(F.col(place) % 4096 == 4095, f.combine(F.col(mid), F.col(run))))
    df = df.withColumn(far, before(run))
    return df.withColumn(near, f.combine(F.col(mid), F.col(near))).withColumn(name, f.combine(F.col(far), F.col(near))).drop(near, mid, far, run, place)


def _carried(
    totals: DataFrame, keys: Sequence[Column], order: Sequence[Column], folds: Sequence[Fold | Moments], kept: Sequence[str], prefix: str
) -> DataFrame:
    """``kept`` columns of ``totals`` and, per slice, each fold of the slices before it, from its columns total0, total1, ..."""
    earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    names = [f"{prefix}{i}" for i in range(len(folds))]
    out = totals.withColumns({n: f.of(F.col(f"{TMP}total{i}")).over(earlier) for i, (n, f) in enumerate(zip(names, folds)) if isinstance(f, Fold)})
    for i, (n, f) in enumerate(zip(names, folds)):
        if not isinstance(f, Fold):
            out = _merged_before(out, keys, order, f"{TMP}total{i}", n, f)
    return out.select(*kept, *names)


AT = f"{TMP}at"


# Names of plan nodes that a plain scan with filters and projections has none of.
_COSTLY = ("Join", "Aggregate", "Window", "Repartition", "Distinct", "Sort", "MapIn", "FlatMap", "Deduplicate", "Expand")


def _is_scan(df: DataFrame) -> bool:
    """Whether the input is cheap to read twice: files, filters, projections and unions of them."""
    try:
        plan = df._jdf.queryExecution().analyzed().toString()
    except Exception:  # noqa: BLE001  no local plan (Spark Connect): assume the costly case
        return False
    nodes = (line.lstrip(" +-:!").split(" ", 1)[0] for line in plan.splitlines())
    return not any(n.startswith(_COSTLY) or "Join" in n for n in nodes)


def _by_slice(series: Series, by: Sequence[str]) -> tuple[DataFrame, list[str], list[str], bool]:
    """Rows with their (key, slice) as one struct column: never NULL, even for a NULL key."""
    keys = [*series.keys, *[k for k in by if k not in series.keys]]
    slices = series.slices()
    names = [f"{TMP}slice", f"{TMP}slice_seq"][: len(slices)]
    at = F.struct(*[col(k).alias(f"k{i}") for i, k in enumerate(keys)], *[c.alias(n) for n, c in zip(names, slices)])
    df, shared = series.df.withColumn(AT, at), series.sliced and not _is_scan(series.df)
    return df.repartition(AT) if shared else df, [f"k{i}" for i in range(len(keys))], names, shared


def _every_column(df: DataFrame) -> Column:
    return F.xxhash64(*[col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()])


def _rejoin(df: DataFrame, local: DataFrame, carries: DataFrame, shared: bool) -> DataFrame:
    """Give each row the carry of its slice.

    Every row is kept, whatever the other branch saw.  Spark reuses an exchange only between
    identical subplans, so both branches must need the same columns of it: two further
    conditions, which hold for all rows, mention each row's hash and its slice's largest one.
    """
    other, high = f"{TMP}at_", f"{TMP}high"
    carries = carries.withColumnRenamed(AT, other)
    if not shared:
        return local.join(carries, F.col(AT) == F.col(other), "left")
    needed = (F.col(f"{TMP}hash") >= F.lit(-(2**63))) & F.col(high).isNotNull()
    return local.withColumn(f"{TMP}hash", _every_column(df)).join(carries, (F.col(AT) == F.col(other)) & needed, "left")


def running(
    series: Series,
    folds: Mapping[str, Fold | Moments],
    *,
    by: Sequence[str] = (),
    order: Sequence[Column] | None = None,
    exclusive: bool = False,
    peers: bool = False,
    reverse: bool = False,
) -> DataFrame:
    """Add one cumulative column per fold, from the first row of the key up to the current row.

    ``exclusive`` leaves the current row out, ``peers`` includes every row of the same
    timestamp, ``reverse`` runs from the last row backwards.  ``order`` replaces the
    series' own order; its first column must be the time in microseconds.
    """
    df, keys, names, shared = _by_slice(series, by)
    high = [F.max(_every_column(df)).alias(f"{TMP}high")] if shared else []
    order = list(series.order if order is None else order)
    position = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]) if len(order) > 1 else order[0]

    # Folding backwards swaps the ends: the earliest row of the fold is the last of the order.
    ordered = [o.desc() if reverse else o.asc() for o in order]
    w = Window.partitionBy(AT)
    if peers:
        if exclusive:
            raise ValueError("peers and exclusive exclude each other")
        w = w.orderBy(ordered[0]).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        w = w.orderBy(*ordered).rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)

    kept = [c for c in series.df.columns if c not in folds]
    if not series.sliced:
        return df.withColumns({n: f.over(w) for n, f in folds.items()}).select(*[col(c) for c in [*kept, *folds]])

    totals = df.groupBy(AT).agg(
        *high, *[(f.reversed() if reverse else f).partial(position).alias(f"{TMP}total{i}") for i, f in enumerate(folds.values())]
    )
    carries = _carried(
        totals, [F.col(AT)[k] for k in keys], [F.col(AT)[n].desc() if reverse else F.col(AT)[n].asc() for n in names],
        list(folds.values()), [AT, *([f"{TMP}high"] if shared else [])], f"{TMP}carry",
    )
    local = df.withColumns({f"{TMP}here{i}": f.over(w) for i, f in enumerate(folds.values())})
    joined = _rejoin(df, local, carries, shared)
    return joined.select(
        *[col(c) for c in kept],
        *[f.combine(F.col(f"{TMP}carry{i}"), F.col(f"{TMP}here{i}")).alias(n) for i, (n, f) in enumerate(folds.items())],
    )


def window_folds(
    series: Series, width: int, folds: Mapping[str, Fold | Moments], old: Column, *, by: Sequence[str] = (), left_closed: bool = False
) -> DataFrame:
    """Add folds over ``(x - width, x]`` to each row at ``x`` (over ``[x - width, x)`` with ``left_closed``).

    The axis is the series' time in microseconds, or whatever integer ``us_column`` holds.  Rows whose values count are there twice:
    at ``r``, and, marked ``old``, at ``r + width``; rows with NULL values only ask.  The axis is cut into blocks of one width.  A
    window reaches over its own block, from the start to ``x``, and over the end of the block before, which in shifted form lies
    in the same block, from ``x`` on.  So it is a running fold forwards, one backwards, and one merge: linear in the rows, for any
    associative fold, and a value that has left is forgotten.  First and last need :meth:`Fold.positioned`.

    A block wider than the series' slices is cut like any other run of the order.
    """
    x, df = series.us, series.df
    keys = [*series.keys, *[k for k in by if k not in series.keys]]
    cut = series.sliced and width > series.slice_width
    block, piece = f"{TMP}block", f"{TMP}slice"
    parts = [F.floor(x / F.lit(width)).alias(block)]
    if cut:
        at = F.floor(x / F.lit(series.slice_width))
        parts.append((at if series.hot is None else F.when(series.hot.test(), at).otherwise(F.lit(0).cast("long"))).alias(piece))
    df = df.withColumn(AT, F.struct(*[col(k).alias(f"k{i}") for i, k in enumerate(keys)], *parts))
    shared = cut and not _is_scan(series.df)
    df = df.repartition(AT) if shared else df
    near, far = (-1, 0) if left_closed else (0, -1)
    up = Window.partitionBy(AT).orderBy(x.asc()).rangeBetween(Window.unboundedPreceding, near)
    down = Window.partitionBy(AT).orderBy(x.desc()).rangeBetween(Window.unboundedPreceding, far)
    live = [f.of(F.when(~old, f.value)) for f in folds.values()]
    gone = [f.of(F.when(old, f.value)) for f in folds.values()]
    local = df.withColumns(
        {f"{TMP}up{i}": f.over(up) for i, f in enumerate(live)} | {f"{TMP}down{i}": f.over(down) for i, f in enumerate(gone)}
    )
    kept = [col(c) for c in series.df.columns if c not in folds]
    if not cut:
        return local.select(*kept, *[f.combine(F.col(f"{TMP}down{i}"), F.col(f"{TMP}up{i}")).alias(n) for i, (n, f) in enumerate(folds.items())])
    high = [F.max(_every_column(df)).alias(f"{TMP}high")] if shared else []
    k = len(folds)
    totals = df.groupBy(AT).agg(*high, *[f.partial(x).alias(f"{TMP}total{i}") for i, f in enumerate([*live, *gone])])
    group = [F.col(AT)[f"k{i}"] for i in range(len(keys))] + [F.col(AT)[block]]
    names = [AT, *([f"{TMP}high"] if shared else [])]
    back = totals.withColumns({f"{TMP}total{i}": F.col(f"{TMP}total{k + i}") for i in range(k)})
    ahead = _carried(totals, group, [F.col(AT)[piece].asc()], live, names, f"{TMP}before")
    behind = _carried(back, group, [F.col(AT)[piece].desc()], gone, [AT], f"{TMP}after").withColumnRenamed(AT, f"{TMP}at2")
    carries = ahead.join(behind, F.col(AT) == F.col(f"{TMP}at2")).drop(f"{TMP}at2")
    joined = _rejoin(df, local, carries, shared)

    # one merge per projection: nested in one another their expressions would multiply
    older = {f"{TMP}down{i}": f.combine(F.col(f"{TMP}down{i}"), F.col(f"{TMP}after{i}")) for i, f in enumerate(folds.values())}
    newer = {f"{TMP}up{i}": f.combine(F.col(f"{TMP}before{i}"), F.col(f"{TMP}up{i}")) for i, f in enumerate(folds.values())}
    whole = [f.combine(F.col(f"{TMP}down{i}"), F.col(f"{TMP}up{i}")).alias(n) for i, (n, f) in enumerate(folds.items())]
    return joined.withColumns({**older, **newer}).select(*kept, *whole)


def row_number(series: Series, name: str, *, by: Sequence[str] = (), reverse: bool = False) -> DataFrame:
    """1-based position of each row in its key's order."""
    return running(series, {name: Fold("sum", F.lit(1).cast("long"))}, by=by, reverse=reverse)


def shift(
    series: Series, columns: Mapping[str, tuple[Column, int]], *, by: Sequence[str] = (), lead: bool = False
) -> DataFrame:
    """``lag`` (or ``lead``) by a small constant number of rows, across slice borders.

    Each slice hands on at most its ``n`` outermost values, so the carried table holds
    ``n`` values per non-empty slice.
    """
    df, keys, names, shared = _by_slice(series, by)
    high = [F.max(_every_column(df)).alias(f"{TMP}high")] if shared else []
    inputs = {f"{TMP}sh_in{i}": v for i, (v, _) in enumerate(columns.values())}
    far = max(n for _, n in columns.values())

    def directed(c: Column, forward: bool) -> Column:
        return c.asc() if forward else c.desc()

    toward = Window.partitionBy(AT).orderBy(*[directed(o, not lead) for o in series.order])
    kept = [c for c in series.df.columns if c not in columns]
    if not series.sliced:
        moved = {name: F.lag(v, n).over(toward) for name, (v, n) in columns.items()}
        return df.withColumns(moved).select(*[col(c) for c in [*kept, *columns]])

    away = Window.partitionBy(AT).orderBy(*[directed(o, lead) for o in series.order])
    # The rows nearest to the border that the next slice looks across, nearest first.
    rank = f"{TMP}sh_rank"
    ranked = df.withColumns({rank: F.row_number().over(away), **inputs})
    if shared:
        ranked = ranked.withColumn(f"{TMP}high", F.max(_every_column(df)).over(Window.partitionBy(AT)))
    edge = (
        ranked.where(F.col(rank) <= far)
        .groupBy(AT)
        .agg(
            *([F.max(f"{TMP}high").alias(f"{TMP}high")] if shared else []),
            F.sort_array(F.collect_list(F.struct(rank, *inputs))).alias(f"{TMP}sh_edge"),
        )
    )
    nearest = (
        Window.partitionBy(*[F.col(AT)[k] for k in keys])
        .orderBy(*[directed(F.col(AT)[n], not lead) for n in names])
        .rowsBetween(-far, -1)
    )
    # Slices arrive oldest first in the list; reversing puts the nearest slice in front.
    carries = edge.select(
        AT, *([f"{TMP}high"] if shared else []), F.flatten(F.reverse(F.collect_list(f"{TMP}sh_edge").over(nearest))).alias(f"{TMP}sh_carry")
    )
    local = df.withColumns(
        {f"{TMP}sh_rn": F.row_number().over(toward)}
        | {f"{TMP}sh_here{i}": F.lag(v, n).over(toward) for i, (v, n) in enumerate(columns.values())}
    )
    joined = _rejoin(df, local, carries, shared)
    out = {}
    for i, (name, (_, n)) in enumerate(columns.items()):
        reach = F.lit(n) - F.col(f"{TMP}sh_rn") + 1
        across = F.try_element_at(F.col(f"{TMP}sh_carry"), reach)[f"{TMP}sh_in{i}"]
        out[name] = F.when(F.col(f"{TMP}sh_rn") > n, F.col(f"{TMP}sh_here{i}")).when(reach >= 1, across)
    return joined.select(*[col(c) for c in kept], *[c.alias(n) for n, c in out.items()])


# ---------------------------------------------------------------------------
# Order by value
# ---------------------------------------------------------------------------


def value_slice(value: Column, kind: T.DataType, per_octave: int = 4096) -> Column:
    """A slice number that never decreases with the value and needs no statistics.

    Logarithmic cells, so that numbers of every magnitude spread over many slices; NaN is above all numbers.
    Texts go by their first two characters.
    """
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        v = value
        return F.ascii(v).cast("long") * F.lit(1 << 21) + F.ascii(F.substring(v, 2, 1))
    if isinstance(kind, (T.DateType, T.TimestampNTZType, T.TimestampType)):
        value = micros(value.cast("timestamp_ntz"))
    v = value.cast("double")
    cell = F.floor(F.signum(v) * F.log2(F.abs(v) + 1) * per_octave)
    top = F.lit(2**62)
    return F.when(F.isnan(v) | (v == float("inf")), top).when(v == float("-inf"), -top).otherwise(cell)


def distribution(
    df: DataFrame,
    groups: Sequence[str],
    values: Sequence[str],
    descending: Sequence[bool] | None = None,
) -> DataFrame:
    """Per (group, distinct values): the count ``n``, the rows ``before`` it and the group's ``total``.

    Order is lexicographic over ``values``.  Rows are first reduced to distinct values with
    counts.  These are positioned inside slices of the first value, so that no task holds a
    whole group; the per-slice totals that are folded over a group are few, 4096 per power of two.
    """
    desc = list(descending or [False] * len(values))
    s = f"{TMP}vslice"

    def ordered(c: str, d: bool) -> Column:
        return col(c).desc() if d else col(c).asc()

    known = df.where(col(values[0]).isNotNull())
    counts = known.groupBy(*groups, *values).agg(F.count(F.lit(1)).alias("n"))
    by_value = [ordered(v, d) for v, d in zip(values, desc)]
    counts = counts.withColumn(s, value_slice(col(values[0]), counts.schema[values[0]].dataType))
    per_slice = counts.groupBy(*groups, s).agg(F.sum("n").alias(f"{TMP}n"))
    in_order = Window.partitionBy(*groups).orderBy(ordered(s, desc[0])).rowsBetween(Window.unboundedPreceding, -1)
    carries = per_slice.select(
        *[col(g).alias(f"{TMP}g{i}") for i, g in enumerate(groups)],
        F.col(s).alias(f"{TMP}slice_of"),
        F.coalesce(F.sum(f"{TMP}n").over(in_order), F.lit(0)).alias(f"{TMP}carry"),
        F.sum(f"{TMP}n").over(Window.partitionBy(*groups)).alias("total"),
    )
    same = F.col(s) == F.col(f"{TMP}slice_of")
    for i, g in enumerate(groups):  # a group may be NULL
        same = same & col(g).eqNullSafe(F.col(f"{TMP}g{i}"))
    inside = Window.partitionBy(*groups, s).orderBy(*by_value).rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.withColumn(f"{TMP}here", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(carries, same)
        .select(*groups, *values, "n", (F.col(f"{TMP}here") + F.col(f"{TMP}carry")).alias("before"), "total")
    )
