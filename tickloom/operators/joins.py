"""Joins: by key, by position, by interval, as-of, and against aggregated windows.

Time-aware joins never pair rows.  Both sides become one stream, and each left row reads
what a running fold has gathered from the right rows before it; :mod:`tickloom.ordering`
spreads a hot key over time slices.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.core import HOUR, TMP, Series, all_of, col, fill_typed, from_micros, typed_default
from tickloom.operators.aggregate import Agg, running_agg
from tickloom.ordering import Fold, Moments, row_number, running, window_folds

US, RANK, ROW, SRC = f"{TMP}us", f"{TMP}rank", f"{TMP}row", f"{TMP}src"


# ---------------------------------------------------------------------------
# Key joins
# ---------------------------------------------------------------------------


def _pairs_all(joined: DataFrame) -> bool:
    """Whether Spark plans the join at the top as a comparison of all pairs."""
    try:
        plan = joined._jdf.queryExecution().sparkPlan().toString()
    except AttributeError:  # no local plan (Spark Connect)
        return False
    return plan.lstrip("*( 0123456789)").startswith(("BroadcastNestedLoopJoin", "CartesianProduct"))


def join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | Column,
    how: str = "inner",
    rprefix: str = "RIGHT",
    typed_defaults: bool = False,
) -> DataFrame:
    """Equi join, or a join on a condition with at least one equality.

    Right columns that clash get ``rprefix_``; equal keys are not repeated.  A condition may
    refer to the right side by its prefixed names.
    """
    if how not in ("inner", "left_outer"):
        raise ValueError("how is 'inner' or 'left_outer'")
    keys = [] if isinstance(on, Column) else list(on)
    clash = [c for c in right.columns if c in left.columns and c not in keys]
    renamed = right.withColumnsRenamed({c: f"{rprefix}_{c}" for c in clash})
    out = left.join(renamed, on, how)
    if isinstance(on, Column) and _pairs_all(out):
        raise ValueError("the condition needs at least one equality between the two sides")
    if typed_defaults and how == "left_outer":
        out = fill_typed(out, [c for c in renamed.columns if c not in keys])
    return out


def join_same_size(left: Series, right: Series, rprefix: str = "RIGHT") -> DataFrame:
    """Pair the rows of two series by position; fails when their sizes differ."""
    n = f"{TMP}n"
    a, b = row_number(left, n), row_number(right, n)
    b = b.drop(right.ts, *right.seq)
    clash = [c for c in b.columns if c in a.columns and c not in (n, *left.keys)]
    b = b.withColumnsRenamed({c: f"{rprefix}_{c}" for c in clash})
    b, a = b.withColumn(f"{TMP}r", F.lit(True)), a.withColumn(f"{TMP}l", F.lit(True))
    both = a.join(b, [*left.keys, n], "full_outer")
    paired = F.col(f"{TMP}l") & F.col(f"{TMP}r")
    checked = F.when(paired, True).otherwise(F.raise_error(F.lit("the series differ in size")).cast("boolean"))
    return both.where(checked).drop(n, f"{TMP}l", f"{TMP}r")


# ---------------------------------------------------------------------------
# One stream from several sources
# ---------------------------------------------------------------------------


def _order_columns(s: Series, depth: int) -> dict[str, Column]:
    named = {f"{TMP}q{i}": col(c).cast("long") for i, c in enumerate(s.seq)}
    return {**{f"{TMP}q{i}": F.lit(0).cast("long") for i in range(depth)}, **named}


def _merged(parts: Sequence[DataFrame], sources: Sequence[Series], keys: Sequence[str], depth: int) -> tuple[Series, list[Column]]:
    """The parts as one series, which is cut where any of the sources is."""
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p, allowMissingColumns=True)
    first = sources[0]
    hot = first.hot
    for other in sources[1:]:
        hot = hot.merge(other.hot, hot.columns) if hot is not None else None
    s = first.using(
        df, us_column=US, ts=US, seq=tuple(f"{TMP}q{i}" for i in range(depth)), keys=tuple(keys), hot=hot,
        slice_us=min(x.slice_us for x in sources), seq_slice=None,
    )
    return s, [F.col(US), F.col(RANK), *[F.col(f"{TMP}q{i}") for i in range(depth)]]


def _against_right(
    left: Series,
    right: Series,
    folds: Mapping[str, Fold],
    enter: Column,
    inclusive: bool = True,
    left_us: Column | None = None,
    reverse: bool = False,
) -> DataFrame:
    """Left rows with running folds of right rows.

    A right row counts from time ``enter`` on.  ``inclusive``: right rows count at equal times.
    """
    depth = max(len(left.seq), len(right.seq), 1)
    keys = list(left.keys)
    rows = left.df.select(
        *keys,
        (left.us if left_us is None else left_us).alias(US),
        F.lit(1 if inclusive != reverse else 0).alias(RANK),
        *[c.alias(n) for n, c in _order_columns(left, depth).items()],
        F.struct(*[col(c) for c in left.df.columns]).alias(ROW),
    )
    base = right.df.select(
        *[col(k).alias(n) for n, k in zip(keys, right.keys)],
        enter.alias(US),
        F.lit(0 if inclusive != reverse else 1).alias(RANK),
        *[c.alias(n) for n, c in _order_columns(right, depth).items()],
        *[f.value.alias(n) for n, f in folds.items()],
    )
    merged, order = _merged([rows, base], [left, right], keys, depth)
    read = running(merged, {f"{n}_": f.of(F.col(n)) for n, f in folds.items()}, order=order, reverse=reverse)
    kept = read.where(F.col(ROW).isNotNull())
    return kept.select(f"{ROW}.*", *[F.col(f"{n}_").alias(n) for n in folds])


# ---------------------------------------------------------------------------
# As-of
# ---------------------------------------------------------------------------

POLICIES = ("arrival_order", "latest_ticks", "each_for_leader_with_first", "each_for_leader_with_latest")


def join_by_time(
    sources: Sequence[Series],
    how: str = "outer",
    on: Sequence[str] | None = None,
    policy: str | None = None,
    leading: int | Sequence[int] | str = 0,
    match_if_identical_times: bool = False,
    arrival: str | None = None,
    typed_defaults: bool = False,
) -> Series:
    """Join every tick of the leading source(s) with the latest tick of each other source.

    Ticks match within the series' keys and the extra ``on`` columns.  At equal times a
    source listed earlier arrives earlier, unless ``arrival`` names a column present in all
    sources that gives the arrival order.  ``policy`` settles equal times otherwise:
    ``latest_ticks`` gives one row per time, ``each_for_leader_with_first`` and
    ``..._latest`` pair every leading tick with the first or last tick of that time.
    """
    policy = policy or ("latest_ticks" if match_if_identical_times else "arrival_order")
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    if how not in ("outer", "inner"):
        raise ValueError("how is 'outer' or 'inner'")
    leaders = list(range(len(sources))) if leading == "all" else [leading] if isinstance(leading, int) else list(leading)
    lead = sources[leaders[0]]
    keys = [*lead.keys, *[c for c in on or () if c not in lead.keys]]
    order_only = {c for s in sources for c in s.seq}
    fields = [
        [c for c in s.df.columns if c not in keys and c != s.ts and (i in leaders or c not in order_only)]
        for i, s in enumerate(sources)
    ]
    if len(leaders) > 1:
        fields = [[c for c in f if c not in order_only] for f in fields]
    names = [c for f in fields for c in f]
    if len(names) != len(set(names)):
        raise ValueError(f"columns present in several sources: {sorted({n for n in names if names.count(n) > 1})}")
    if len(leaders) > 1 and policy.startswith("each_for_leader"):
        raise ValueError("this policy takes one leading source")

    depth = max(max(len(s.seq) for s in sources), 1)
    at_once = policy == "latest_ticks"
    parts = []
    for i, s in enumerate(sources):
        is_lead = i in leaders
        if policy == "arrival_order":
            rank = col(arrival).cast("long") if arrival else F.lit(i).cast("long")
        else:
            rank = F.lit(1 if is_lead else 0).cast("long")
        part = s.df.select(
            *keys,
            s.us.alias(US),
            rank.alias(RANK),
            *[c.alias(n) for n, c in _order_columns(s, depth).items()],
            F.lit(i).alias(SRC),
            F.struct(s.us.alias(US), *[col(c) for c in fields[i]]).alias(f"{TMP}s{i}"),
        )
        if at_once or (policy.startswith("each_for_leader") and not is_lead):
            # One tick per time is all that can match.
            position = F.struct(*[F.col(f"{TMP}q{d}") for d in range(depth)])
            pick = F.min_by if policy.endswith("first") else F.max_by
            part = part.groupBy(*keys, US, RANK, SRC).agg(
                *[pick(c, position).alias(c) for c in (f"{TMP}s{i}", *[f"{TMP}q{d}" for d in range(depth)])]
            )
        parts.append(part)
    merged, order = _merged(parts, [lead, *[s for s in sources if s is not lead]], keys, depth)
    folds = {f"{TMP}l{i}": Fold("last", F.col(f"{TMP}s{i}")) for i in range(len(sources))}
    read = running(merged, folds, order=order, peers=at_once)
    out = read.where(F.col(SRC).isin(leaders))
    if at_once and len(leaders) > 1:
        out = out.dropDuplicates([*keys, US])
    last = {i: F.col(f"{TMP}l{i}") for i in range(len(sources))}
    if match_if_identical_times:
        last = {i: F.when(c[US] == F.col(US), c) for i, c in last.items()}
    if how == "inner":
        out = out.where(all_of([c.isNotNull() for c in last.values()]))
    out = out.select(
        *keys,
        from_micros(US).alias(lead.ts),
        *[last[i][c].alias(c) for i in range(len(sources)) for c in fields[i]],
    )
    if typed_defaults:
        out = fill_typed(out, [c for i in range(len(sources)) if i not in leaders for c in fields[i]])
    seq = tuple(c for c in lead.seq if c in out.columns)
    return lead.using(out, keys=tuple(keys), seq=seq)


def asof(
    left: Series, right: Series, fields: Mapping[str, str], delay_us: int = 0, inclusive: bool = True
) -> Series:
    """Left rows with the latest right values at or before ``t - delay_us`` (before, if not inclusive)."""
    folds = {out: Fold("last", F.struct(col(src).alias("x"))) for out, src in fields.items()}
    df = _against_right(left, right, folds, right.us, inclusive=inclusive, left_us=left.us - delay_us)
    return left.using(df.withColumns({n: F.col(f"`{n}`.x") for n in fields}))


def point_in_time(
    left: Series,
    right: Series,
    offsets: Sequence[int],
    offset_type: str = "time_msec",
    propagate: Sequence[str] = (),
) -> Series:
    """For each left tick and offset, one tick of the right series.

    ``time_msec``: the latest one at or before ``t + offset``.  ``num_ticks``: the one that
    many ticks after the latest at or before ``t``.  Adds TICK_TIME and OFFSET; left ticks
    without a match are dropped.
    """
    fields = [c for c in right.df.columns if c not in right.keys and c != right.ts and c not in right.seq]
    kept = [*left.keys, left.ts, *[c for c in left.seq if c not in left.keys], *propagate]
    slim = left.using(left.df.select(*dict.fromkeys(kept)))
    spread = slim.df.withColumn("OFFSET", F.explode(F.array(*[F.lit(o).cast("long") for o in offsets])))
    tick = F.struct(col(right.ts).alias("TICK_TIME"), *[col(f) for f in fields])
    if offset_type == "time_msec":
        s = slim.using(spread)
        got = _against_right(
            s, right, {f"{TMP}tick": Fold("last", tick)}, right.us, left_us=slim.us + F.col("OFFSET") * 1000
        )
    elif offset_type == "num_ticks":
        n = f"{TMP}n"
        numbered = right.using(row_number(right, n))
        at = _against_right(slim, numbered, {n: Fold("last", F.col(n))}, right.us)
        at = at.withColumn("OFFSET", F.explode(F.array(*[F.lit(o).cast("long") for o in offsets])))
        at = at.withColumn(n, F.coalesce(F.col(n), F.lit(0)) + F.col("OFFSET"))
        targets = numbered.df.select(
            *[col(k).alias(m) for k, m in zip(right.keys, left.keys)], n, tick.alias(f"{TMP}tick")
        )
        got = at.join(targets, [*left.keys, n]).drop(n)
    else:
        raise ValueError("offset_type is 'time_msec' or 'num_ticks'")
    out = got.where(F.col(f"{TMP}tick").isNotNull()).select(
        *left.keys, left.ts, *[c for c in left.seq if c not in left.keys], *propagate,
        *[F.col(f"{TMP}tick")[f].alias(f) for f in [*fields, "TICK_TIME"]], "OFFSET",
    )
    return left.using(out)


# ---------------------------------------------------------------------------
# Windows of another series
# ---------------------------------------------------------------------------


def _agg_folds(right: Series, aggs: Mapping[str, Agg]) -> tuple[dict[str, Fold | Moments], dict[str, Column]]:
    folds, finished = {}, {}
    for i, (name, a) in enumerate(aggs.items()):
        parts = a.parts(right)
        folds.update({f"{TMP}p{i}{p}": f for p, f in parts.items()})
        finished[name] = a.finish({p: F.col(f"{TMP}p{i}{p}") for p in parts})
    return folds, finished


def _finished(left: Series, df: DataFrame, finished: Mapping[str, Column]) -> Series:
    return left.using(df.select(*[col(c) for c in left.df.columns], *[c.alias(n) for n, c in finished.items()]))


def window_join(
    left: Series, right: Series, aggs: Mapping[str, Agg], start_us: int, end_us: int
) -> Series:
    """Per left tick, aggregates of the right ticks in ``[t + start_us, t + end_us)``."""
    folds, finished = _agg_folds(right, aggs)
    return _finished(left, _in_window(left, right, folds, start_us, end_us - 1), finished)


def _in_window(left: Series, right: Series, folds: Mapping[str, Fold | Moments], low: int, high: int) -> DataFrame:
    """Left rows with folds of the right rows at ``t + low <= r <= t + high``."""
    width, keys, old = high - low + 1, list(left.keys), f"{TMP}old"
    depth = max(len(right.seq), 1)
    position = F.struct(right.us.alias("us"), *[c.alias(n) for n, c in _order_columns(right, depth).items()])
    placed = {n: f.positioned(position) for n, f in folds.items()}
    asks = left.df.select(*keys, (left.us + high).alias(US), F.lit(False).alias(old), F.struct(*[col(c) for c in left.df.columns]).alias(ROW))
    base = right.df.select(*[col(k).alias(n) for n, k in zip(keys, right.keys)], right.us.alias(US), *[f.value.alias(n) for n, (f, _) in placed.items()])
    if width < 1:  # an empty window
        base, width = base.where(F.lit(False)), 1
    twice = base.withColumn(old, F.explode(F.array(F.lit(False), F.lit(True))))
    twice = twice.withColumn(US, F.col(US) + F.when(F.col(old), F.lit(width)).otherwise(F.lit(0)))
    merged, _ = _merged([asks, twice], [left, right], keys, 0)
    read = window_folds(merged, width, {n: f.of(F.col(n)) for n, (f, _) in placed.items()}, F.col(old))
    out = {n: F.col(n)[field] if field else F.col(n) for n, (_, field) in placed.items()}
    return read.where(F.col(ROW).isNotNull()).select(f"{ROW}.*", *[c.alias(n) for n, c in out.items()])


def join_with_aggregated_window(
    agg_source: Series,
    pass_source: Series,
    aggs: Mapping[str, Agg],
    boundary: str = "next",
    delay_ms: int = 0,
    window: float = 0,
    unit: str = "seconds",
) -> Series:
    """Per tick of ``pass_source``, aggregates of ``agg_source`` up to its effective time ``t - delay``.

    ``boundary='next'`` leaves out aggregated ticks at exactly that time, ``'previous'``
    takes them in.  ``window=0`` aggregates from the start; otherwise the last ``window``
    seconds or ticks.
    """
    if boundary not in ("next", "previous"):
        raise ValueError("boundary is 'next' or 'previous'")
    inclusive = boundary == "previous"
    folds, finished = _agg_folds(agg_source, aggs)
    at = pass_source.us - delay_ms * 1000
    if not window:
        df = _against_right(pass_source, agg_source, folds, agg_source.us, inclusive=inclusive, left_us=at)
    elif unit == "ticks":
        df = _last_ticks(pass_source, agg_source, folds, int(window), inclusive, at)
    elif unit == "seconds":
        w, d = round(window * 1_000_000), delay_ms * 1000
        low, high = (-w + 1 - d, -d) if inclusive else (-w - d, -1 - d)
        df = _in_window(pass_source, agg_source, folds, low, high)
    else:
        raise ValueError("unit is 'seconds' or 'ticks'")
    return _finished(pass_source, df, finished)


def _last_ticks(
    left: Series, right: Series, folds: Mapping[str, Fold | Moments], n: int, inclusive: bool, at: Column
) -> DataFrame:
    """Folds over the last ``n`` right ticks: windows of n rows on the right first, then read as-of."""
    parts = {name: Agg(lambda s: f.partial(s.us), lambda s, f=f: {"x": f}, lambda p: p["x"]) for name, f in folds.items()}  # noqa: B023
    ready = running_agg(right, parts, ticks=n)
    read = {name: Fold("last", F.struct(F.col(name).alias("x"))) for name in folds}
    df = _against_right(left, ready, read, right.us, inclusive=inclusive, left_us=at)
    return df.withColumns({name: F.col(f"`{name}`.x") for name in folds})


# ---------------------------------------------------------------------------
# Intervals
# ---------------------------------------------------------------------------


#: A level of bins is this many times as wide as the one below it.
FAN_OUT = 16


def interval_join(
    left: Series, right: DataFrame, begin: Column, end: Column, how: str = "inner", bin_us: int = HOUR,
    on: Sequence[str] | None = None, longest_us: int | None = None,
) -> DataFrame:
    """Pairs of left ticks and right rows with ``begin <= t < end`` (microsecond columns of ``right``).

    Both sides meet on (key, level, time bin) in an equi join, so Spark hashes or sorts and splits skewed bins at run time.  Bins of
    level 0 are ``bin_us`` wide, those of each further level 16 times as wide.  A right row lies in the bins of the lowest level of which it spans 16
    at most, so it has up to 17 copies, however long it is; a tick asks once per level.  How many levels there are follows from the longest
    interval: ``longest_us``, or what one pass over ``right`` finds.  For long, non-overlapping intervals use :func:`valid_at`.

    ``how`` is 'inner' or 'left'; a left tick without a match is then kept once, told by its key, time and arrival numbers.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    on = list(left.keys if on is None else on)
    lo, hi, b, level = f"{TMP}b", f"{TMP}e", f"{TMP}bin", f"{TMP}level"
    spans = right.withColumns({lo: begin, hi: end}).where(F.col(hi) > F.col(lo))
    if longest_us is None:
        longest_us = spans.agg(F.max(F.col(hi) - F.col(lo))).first()[0] or 0
    widths = [bin_us]
    while widths[-1] * FAN_OUT < longest_us:
        widths.append(widths[-1] * FAN_OUT)
    own = sum((F.when(F.col(hi) - F.col(lo) > w * FAN_OUT, 1).otherwise(0) for w in widths[:-1]), F.lit(0))
    width = F.element_at(F.array(*[F.lit(w).cast("long") for w in widths]), own + 1)
    bins = F.sequence(F.floor(F.col(lo) / width), F.floor((F.col(hi) - 1) / width))
    spans = spans.withColumn(level, own).withColumn(b, F.explode(bins))
    clash = [c for c in right.columns if c in left.df.columns and c not in on]
    spans = spans.withColumnsRenamed({c: f"RIGHT_{c}" for c in clash})
    rows = left.df.withColumn(US, left.us)
    if len(widths) == 1:
        asks = rows.withColumns({level: F.lit(0), b: F.floor(F.col(US) / F.lit(bin_us))})
    else:
        each = F.array(*[F.struct(F.lit(i).alias("l"), F.floor(left.us / F.lit(w)).alias("b")) for i, w in enumerate(widths)])
        asks = rows.withColumn(b, F.explode(each)).withColumns({level: F.col(b)["l"], b: F.col(b)["b"]})
    inside = (F.col(US) >= F.col(lo)) & (F.col(US) < F.col(hi))
    condition = all_of([asks[k] == spans[k] for k in [*on, level, b]]) & inside
    out = asks.join(spans, condition, how if len(widths) == 1 else "inner")
    for k in [*on, level, b]:
        out = out.drop(spans[k])
    out = out.drop(level, b, lo, hi)
    if how == "left" and len(widths) > 1:
        told = [*left.keys, *[c for c in left.seq if c not in left.keys], US]
        met = out.select(*[col(c).alias(f"{TMP}m{i}") for i, c in enumerate(told)]).distinct()
        alone = rows.join(met, all_of([col(c).eqNullSafe(F.col(f"{TMP}m{i}")) for i, c in enumerate(told)]), "left_anti")
        out = out.unionByName(alone, allowMissingColumns=True)
    return out.drop(US)


def join_with_query(
    left: Series,
    right: Series,
    start_us: int,
    end_us: int,
    *,
    how: str = "outer",
    symbol: Mapping[str, str | Column] | None = None,
    params: Mapping[str, Column] | None = None,
    condition: Callable[[Column, Column], Column] | None = None,
    fields: Mapping[str, Callable[[Column, Column], Column]] | None = None,
    where: Column | None = None,
    prefix: str = "",
    keep_time: str | None = None,
    defaults: Mapping[str, Column] | None = None,
) -> Series:
    """For each left tick, the right ticks in ``[t + start_us, t + end_us)`` of its symbol, one row per pair.

    ``symbol``     right column -> left column or expression; by default the keys of both
    ``params``     named left expressions for ``condition`` and ``fields``, which are called with (params, right tick)
    ``condition``  which of the right ticks belong to the result
    ``fields``     what is taken from a right tick; by default its fields as they are
    ``where``      left ticks for which the right side is looked at; for the others the result is empty
    ``how``        'inner' drops left ticks with an empty result; 'outer' keeps them once, with the ``defaults`` of the
                   fields, else with the default of the type (0, NaN, '', the epoch)
    ``keep_time``  name for the time of the right tick

    Left ticks are told by their key, time and arrival numbers.  For aggregates of the window use :func:`window_join`, which forms no pairs.
    """
    if how not in ("inner", "outer"):
        raise ValueError("how is 'inner' or 'outer'")
    hit, mine, given, lo = f"{TMP}hit", ROW, f"{TMP}params", f"{TMP}lo"
    pairs_by = dict(zip(right.keys, left.keys)) if symbol is None else dict(symbol)
    on = [f"{TMP}s{i}" for i in range(len(pairs_by))]
    names = [c for c in right.df.columns if c not in right.keys and c != right.ts and c not in right.seq]
    asks = left.df.select(
        F.struct(*[col(c) for c in left.df.columns]).alias(mine), F.struct(*[v.alias(k) for k, v in (params or {"none": F.lit(None)}).items()]).alias(given),
        left.us.alias(lo), *[col(v).alias(n) for n, v in zip(on, pairs_by.values())], F.coalesce(F.lit(True) if where is None else where, F.lit(False)).alias(f"{TMP}look"),
    )
    ticks = right.using(
        right.df.select(*[col(k).alias(n) for n, k in zip(on, pairs_by)], right.us.alias(f"{TMP}at"), F.struct(col(right.ts).alias(f"{TMP}time"), *[col(c) for c in right.df.columns if c != right.ts]).alias(hit)),
        ts=f"{TMP}at", us_column=f"{TMP}at", keys=tuple(on), seq=(),
    )
    looking = asks.where(F.col(f"{TMP}look")).drop(f"{TMP}look")
    width = max(end_us - start_us, 1)
    found = interval_join(ticks, looking, F.col(lo) + start_us, F.col(lo) + end_us, "inner", bin_us=width, on=on, longest_us=width)
    if condition is not None:
        found = found.where(condition(F.col(given), F.col(hit)))
    taken = {n: (lambda p, r, n=n: r[n]) for n in names} if fields is None else dict(fields)
    values = {f"{prefix}{n}": f(F.col(given), F.col(hit)) for n, f in taken.items()}
    if keep_time:
        values[keep_time] = F.col(hit)[f"{TMP}time"]
    out = found.select(mine, *[v.alias(n) for n, v in values.items()])
    if how == "outer":
        told = [*left.keys, left.ts, *[c for c in left.seq if c not in left.keys]]
        met = out.select(*[F.col(mine)[c].alias(f"{TMP}m{i}") for i, c in enumerate(told)]).distinct()
        alone = asks.select(mine).join(met, all_of([F.col(mine)[c].eqNullSafe(F.col(f"{TMP}m{i}")) for i, c in enumerate(told)]), "left_anti")
        types = {f.name: f.dataType for f in out.schema.fields}
        instead = {n: (defaults or {}).get(n.removeprefix(prefix) if n != keep_time else n, typed_default(types[n])) for n in values}
        out = out.unionByName(alone.select(mine, *[v.cast(types[n]).alias(n) for n, v in instead.items()]))
    return left.using(out.select(f"{mine}.*", *[col(n) for n in values]))


def valid_at(left: Series, reference: Series, fields: Sequence[str], until: str | None = None) -> Series:
    """Look up dated reference rows: the latest one effective at ``t``, if still valid (``until``)."""
    names = {f: f for f in fields}
    if until:
        names[f"{TMP}until"] = until
    out = asof(left, reference, names)
    if not until:
        return out
    current = col(left.ts) < F.col(f"{TMP}until")
    df = out.df.withColumns({f: F.when(current, col(f)) for f in fields}).drop(f"{TMP}until")
    return left.using(df)


def join_with_collection(
    left: Series,
    collection: DataFrame,
    on: Sequence[str],
    how: str = "left_outer",
    begin: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """Join each tick with the rows of a keyed collection, optionally only those in force at its time."""
    if begin is None or end is None:
        return join(left.df, collection, on, how)
    return interval_join(left, collection, begin, end, "left" if how == "left_outer" else "inner", on=on)


def join_with_snapshot(left: DataFrame, snapshot: DataFrame, on: Sequence[str], how: str = "left_outer") -> DataFrame:
    """Enrich ticks with the kept rows of a snapshot table (batch, or stream against static)."""
    return join(left, snapshot, on, how)
