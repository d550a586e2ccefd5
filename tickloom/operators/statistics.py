"""Order statistics, weighted averages, returns and portfolio prices."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.core import SECOND, TMP, Series, col, from_micros
from tickloom.functions.numeric import divide
from tickloom.operators import buckets as bk
from tickloom.operators.buckets import BUCKET, Buckets
from tickloom.ordering import Fold, distribution, row_number, running, shift


def _bucketed(series: Series, buckets: Buckets | None, group_by: Sequence[str]) -> tuple[Series, list[str]]:
    assigned = bk.assign(series, buckets or Buckets(), group_by)
    return assigned, [*series.keys, *[g for g in group_by if g not in series.keys], BUCKET]


def median(series: Series, c: str, buckets: Buckets | None = None, group_by: Sequence[str] = ()) -> DataFrame:
    """Exact median per bucket; the mean of the two middle values when the count is even."""
    assigned, ids = _bucketed(series, buckets, group_by)
    d = distribution(assigned.df, ids, [c])

    def at(position: Column) -> Column:
        return F.max(F.when((F.col("before") <= position) & (position < F.col("before") + F.col("n")), col(c)))

    low, high = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    return d.groupBy(*ids).agg(((at(low) + at(high)) / 2.0).alias("median"))


class RankTree:
    """The k-th smallest value of any range of rows: a wavelet matrix over the ranks of the values.

    One bit of the rank per level; a range is narrowed level by level to the rows whose rank has the bits found so far, for all
    questions at once.  8 bytes per row and level.
    """

    def __init__(self, values: np.ndarray) -> None:
        self.values, code = np.unique(values, return_inverse=True)
        self.levels = []
        for bit in reversed(range(max(len(self.values) - 1, 0).bit_length())):
            ones = (code >> bit) & 1 == 1
            before = np.concatenate([[0], np.cumsum(~ones)])  # rows without the bit, up to each place
            self.levels.append((bit, before))
            code = np.concatenate([code[~ones], code[ones]])

    def smallest(self, begin: np.ndarray, end: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Values of 0-based rank k in [begin, end), where 0 <= k < end - begin."""
        begin, end, k, code = begin.copy(), end.copy(), k.copy(), np.zeros(len(k), np.int64)
        for bit, before in self.levels:
            low, high, without = before[begin], before[end], before[-1]
            up = k >= high - low
            k -= np.where(up, high - low, 0)
            code |= up.astype(np.int64) << bit
            begin, end = np.where(up, without + begin - low, low), np.where(up, without + end - high, high)
        return self.values[code]


def _whole_groups(
    batches: Iterator[pa.RecordBatch], groups: Sequence[str], f: Callable[[pa.Table, np.ndarray], pa.Table]
) -> Iterator[pa.RecordBatch]:
    """``f`` of many whole groups at once, with the number of each row's group; rows come sorted by group, which may go on in the next batch."""
    parts: list[pa.RecordBatch] = []

    def starts(rows: pa.RecordBatch | pa.Table, before: pa.RecordBatch | None) -> np.ndarray:
        new = np.zeros(rows.num_rows, dtype=bool)
        for g in groups:
            chunks = rows.column(g).chunks if isinstance(rows, pa.Table) else [rows.column(g)]
            if before is not None:
                chunks = [before.column(g).slice(before.num_rows - 1), *chunks]
            code = pa.concat_arrays(chunks).dictionary_encode("encode").indices.to_numpy()
            changed = code[1:] != code[:-1]
            new[len(new) - len(changed) :] |= changed
        return new

    def close() -> Iterator[pa.RecordBatch]:
        if parts:
            table = pa.Table.from_batches(parts)
            yield from f(table, np.cumsum(starts(table, None))).to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = np.flatnonzero(starts(batch, parts[-1] if parts else None))
        if len(cuts):
            cut = int(cuts[-1])
            if cut:
                parts.append(batch.slice(0, cut))
            yield from close()
            parts = [batch.slice(cut)]
        else:
            parts.append(batch)
    yield from close()


def sliding_quantiles(
    series: Series, c: str | Column, quantiles: Mapping[str, float], window_us: int = 0, *, ticks: int = 0, interpolate: bool = True
) -> Series:
    """Quantiles of a number over ``(t - W, t]``, or over the last ``ticks`` rows of the key, on every row.

    ``quantiles`` maps result columns to shares in [0, 1].  Between two values the result is interpolated, or else is the smallest value
    with at least that share of the values at or below it.  NULL and NaN are passed over; a window without values gives NULL.

    The axis is cut into blocks of one window; a block gets a rank tree over its own rows and those of the block before, from which every window
    inside is read, so no frame is gathered.  Small blocks share a tree: a task reads as many at once as an Arrow batch holds, so many short
    keys cost no more than a few long ones.  One task holds the numbers of two windows of a key at a time; the rows themselves are sent once.
    """
    if bool(window_us) == bool(ticks):
        raise ValueError("a window is a time or a number of ticks")
    axis, old, block, value, row = (f"{TMP}{n}" for n in ("axis", "old", "block", "value", "row"))
    width, wanted = window_us or ticks, dict(quantiles)
    df = row_number(series, axis) if ticks else series.df.withColumn(axis, series.us)
    kept = [n for n in series.df.columns if n not in wanted]
    twice = df.withColumn(old, F.explode(F.array(F.lit(False), F.lit(True))))
    v = col(c).cast("double")
    slim = twice.select(
        *[col(k).alias(f"{TMP}k{i}") for i, k in enumerate(series.keys)],
        (F.floor(F.col(axis) / F.lit(width)) + F.col(old).cast("int")).alias(block), F.col(axis), F.col(old), F.when(~F.isnan(v), v).alias(value),
        F.when(~F.col(old), F.struct(*[col(n) for n in kept])).alias(row),
    ).where(~F.col(old) | F.col(value).isNotNull())
    schema = T.StructType([T.StructField(row, slim.schema[row].dataType), *[T.StructField(n, T.DoubleType()) for n in wanted]])

    def read(table: pa.Table, run: np.ndarray) -> pa.Table:
        x, v = table.column(axis).to_numpy(), table.column(value)
        known = np.flatnonzero(v.is_valid().to_numpy())
        live = np.flatnonzero(~table.column(old).to_numpy())
        # places on the axis as small numbers, so that a block and a place make one
        _, place = np.unique(np.concatenate([x[known], x[live] - width, x[live]]), return_inverse=True)
        here = (place.max(initial=0) + 1) * run
        at = here[known] + place[: len(known)]
        order = np.argsort(at, kind="stable")
        places, tree = at[order], RankTree(v.to_numpy()[known[order]])
        begin = np.searchsorted(places, here[live] + place[len(known) : len(known) + len(live)], "right")
        end = np.searchsorted(places, here[live] + place[len(known) + len(live) :], "right")
        some = np.flatnonzero(end > begin)
        b, e = begin[some], end[some]
        out = [table.column(row).take(pa.array(live))]
        for q in wanted.values():
            got = np.full(len(live), np.nan)
            if interpolate:
                at = q * (e - b - 1)
                low = np.floor(at).astype(np.int64)
                below, above = tree.smallest(b, e, low), tree.smallest(b, e, np.minimum(low + 1, e - b - 1))
                between = (at > low) & (above != below)  # also spares equal infinities a subtraction
                below[between] += (above[between] - below[between]) * (at - low)[between]
                got[some] = below
            else:
                got[some] = tree.smallest(b, e, np.maximum(np.ceil(q * (e - b) - 1e-9).astype(np.int64) - 1, 0))
            out.append(pa.array(got, mask=end <= begin))
        return pa.table(out, names=[row, *wanted])

    groups = [f"{TMP}k{i}" for i in range(len(series.keys))] + [block]
    out = slim.repartition(*groups).sortWithinPartitions(*groups).mapInArrow(lambda batches: _whole_groups(batches, groups, read), schema)
    return series.using(out.select(f"`{row}`.*", *[col(n) for n in wanted]))


def sliding_median(series: Series, c: str | Column, window_us: int = 0, *, ticks: int = 0, name: str = "median") -> Series:
    """Median of the window of every row; the mean of the two middle values when their number is even."""
    return sliding_quantiles(series, c, {name: 0.5}, window_us, ticks=ticks)


def percentile(
    series: Series,
    fields: Sequence[str | tuple[str, str]],
    number_of_quantiles: int = 2,
    buckets: Buckets | None = None,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """The ``n - 1`` ``n``-quantile ticks of each bucket, numbered by QUANTILE.

    Ticks are compared on ``fields`` (descending unless given as ``(name, 'asc')``); quantile
    ``k`` is the tick at 0-based position ``floor(k * N / n)``.
    """
    names = [f if isinstance(f, str) else f[0] for f in fields]
    desc = [isinstance(f, str) or f[1] == "desc" for f in fields]
    assigned, ids = _bucketed(series, buckets, group_by)
    d = distribution(assigned.df, ids, names, desc)
    n = number_of_quantiles
    quantiles = d.withColumn("QUANTILE", F.explode(F.sequence(F.lit(1), F.lit(n - 1)))) if n > 1 else d.limit(0)
    position = F.floor(F.col("QUANTILE") * F.col("total") / n)
    hit = (F.col("before") <= position) & (position < F.col("before") + F.col("n"))
    return quantiles.where(hit).select(*ids, *names, F.col("QUANTILE").cast("long").alias("QUANTILE"))


def find_value_for_percentile(
    series: Series,
    c: str,
    p: float,
    show: str = "nearest",
    buckets: Buckets | None = None,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """The value whose percentile rank, ``100 * (below + equal / 2) / N``, answers ``p``.

    ``nearest`` takes the closest rank, ``first_value_with_ge_percentile`` the first rank not
    below ``p``, ``interpolated_value`` interpolates between the ranks around ``p``.
    """
    assigned, ids = _bucketed(series, buckets, group_by)
    d = distribution(assigned.df, ids, [c])
    d = d.withColumn(f"{TMP}pr", (F.col("before") + F.col("n") / 2.0) / F.col("total") * 100.0)
    pr, v = F.col(f"{TMP}pr"), col(c)
    if show == "nearest":
        best = F.min(F.struct(F.abs(pr - p).alias("gap"), v.alias("v")))["v"]
        return d.groupBy(*ids).agg(best.alias("value"))
    lowest_ge = F.min(F.when(pr >= p, F.struct(pr.alias("pr"), v.alias("v"))))
    if show == "first_value_with_ge_percentile":
        return d.groupBy(*ids).agg(F.coalesce(lowest_ge["v"], F.max(v)).alias("value"))
    if show != "interpolated_value":
        raise ValueError(f"unknown mode {show!r}")
    highest_le = F.max(F.when(pr <= p, F.struct(pr.alias("pr"), v.alias("v"))))
    around = d.groupBy(*ids).agg(highest_le.alias("a"), lowest_ge.alias("b"))
    share = F.try_divide(F.lit(float(p)) - F.col("a.pr"), F.col("b.pr") - F.col("a.pr"))
    between = F.col("a.v") + (F.col("b.v") - F.col("a.v")) * F.coalesce(share, F.lit(0.0))
    return around.select(*ids, F.coalesce(between, F.col("a.v"), F.col("b.v")).cast("double").alias("value"))


def ranking(
    series: Series,
    rank_by: Sequence[str | tuple[str, str]],
    show_rank_as: str = "order",
    include_tick: bool = False,
    buckets: Buckets | None = None,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Add RANKING: the position in the sort order (default descending), or a percentage.

    Equal ticks share the position of the first of them.
    """
    names = [f if isinstance(f, str) else f[0] for f in rank_by]
    desc = [isinstance(f, str) or f[1] == "desc" for f in rank_by]
    assigned, ids = _bucketed(series, buckets, group_by)
    d = distribution(assigned.df, ids, names, desc)
    n, before, total = F.col("n"), F.col("before"), F.col("total")
    after = total - before - n
    others = total if include_tick else total - 1
    rank = {
        "order": (before + 1).cast("long"),
        "percent_lt_values": F.try_divide(after * 100.0, others),
        "percent_le_values": F.try_divide((after + n) * 100.0, total),
        "percentile_standard": F.try_divide((after + (n if include_tick else n - 1) / 2.0) * 100.0, others),
    }[show_rank_as]
    ranks = d.select(*ids, *names, rank.alias("RANKING"))
    return assigned.df.join(ranks, [*ids, *names], "left").drop(BUCKET)


# ---------------------------------------------------------------------------
# Weights by time or by position
# ---------------------------------------------------------------------------


def _holding_intervals(series: Series, c: str, b: Buckets, state: bool, group_by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The time each value is in force in its group, cut at bucket edges: columns from_us, to_us, value and the bucket's bucket_end.

    A bucket with ticks has a piece, if only one without length.
    """
    groups = [g for g in group_by if g not in series.keys]
    ids = [*series.keys, *groups]
    source = series if b.by_time else bk.assign(series, b, groups)
    wanted = {f"{TMP}next": (series.us, 1)}
    if not b.by_time:
        wanted[f"{TMP}next_bucket"] = (F.col(BUCKET), 1)
    nxt = shift(source, wanted, by=groups, lead=True)
    held = nxt.select(
        *ids,
        *([] if b.by_time else [BUCKET, f"{TMP}next_bucket"]),
        series.us.alias(f"{TMP}from"),
        F.least(F.coalesce(F.col(f"{TMP}next"), F.lit(series.end_us)), F.lit(series.end_us)).alias(f"{TMP}to"),
        col(c).alias("value"),
    )
    if b.by_time:
        held = held.where(F.col(f"{TMP}to") > F.col(f"{TMP}from"))
        first = bk.number_at(series, b, F.col(f"{TMP}from"))
        last = bk.number_at(series, b, F.col(f"{TMP}to") - 1) if state else first
        cut = held.withColumn(BUCKET, F.explode(F.sequence(first, last)))
        begin, end = bk.bounds_us(series, b, F.col(BUCKET))
    else:
        shared = [k for k in ids if b.per_group or k in series.keys]
        # A group without a next tick is in force to the last bucket of its key.
        edges = bk.edges(source, b, groups)
        if state:
            held = bk.with_last(held, edges, shared, f"{TMP}final")
            last = F.coalesce(f"{TMP}next_bucket", f"{TMP}final")
        else:
            last = F.col(BUCKET)
        cut = held.withColumn(BUCKET, F.explode(F.sequence(F.col(BUCKET), last))).join(edges, [*shared, BUCKET])
        begin, end = F.col("begin_us"), F.col("end_us")
    # A value held over many buckets touches each once, so this adds at most one row per bucket.
    start = F.greatest(F.col(f"{TMP}from"), begin)
    return cut.select(*ids, BUCKET, "value", start.alias("from_us"), F.greatest(F.least(F.col(f"{TMP}to"), end), start).alias("to_us"), end.alias("bucket_end")), ids


def tw_average(
    series: Series, c: str, buckets: Buckets | None = None, time_series_type: str = "state_ts", group_by: Sequence[str] = ()
) -> DataFrame:
    """Average weighted by how long each value stays in force, per bucket of any unit and per group.

    ``state_ts`` lets the last value before a bucket hold until its first tick; ``event_ts`` looks only at ticks inside the bucket.  A bucket of ticks
    lasts from the last tick of the bucket before to its own last tick (see :func:`~tickloom.operators.buckets.edges`); one without
    length gives NULL.
    """
    b = buckets or Buckets()
    held, ids = _holding_intervals(series, c, b, time_series_type == "state_ts", group_by)
    weight = (F.col("to_us") - F.col("from_us")).cast("double")
    return held.groupBy(*ids, BUCKET).agg(
        F.try_divide(F.sum(F.col("value") * weight), F.sum(weight)).alias("tw_average")
    )


def _rate(decay: float, decay_value_type: str) -> float:
    if decay_value_type == "lambda":
        return float(decay)
    if decay_value_type == "half_life_index":
        return math.log(2) / float(decay)
    raise ValueError("decay_value_type is 'lambda' or 'half_life_index'")


def exp_tw_average(
    series: Series, c: str, decay: float, buckets: Buckets | None = None, decay_value_type: str = "half_life_index", group_by: Sequence[str] = ()
) -> DataFrame:
    """Time-weighted average whose weights fall off as ``exp(-rate * seconds before the bucket end)``; buckets as in :func:`tw_average`."""
    b = buckets or Buckets()
    rate = _rate(decay, decay_value_type)
    held, ids = _holding_intervals(series, c, b, True, group_by)

    def weight_at(us: str) -> Column:
        return F.exp((F.col(us) - F.col("bucket_end")) / float(SECOND) * rate)

    weight = (weight_at("to_us") - weight_at("from_us")) / rate
    return held.groupBy(*ids, BUCKET).agg(
        F.try_divide(F.sum(F.col("value") * weight), F.sum(weight)).alias("exp_tw_average")
    )


def exp_w_average(
    series: Series,
    c: str,
    decay: float,
    buckets: Buckets | None = None,
    decay_value_type: str = "half_life_index",
    time_series_type: str = "state_ts",
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Average with weights ``exp(-rate * N)``, N ticks before the newest tick of the bucket and group.

    ``state_ts`` lets the last tick before the bucket take part as its oldest.
    """
    rate = _rate(decay, decay_value_type)
    assigned, ids = _bucketed(series, buckets, group_by)
    groups = [g for g in group_by if g not in series.keys]
    if time_series_type == "state_ts":
        assigned = bk.carry_in(assigned, buckets or Buckets(), groups)
    aged = running(assigned, {f"{TMP}age": Fold("sum", F.lit(1).cast("long"))}, by=[*groups, BUCKET], reverse=True)
    weight = F.exp((F.col(f"{TMP}age") - 1) * -rate)
    return aged.groupBy(*ids).agg(
        F.try_divide(F.sum(col(c) * weight), F.sum(weight)).alias("exp_w_average")
    )


# ---------------------------------------------------------------------------
# Prices over buckets
# ---------------------------------------------------------------------------


def _price_per_bucket(series: Series, fields: Sequence[str], b: Buckets) -> Series:
    """Last values of each bucket of the spine, carried over empty buckets."""
    assigned = bk.assign(series, b)
    ids = [*series.keys, BUCKET]
    row = F.struct(series.order_struct.alias("o"), *[col(f) for f in fields])
    ends = assigned.df.groupBy(*ids).agg(F.max(row).alias(f"{TMP}last"), F.min(row).alias(f"{TMP}first"))
    if series.keys:
        owners = ends.select(*series.keys).distinct()
    else:
        owners = ends.agg(F.count(F.lit(1)).alias(f"{TMP}n")).drop(f"{TMP}n")
    every = bk.spine(series, b, owners).join(ends, ids, "left")
    begin, end = bk.bounds_us(series, b, F.col(BUCKET))
    every = every.withColumns({f"{TMP}begin": begin, series.ts: from_micros(begin)})
    return series.using(every, seq=())


def return_ep(series: Series, price: str = "PRICE", buckets: Buckets | None = None) -> Series:
    """End price of each bucket over its start price.

    The start price is the tick at the very start of the bucket, else the previous end
    price; the first bucket with ticks starts at its first tick.  A return on a price of 0 is infinite.  Needs ``start`` and ``end``.
    """
    b = buckets or Buckets()
    priced = _price_per_bucket(series, [price], b)
    box = F.when(F.col(f"{TMP}last").isNotNull(), F.struct(F.col(f"{TMP}last")[price].alias("p")))
    carried = running(priced, {f"{TMP}prev": Fold("last", box)}, exclusive=True)
    end_price = F.coalesce(F.col(f"{TMP}last")[price], F.col(f"{TMP}prev.p"))
    at_start = F.col(f"{TMP}first.o.us") == F.col(f"{TMP}begin")
    start_price = F.when(at_start, F.col(f"{TMP}first")[price]).otherwise(
        F.coalesce(F.col(f"{TMP}prev.p"), F.col(f"{TMP}first")[price])
    )
    out = carried.select(*series.keys, BUCKET, divide(end_price, start_price).alias("return"))
    return series.using(
        out.withColumn(series.ts, bk.stamp(series, b, F.col(BUCKET))).drop(BUCKET), seq=()
    )


def _weighted(value: Column, weight: Column, side: str, weight_type: str) -> tuple[Column, Column]:
    keep = {"both": F.lit(True), "long": weight > 0, "short": weight < 0}[side]
    total = F.sum(F.when(keep, value * weight))
    if weight_type == "relative":
        total = F.try_divide(total, F.sum(F.when(keep, F.abs(weight))))
    elif weight_type != "absolute":
        raise ValueError("weight_type is 'absolute' or 'relative'")
    return total, F.count(F.when(keep & value.isNotNull(), 1))


def portfolio_price(
    series: Series,
    price: str = "PRICE",
    weight: str | None = None,
    side: str = "both",
    weight_type: str = "absolute",
    buckets: Buckets | None = None,
) -> DataFrame:
    """Per bucket, the weighted sum over symbols of their latest prices, and NUM_SYMBOLS."""
    b = buckets or Buckets()
    latest = _latest_prices(series, [price, *([weight] if weight else [])], b)
    w = _latest(weight) if weight else F.lit(1)
    value, n = _weighted(_latest(price), w, side, weight_type)
    return latest.groupBy(BUCKET).agg(value.cast("double").alias("VALUE"), n.alias("NUM_SYMBOLS"))


def _latest(name: str) -> Column:
    return F.col(f"{TMP}now.{name}")


def _latest_prices(series: Series, fields: Sequence[str], b: Buckets) -> DataFrame:
    priced = _price_per_bucket(series, fields, b)
    now = running(priced, {f"{TMP}now": Fold("last", F.col(f"{TMP}last"))})
    return now.where(F.col(f"{TMP}now").isNotNull())


def multi_portfolio_price(
    series: Series,
    portfolios: DataFrame,
    price: str = "PRICE",
    side: str = "both",
    weight_type: str = "absolute",
    buckets: Buckets | None = None,
    weight: str = "WEIGHT",
    multiplier: str | None = None,
    portfolio: str = "PORTFOLIO_NAME",
) -> DataFrame:
    """:func:`portfolio_price` for many portfolios given as (key columns, portfolio, weight) rows."""
    b = buckets or Buckets()
    latest = _latest_prices(series, [price], b).select(*series.keys, BUCKET, _latest(price).alias(f"{TMP}price"))
    held = latest.join(portfolios, [*series.keys])
    worth = F.col(f"{TMP}price") * (col(multiplier) if multiplier else F.lit(1))
    value, n = _weighted(worth, col(weight), side, weight_type)
    return held.groupBy(BUCKET, portfolio).agg(value.cast("double").alias("VALUE"), n.alias("NUM_SYMBOLS"))


def partition_evenly_into_groups(
    series: Series, field: str, weight: str, number_of_groups: int, buckets: Buckets | None = None, *, heaviest: int = 64
) -> DataFrame:
    """Assign each distinct value of a bucket to one of ``k`` groups of nearly equal weight.

    Ticks are summed per value first.  The ``heaviest * k`` values of most weight (ties by value) go, largest first, each to the lightest
    group.  The others fill the groups up to one level: laid end to end on the axis of summed weight, in the order of a hash, a value
    belongs to the group that lacks the weight at its middle.  So only ``heaviest * k`` values of a bucket meet in one task, and a group
    misses the level by at most the weight of one light value, unless its heavy ones alone exceed the level.  A NULL weight counts as
    0; a sum below 0 is an error.
    """
    k, n = number_of_groups, number_of_groups * heaviest
    if k < 1 or heaviest < 1:
        raise ValueError("number_of_groups and heaviest are positive numbers")
    assigned, ids = _bucketed(series, buckets, ())
    w, cell, name, heavy = (f"{TMP}{x}" for x in ("w", "cell", "name", "heavy"))
    total = F.coalesce(F.sum(weight).cast("double"), F.lit(0.0))
    sums = assigned.df.groupBy(*ids, field).agg(F.when(total >= 0, total).otherwise(F.raise_error(F.lit("a weight is negative")).cast("double")).alias(w))
    sums = sums.withColumn(name, F.md5(F.coalesce(col(field).cast("string"), F.lit(""))))
    sums = sums.withColumns({cell: F.substring(name, 1, 3), heavy: F.struct(-F.col(w), col(field).alias("value"))})

    def same(right: dict[str, str]) -> Column:
        out = F.lit(True)
        for c, r in right.items():  # a key may be NULL
            out = out & F.col(c).eqNullSafe(F.col(r))
        return out

    def renamed(df: DataFrame, mark: str, also: Sequence[str] = ()) -> tuple[DataFrame, Column, list[str]]:
        names = {c: f"{TMP}{mark}{i}" for i, c in enumerate([*ids, *also])}
        return df.withColumnsRenamed(names), same(names), list(names.values())

    # the heaviest of each part of a bucket, then of the bucket
    top = sums
    for part in ([*ids, cell], ids):
        place = F.row_number().over(Window.partitionBy(*part).orderBy(heavy))
        top = top.withColumn(f"{TMP}place", place).where(F.col(f"{TMP}place") <= n).drop(f"{TMP}place")

    def fill(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(f"{TMP}place")
        loads, groups = [(0.0, g) for g in range(k)], []
        for x in rows[w].to_pylist():
            load, g = loads[0]
            heapq.heapreplace(loads, (load + x, g))
            groups.append(g)
        held = [load for load, _ in sorted(loads, key=lambda x: x[1])]
        out = rows.select([*ids, field]).append_column("GROUP_ID", pa.array(groups, pa.int64()))
        return out.append_column("loads", pa.array([held, *[None] * (len(groups) - 1)], pa.list_(pa.float64())))

    greedy = top.select(*ids, field, w, F.row_number().over(Window.partitionBy(*ids).orderBy(heavy)).alias(f"{TMP}place"))
    fields = [T.StructField(f.name, f.dataType) for f in greedy.select(*ids, field).schema]
    schema = T.StructType([*fields, T.StructField("GROUP_ID", T.LongType()), T.StructField("loads", T.ArrayType(T.DoubleType()))])
    greedy = greedy.groupBy(*ids).applyInArrow(fill, schema)

    # the others: more weight of their part before them, of the parts before it, and what each group lacks
    last, at, gone = renamed(top.groupBy(*ids).agg(F.max(heavy).alias(f"{TMP}last")), "l")
    light = sums.join(last, at).where(F.col(heavy) > F.col(f"{TMP}last")).drop(*gone, f"{TMP}last")
    parts = light.groupBy(*ids, cell).agg(F.sum(w).alias(f"{TMP}part"))
    earlier = Window.partitionBy(*ids).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *ids, cell, F.coalesce(F.sum(f"{TMP}part").over(earlier), F.lit(0.0)).alias(f"{TMP}carry"), F.sum(f"{TMP}part").over(Window.partitionBy(*ids)).alias(f"{TMP}all")
    )
    held, at, gone = renamed(greedy.where("loads IS NOT NULL").select(*ids, "loads"), "h")
    level = F.array_min(
        F.transform(
            F.sequence(F.lit(1), F.lit(k)),
            lambda m: (F.col(f"{TMP}all") + F.aggregate(F.slice(F.array_sort("loads"), 1, m), F.lit(0.0), lambda a, x: a + x)) / m,
        )
    )
    lacking = F.transform("loads", lambda x: F.greatest(F.col(f"{TMP}level") - x, F.lit(0.0)))
    ends = F.transform(F.sequence(F.lit(1), F.lit(k)), lambda m: F.aggregate(F.slice(lacking, 1, m), F.lit(0.0), lambda a, x: a + x))
    parts = parts.join(held, at).withColumn(f"{TMP}level", level).select(*ids, cell, f"{TMP}carry", ends.alias(f"{TMP}ends"))
    parts, at, gone = renamed(parts, "p", [cell])
    before = Window.partitionBy(*ids, cell).orderBy(name, field).rowsBetween(Window.unboundedPreceding, -1)
    light = light.withColumn(f"{TMP}before", F.coalesce(F.sum(w).over(before), F.lit(0.0))).join(parts, at)
    middle = F.col(f"{TMP}carry") + F.col(f"{TMP}before") + F.col(w) / 2
    group = F.least(F.size(F.filter(f"{TMP}ends", lambda e: e <= middle)), F.lit(k - 1)).cast("long")
    return greedy.drop("loads").unionByName(light.select(*ids, field, group.alias("GROUP_ID")))


def cut(df: DataFrame, c: str, bins: int | Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Bin a column by ``bins`` equal widths or by explicit edges; bins are closed on the right."""
    if isinstance(bins, int):
        ends = df.agg(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi"))
        lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
        edges = [lo + (hi - lo) * (i / bins) for i in range(bins)] + [hi]
        names = list(labels) if labels else [f"bin{i}" for i in range(bins)]
    else:
        edges = [F.lit(float(b)) for b in bins]
        names = list(labels) if labels else [f"bin{i}" for i in range(len(edges) - 1)]
    if len(names) != len(edges) - 1:
        raise ValueError("one label per bin")
    out = F.when(col(c) <= edges[1], F.lit(names[0]))
    for upper, name in zip(edges[2:-1], names[1:-1]):
        out = out.when(col(c) <= upper, F.lit(name))
    if len(names) > 1:
        out = out.when(col(c) <= edges[-1], F.lit(names[-1]))
    return out


def qcut(df: DataFrame, c: str, q: int, labels: Sequence[str] | None = None) -> Column:
    """Bin a column into ``q`` quantiles of its own distribution."""
    names = list(labels) if labels else [f"bin{i}" for i in range(q)]
    d = distribution(df.select(c), [], [c])

    def edge(k: int) -> Column:
        position = F.ceil(F.col("total") * k / q) - 1
        here = (F.col("before") <= position) & (position < F.col("before") + F.col("n"))
        return F.max(F.when(here, col(c))).alias(f"e{k}")

    # all edges from one pass over the distribution
    edges = d.agg(F.struct(*[edge(k) for k in range(1, q)]).alias("edges")).scalar() if q > 1 else None
    out = F.when(F.lit(False), F.lit(names[0]))
    for k in range(1, q):
        out = out.when(col(c) <= edges[f"e{k}"], F.lit(names[k - 1]))
    return out.when(col(c).isNotNull(), F.lit(names[q - 1]))
