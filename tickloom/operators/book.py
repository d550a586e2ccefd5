"""Order-book reconstruction from price-level updates.

Input ticks carry PRICE, SIZE and BUY_SELL_FLAG (0 bid, 1 ask); an update replaces the size
of its level and size 0 removes it.  Every update is valid until the next update of the
same level, so a book at many times is a set of validity intervals cut at bucket ends: no
sequential replay, and the largest group is one level's history, which is time-sliced.

Uncrossing ends an update at the first later tick of the other side at or through its price.  That
tick is found on a monotone stack: read backwards, only ticks that are nearer or reach further than
all those behind them can be first.  Each time slice passes such ticks on to the slices before it.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.core import SECOND, TMP, Series, col, fill_typed, from_micros
from tickloom.operators import buckets as bk
from tickloom.operators.buckets import BUCKET, Buckets
from tickloom.ordering import Fold, running, shift

SIDE = "BUY_SELL_FLAG"


class _Reach:
    """The later ticks of one side that may be the first to reach a price, the nearest and least far-reaching last.

    ``reach`` is a price that falls the further a tick reaches into the other side: asks by price, bids by minus price.
    """

    def __init__(self) -> None:
        self.reach: list[float] = []
        self.at: list[int] = []

    def add(self, reach: float, at: int) -> None:
        while self.reach and self.reach[-1] >= reach:
            self.reach.pop()
            self.at.pop()
        self.reach.append(reach)
        self.at.append(at)

    def first(self, limit: float) -> int | None:
        """The time of the first of them that reaches ``limit``."""
        k = bisect_right(self.reach, limit) - 1
        return self.at[k] if k >= 0 else None


def crossed(series: Series, place: Column | None = None) -> DataFrame:
    """Add the time at which each update's level is crossed: by the first later tick of the other side with a size, at or through its price.

    ``place`` stands in for the time; it grows with the order.  Ticks without a price cross nothing and are not crossed; withdrawals (size 0) cross nothing.
    """
    name, keys = f"{TMP}crossed", list(series.keys)
    cuts = series.slices()
    cut_names = [f"{TMP}slice", f"{TMP}slice_seq"][: len(cuts)]
    df = series.df.withColumns(dict(zip(cut_names, cuts, strict=True)) | {
        f"{TMP}us": series.us,
        f"{TMP}stamp": series.us if place is None else place,
        f"{TMP}reach": F.when(col("SIZE") > 0, F.when(col(SIDE) == 1, col("PRICE")).otherwise(-col("PRICE")).cast("double")),
        f"{TMP}price": col("PRICE").cast("double"),
        f"{TMP}bid": col(SIDE) == 0,
    })
    ids, order = [*keys, *cut_names], [f"{TMP}us", *[c for c in series.seq if c not in keys]]
    at, reach, bid = F.col(f"{TMP}stamp"), F.col(f"{TMP}reach"), F.col(f"{TMP}bid")
    # what a slice passes on: ticks that reach further than all before them in the slice
    before = Window.partitionBy(*ids, bid).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    furthest = F.min(reach).over(before)
    new = reach.isNotNull() & ~F.isnan(reach) & (furthest.isNull() | (reach < furthest))
    marked = df.select(*ids, *order, at, bid, reach).withColumn(f"{TMP}new", new)
    tick = F.struct(at.alias("at"), reach.alias("reach"))
    bids, asks = f"{TMP}bids", f"{TMP}asks"
    sides = {side: F.sort_array(F.collect_list(F.when(F.col(f"{TMP}new") & flag, tick))) for side, flag in ((bids, bid), (asks, ~bid))}
    passed = marked.groupBy(*ids).agg(*[ticks.alias(side) for side, ticks in sides.items()])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per slice, the ticks of later slices that may be first; slices come last first, and only the stacks are remembered."""
        owner, stacks = None, {}
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                key = [row[k] for k in keys]
                if key != owner:
                    owner, stacks = key, {bids: _Reach(), asks: _Reach()}
                for side, stack in stacks.items():
                    own = row[side]
                    row[side] = [{"at": t, "reach": x} for t, x in zip(stack.at, stack.reach, strict=True)]
                    for tick in reversed(own):
                        stack.add(tick["reach"], tick["at"])
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

    last_first = [F.col(c).desc() for c in cut_names]
    dealt = passed.repartition(*keys) if keys else passed.repartition(1)
    later = dealt.sortWithinPartitions(*keys, *last_first).mapInArrow(chain, passed.schema)

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each slice's ticks, last first, after the row with what later slices pass on; only the two stacks are remembered."""
        owner, stacks = None, {}
        for batch in batches:
            out = []
            places = zip(*[batch[c].to_pylist() for c in ids], strict=True)
            columns = [batch[c].to_pylist() for c in (bids, asks, f"{TMP}stamp", f"{TMP}bid", f"{TMP}price", f"{TMP}reach")]
            for key, later_bids, later_asks, here, is_bid, price, tick_reach in zip(places, *columns, strict=True):
                if key != owner:
                    owner, stacks = key, {bids: _Reach(), asks: _Reach()}
                if later_bids is not None:
                    for side, ticks in ((bids, later_bids), (asks, later_asks)):
                        for tick in ticks:
                            stacks[side].add(tick["reach"], tick["at"])
                    continue
                own, other = (bids, asks) if is_bid else (asks, bids)
                limit = price if price is None or is_bid else -price
                out.append(stacks[other].first(limit) if limit is not None and limit == limit else None)
                if tick_reach is not None and tick_reach == tick_reach:
                    stacks[own].add(tick_reach, here)
            rows = batch.filter(pc.is_null(batch[bids])).select(kept)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(out, pa.int64())], names=[*kept, name])

    kept = series.df.columns
    schema = T.StructType([*series.df.schema.fields, T.StructField(name, T.LongType())])
    both = later.unionByName(df, allowMissingColumns=True).repartition(*ids)
    last_first = [F.col(bids).isNull(), *[F.col(c).desc() for c in order]]
    return both.sortWithinPartitions(*ids, *last_first).mapInArrow(cross, schema)


def _levels(
    series: Series, b: Buckets, clear: Column | None, update_time: str | None, uncross: bool = False,
    state_key: Sequence[str] = (), detail: Sequence[str] = (), inactive_us: int | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """One row per (bucket, live update): what the book looks like at each bucket end, with the bucket's stamp in microseconds.

    Buckets of time are told by the time axis, others by their numbers, which grow with the order too; for these the second frame holds all
    buckets with their stamps.
    """
    source, edges = series, None
    if b.by_time:
        place, top = series.us, F.lit(bk.count(series, b) - 1)
    else:
        if inactive_us is not None:
            raise ValueError("updates expire in buckets of time only")
        source = bk.assign(series, b)
        place, top = F.col(BUCKET), F.col(f"{TMP}final")
        stamp = F.col("begin_us" if b.stamp == "start" else "end_us").alias(f"{TMP}stamp")
        edges = bk.edges(source, b).select(*series.keys, BUCKET, stamp)
    source = source.using(source.df.withColumn(f"{TMP}place", place))
    place = F.col(f"{TMP}place")
    until = [F.col(f"{TMP}next")]
    if clear is not None:
        mark = F.when(F.coalesce(clear, F.lit(False)), place)
        source = source.using(source.df.withColumn(f"{TMP}mark", mark))
        # The next clearing event ends a level as well.
        ahead = running(source, {f"{TMP}cleared": Fold("min", F.col(f"{TMP}mark"))}, reverse=True)
        source = source.using(ahead.where(F.col(f"{TMP}mark").isNull()))
        until.append(F.col(f"{TMP}cleared"))
    if uncross:
        source = source.using(crossed(source, place))
        until.append(F.col(f"{TMP}crossed"))
    if inactive_us is not None:
        until.append(place + F.lit(inactive_us))
    df = shift(source, {f"{TMP}next": (place, 1)}, by=[SIDE, "PRICE", *state_key], lead=True)
    until = F.least(*until) if len(until) > 1 else until[0]
    if edges is not None:
        df = bk.with_last(df, edges, series.keys, f"{TMP}final")
    if b.by_time:
        until = F.when(until < F.lit(series.end_us), until)
        first, ends = F.greatest(bk.number_at(series, b, place), F.lit(0)), bk.number_at(series, b, until)
    else:
        first, ends = place, until
    last = F.when(until.isNull(), top).otherwise(F.least(ends - 1, top)).cast("long")
    stamp = col(update_time) if update_time else col(series.ts)
    live = df.where(col("SIZE") > 0).select(
        *series.keys, "PRICE", "SIZE", SIDE, *detail, stamp.alias("UPDATE_TIME"), first.alias(f"{TMP}a"), last.alias(f"{TMP}b")
    )
    live = live.where(F.col(f"{TMP}a") <= F.col(f"{TMP}b"))
    live = live.withColumn(BUCKET, F.explode(F.sequence(f"{TMP}a", f"{TMP}b"))).drop(f"{TMP}a", f"{TMP}b")
    return _stamped(series, b, live, edges), edges


def _stamped(series: Series, b: Buckets, rows: DataFrame, edges: DataFrame | None) -> DataFrame:
    """The rows of existing buckets with their bucket's stamp."""
    if edges is not None:
        return rows.join(edges, [*series.keys, BUCKET])
    begin, end = bk.bounds_us(series, b, F.col(BUCKET))
    rows = rows.where(F.col(BUCKET) < F.lit(bk.count(series, b)))
    if b.zone:
        rows = rows.where(begin < F.lit(series.end_us))
    return rows.withColumn(f"{TMP}stamp", begin if b.stamp == "start" else end)


def _changes(series: Series, b: Buckets, levels: DataFrame, edges: DataFrame | None, name: str) -> DataFrame:
    """Levels that are new or have another size than in the bucket before; vanished ones with size and level 0.

    Each level meets itself in the next bucket by grouping on (bucket, side, price).
    """
    ids = [*series.keys, BUCKET, SIDE, "PRICE"]
    rest = [c for c in levels.columns if c not in ids]
    row = F.struct(*rest)
    after = _stamped(series, b, levels.drop(f"{TMP}stamp").withColumn(BUCKET, F.col(BUCKET) + 1), edges)
    none = F.lit(None).cast(levels.select(row.alias("r")).schema["r"].dataType)
    both = levels.select(*ids, row.alias("now"), none.alias("was")).unionByName(after.select(*ids, none.alias("now"), row.alias("was")))
    met = both.groupBy(*ids).agg(F.max("now").alias("now"), F.max("was").alias("was"))
    met = met.where(F.col("now").isNull() | F.col("was").isNull() | (F.col("now")["SIZE"] != F.col("was")["SIZE"]))
    gone = F.col("now").isNull()
    zero = {"SIZE": levels.schema["SIZE"].dataType, name: levels.schema[name].dataType}
    out = [F.when(gone, F.lit(0).cast(zero[c]) if c in zero else F.col("was")[c]).otherwise(F.col("now")[c]).alias(c) for c in rest]
    return met.select(*ids, *out)


def ob_snapshot(
    series: Series,
    buckets: Buckets | None = None,
    max_levels: int | None = None,
    side: str | None = None,
    max_depth_shares: float | None = None,
    max_depth_for_price: float | None = None,
    max_spread: float | None = None,
    min_levels: int = 0,
    clear: Column | None = None,
    update_time: str | None = None,
    uncross: bool = False,
    state_key: Sequence[str] = (),
    show_full_detail: bool = False,
    max_inactivity_sec: float | None = None,
    show_only_changes: bool = False,
    book_delimiters: bool = False,
) -> Series:
    """The book at each bucket end: PRICE, SIZE, LEVEL, UPDATE_TIME and side, best level first.  Buckets of any unit.

    ``max_depth_shares`` stops once that much size is covered (the last level's excess is cut
    off), ``max_depth_for_price`` keeps levels within a fraction of the best price,
    ``max_spread`` those within half the spread of the middle.  ``min_levels`` are kept
    whatever the depth limits say.  ``clear`` marks ticks that empty the book.  ``uncross`` removes
    a level when a later tick of the other side arrives at or through its price.

    ``state_key`` names fields that, besides side and price, tell one entry of the book from another (an order number, a venue): an update
    replaces the entry of its key, and a level adds up its entries, with their latest UPDATE_TIME.  ``max_inactivity_sec`` ends an entry that long after its
    last update.  ``show_full_detail`` gives the entries of each level with all input fields instead of the sum; limits still look at levels.
    ``show_only_changes`` gives only levels that are new or have another size than one bucket before, and vanished ones, as they last were, with
    SIZE and LEVEL 0.  ``book_delimiters`` puts a row with defaults and DELIMITER 'D' after each book; other rows have '0'.
    """
    b = buckets or Buckets()
    if show_full_detail and show_only_changes:
        raise ValueError("changes are changes of levels, not of their entries")
    taken = [*series.keys, series.ts, "PRICE", "SIZE", SIDE, "UPDATE_TIME", "LEVEL"]
    detail = [c for c in series.df.columns if c not in taken] if show_full_detail and state_key else []
    inactive = None if max_inactivity_sec is None else round(max_inactivity_sec * SECOND)
    levels, edges = _levels(series, b, clear, update_time, uncross, state_key, detail, inactive)
    if side is not None:
        if max_spread is not None:
            raise ValueError("max_spread looks at both sides")
        levels = levels.where(F.col(SIDE) == {"BID": 0, "ASK": 1}[side])
    entries, level = levels, [*series.keys, BUCKET, SIDE, "PRICE"]
    if state_key:
        dtype = levels.schema["SIZE"].dataType
        levels = entries.groupBy(*level).agg(
            F.sum("SIZE").cast(dtype).alias("SIZE"), F.max("UPDATE_TIME").alias("UPDATE_TIME"), F.first(f"{TMP}stamp").alias(f"{TMP}stamp")
        )
    better = F.when(F.col(SIDE) == 0, -F.col("PRICE")).otherwise(F.col("PRICE"))
    one_side = Window.partitionBy(*series.keys, BUCKET, SIDE)
    if max_spread is not None:
        both = Window.partitionBy(*series.keys, BUCKET)
        bid = F.max(F.when(F.col(SIDE) == 0, F.col("PRICE"))).over(both)
        ask = F.min(F.when(F.col(SIDE) == 1, F.col("PRICE"))).over(both)
        levels = levels.withColumn(f"{TMP}mid", (bid + ask) / 2)
        levels = levels.where(F.abs(F.col(f"{TMP}mid") - F.col("PRICE")) <= max_spread / 2).drop(f"{TMP}mid")
    out = levels.withColumn("LEVEL", F.row_number().over(one_side.orderBy(better)))
    if max_levels is not None:
        out = out.where(F.col("LEVEL") <= max_levels)
    kept = F.lit(True)
    if max_depth_for_price is not None:
        best = F.first("PRICE").over(one_side.orderBy(better))
        limit = F.when(F.col(SIDE) == 0, best * (1 - max_depth_for_price)).otherwise(best * (1 + max_depth_for_price))
        near = F.when(F.col(SIDE) == 0, F.col("PRICE") >= limit).otherwise(F.col("PRICE") <= limit)
        out = out.withColumn(f"{TMP}near", near)
        kept = kept & F.col(f"{TMP}near")
    if max_depth_shares is not None:
        before = one_side.orderBy(better).rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn(f"{TMP}before", F.coalesce(F.sum("SIZE").over(before), F.lit(0)))
        room = F.lit(max_depth_shares) - F.col(f"{TMP}before")
        kept = kept & (room > 0)
        within = F.when(F.col("LEVEL") > min_levels, F.least(F.col("SIZE"), room)).otherwise(F.col("SIZE"))
        out = out.withColumn("SIZE", within.cast(levels.schema["SIZE"].dataType))
    out = out.where(kept | (F.col("LEVEL") <= min_levels)).withColumn("LEVEL", F.col("LEVEL").cast("long")).drop(f"{TMP}near", f"{TMP}before")
    seq = [SIDE, "LEVEL"]
    if show_only_changes:
        out = _changes(series, b, out, edges, "LEVEL")
        seq.append("PRICE")
    elif show_full_detail and state_key:
        out = entries.join(out.select(*level, "LEVEL"), level)
        seq += [c for c in state_key if c not in seq]
    out = out.withColumn(series.ts, from_micros(f"{TMP}stamp"))
    if book_delimiters:
        books = out.select(*series.keys, BUCKET, series.ts).distinct()
        empty = books.select("*", *[F.lit(None).cast(out.schema[c].dataType).alias(c) for c in out.columns if c not in books.columns])
        ends = fill_typed(empty, [c for c in out.columns if c not in books.columns]).withColumn("DELIMITER", F.lit("D"))
        out = out.withColumn("DELIMITER", F.lit("0")).unionByName(ends)
        seq = ["DELIMITER", *seq]
    return series.using(out.drop(BUCKET, f"{TMP}stamp"), seq=tuple(seq))


def ob_snapshot_wide(series: Series, buckets: Buckets | None = None, **limits: object) -> Series:
    """One row per level with bid and ask side by side."""
    flat = ob_snapshot(series, buckets, **limits).df
    ids = [*series.keys, series.ts, "LEVEL"]

    def pick(c: str, flag: int) -> Column:
        return F.max(F.when(F.col(SIDE) == flag, F.col(c)))

    out = flat.groupBy(*ids).agg(
        *[pick(c, flag).alias(f"{name}_{c}") for flag, name in ((0, "BID"), (1, "ASK")) for c in ("PRICE", "SIZE", "UPDATE_TIME")]
    )
    return series.using(out, seq=("LEVEL",))


def ob_snapshot_flat(series: Series, max_levels: int, buckets: Buckets | None = None, **limits: object) -> Series:
    """One row per bucket with a group of columns for every level."""
    levels = ob_snapshot(series, buckets, max_levels=max_levels, **limits).df
    exprs = []
    for k in range(1, max_levels + 1):
        for flag, name in ((0, "BID"), (1, "ASK")):
            here = (F.col(SIDE) == flag) & (F.col("LEVEL") == k)
            for c in ("PRICE", "SIZE", "UPDATE_TIME"):
                exprs.append(F.max(F.when(here, F.col(c))).alias(f"{name}_{c}{k}"))
    return series.using(levels.groupBy(*series.keys, series.ts).agg(*exprs), seq=())


def ob_summary(series: Series, buckets: Buckets | None = None, **limits: object) -> Series:
    """Size, VWAP, best and worst price and level count of each side at each bucket end."""
    levels = ob_snapshot(series, buckets, **limits).df
    exprs = []
    for flag, name in ((0, "BID"), (1, "ASK")):
        here = F.col(SIDE) == flag
        size, price = F.when(here, F.col("SIZE")), F.when(here, F.col("PRICE"))
        low, high = F.min(price), F.max(price)
        exprs += [
            F.coalesce(F.sum(size), F.lit(0)).alias(f"{name}_SIZE"),
            F.try_divide(F.sum(price * size), F.sum(size)).alias(f"{name}_VWAP"),
            (high if flag == 0 else low).alias(f"BEST_{name}_PRICE"),
            (low if flag == 0 else high).alias(f"WORST_{name}_PRICE"),
            F.count(size).alias(f"NUM_{name}_LEVELS"),
        ]
    return series.using(levels.groupBy(*series.keys, series.ts).agg(*exprs), seq=())


def _per_side(series: Series, buckets: Buckets | None, limits: dict, measure) -> Series:
    levels = ob_snapshot(series, buckets, **limits).df
    if limits.get("side"):
        exprs = [measure(F.lit(True)).alias("VALUE")]
    else:
        exprs = [measure(F.col(SIDE) == f).alias(f"{n}_VALUE") for f, n in ((1, "ASK"), (0, "BID"))]
    return series.using(levels.groupBy(*series.keys, series.ts).agg(*exprs), seq=())


def ob_size(series: Series, buckets: Buckets | None = None, **limits: object) -> Series:
    """Total size per side."""
    return _per_side(
        series, buckets, limits, lambda on: F.coalesce(F.sum(F.when(on, F.col("SIZE"))), F.lit(0)).cast("double")
    )


def ob_vwap(series: Series, buckets: Buckets | None = None, **limits: object) -> Series:
    """Size-weighted price per side."""
    return _per_side(
        series, buckets, limits,
        lambda on: F.try_divide(F.sum(F.when(on, F.col("PRICE") * F.col("SIZE"))), F.sum(F.when(on, F.col("SIZE")))),
    )


def ob_num_levels(series: Series, buckets: Buckets | None = None, **limits: object) -> Series:
    """Number of levels per side."""
    return _per_side(series, buckets, limits, lambda on: F.count(F.when(on, F.col("SIZE"))))


def virtual_ob(
    series: Series,
    source_fields: Sequence[str] = (),
    quote_timeout: float | None = None,
    output_book_format: str = "ob",
) -> Series:
    """Best quotes as book orders: each change withdraws the old best and adds the new one.

    ``ob`` reports size changes, ``prl`` the current size of the level (0 when withdrawn).
    A quote not replaced within ``quote_timeout`` seconds is withdrawn.
    """
    if output_book_format not in ("ob", "prl"):
        raise ValueError("output_book_format is 'ob' or 'prl'")
    fields = ["BID_PRICE", "BID_SIZE", "ASK_PRICE", "ASK_SIZE"]
    own = series.using(shift(
        series,
        {f"{TMP}{c}": (col(c), 1) for c in fields} | {f"{TMP}prev_us": (series.us, 1)},
        by=source_fields,
    ))
    us = series.us
    if quote_timeout is None:
        gone = F.lit(False)
        df = own.df
    else:
        limit = round(quote_timeout * SECOND)
        gone = F.coalesce(us - F.col(f"{TMP}prev_us") > limit, F.lit(False))
        df = shift(own, {f"{TMP}next_us": (us, 1)}, by=source_fields, lead=True)
    events = []
    for flag, name in ((1, "ASK"), (0, "BID")):
        price, size = col(f"{name}_PRICE"), col(f"{name}_SIZE")
        old_price, old_size = F.col(f"{TMP}{name}_PRICE"), F.col(f"{TMP}{name}_SIZE")
        had = old_price.isNotNull() & ~gone
        changed = ~had | (old_price != price) | (old_size != size)
        moved = had & (old_price != price)
        if output_book_format == "ob":
            withdraw, size_left = had & changed, -old_size
        else:
            withdraw, size_left = moved, F.lit(0).cast(series.df.schema[f"{name}_SIZE"].dataType)
        events.append(_event(withdraw, us, old_price, size_left, flag, 0))
        events.append(_event(changed, us, price, size, flag, 1))
        if quote_timeout is not None:
            stale = F.col(f"{TMP}next_us").isNull() | (F.col(f"{TMP}next_us") - us > limit)
            stale = stale & (us + limit < F.lit(series.end_us))
            left = -size if output_book_format == "ob" else F.lit(0).cast(series.df.schema[f"{name}_SIZE"].dataType)
            events.append(_event(stale, us + limit, price, left, flag, 2))
    spread = df.withColumn(f"{TMP}e", F.explode(F.array_compact(F.array(*events))))
    label = F.concat_ws(",", *[col(c) for c in source_fields]) if source_fields else F.lit("")
    if not source_fields and series.keys:
        label = F.concat_ws(",", *[col(k).cast("string") for k in series.keys])
    out = spread.select(
        *series.keys,
        from_micros(F.col(f"{TMP}e.us")).alias(series.ts),
        *[col(s) for s in series.seq if s not in series.keys],
        F.col(f"{TMP}e.PRICE").alias("PRICE"),
        F.col(f"{TMP}e.SIZE").alias("SIZE"),
        F.col(f"{TMP}e.{SIDE}").alias(SIDE),
        F.col(f"{TMP}e.sub").alias("sub"),
        label.alias("SOURCE"),
    )
    return series.using(out, seq=(*series.seq, "sub"))


def _event(when: Column, us: Column, price: Column, size: Column, flag: int, sub: int) -> Column:
    fields = F.struct(
        us.alias("us"), price.alias("PRICE"), size.alias("SIZE"), F.lit(flag).alias(SIDE),
        F.lit(sub * 2 + (1 - flag)).alias("sub"),
    )
    return F.when(F.coalesce(when, F.lit(False)), fields)


def book_diff(series: Series, depth: int, include_initial_book: bool = False) -> Series:
    """Level changes between consecutive flat books.

    Each differing book yields a row per level that vanished (SIZE 0), appeared or changed.
    """

    def levels(name: str) -> Column:
        each = [
            F.struct(col(f"{name}_PRICE{k}").alias("PRICE"), col(f"{name}_SIZE{k}").alias("SIZE"))
            for k in range(1, depth + 1)
        ]
        return F.filter(F.array(*each), lambda x: x["PRICE"].isNotNull() & (x["SIZE"] > 0))

    now = series.using(series.df.withColumns({f"{TMP}0": levels("BID"), f"{TMP}1": levels("ASK")}))
    df = shift(now, {f"{TMP}p0": (F.col(f"{TMP}0"), 1), f"{TMP}p1": (F.col(f"{TMP}1"), 1), f"{TMP}had": (F.lit(True), 1)})
    if not include_initial_book:
        df = df.where(F.col(f"{TMP}had"))
    out = []
    for flag in (0, 1):
        new, old = F.col(f"{TMP}{flag}"), F.coalesce(F.col(f"{TMP}p{flag}"), F.array().cast(df.schema[f"{TMP}{flag}"].dataType))
        gone = F.filter(old, lambda o: ~F.exists(new, lambda x: x["PRICE"] == o["PRICE"]))
        gone = F.transform(gone, lambda o: F.struct(o["PRICE"].alias("PRICE"), (o["SIZE"] * 0).alias("SIZE"), F.lit(flag).alias(SIDE)))
        fresh = F.filter(new, lambda x: ~F.exists(old, lambda o: (o["PRICE"] == x["PRICE"]) & (o["SIZE"] == x["SIZE"])))
        fresh = F.transform(fresh, lambda x: F.struct(x["PRICE"].alias("PRICE"), x["SIZE"].alias("SIZE"), F.lit(flag).alias(SIDE)))
        out += [gone, fresh]
    spread = df.select(*series.keys, series.ts, *[col(s) for s in series.seq], F.explode(F.concat(*out)).alias(f"{TMP}e"))
    return series.using(spread.select("*", F.col(f"{TMP}e.*")).drop(f"{TMP}e"))
