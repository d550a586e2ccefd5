"""Several series into one: ordered union, feed de-duplication, comparison, adjustment."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.core import TMP, Series, all_of, col, fill_typed, literal_micros
from tickloom.operators import buckets as bk
from tickloom.operators.joins import asof, _against_right
from tickloom.ordering import Fold, row_number, running, shift


def _widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """Common type of a field: the wider number; text when either side is text."""
    if a == b:
        return a
    if isinstance(a, T.StringType) or isinstance(b, T.StringType):
        return T.StringType()
    ladder = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.FloatType, T.DoubleType]
    where = [next((i for i, t in enumerate(ladder) if isinstance(x, t)), None) for x in (a, b)]
    if None in where:
        raise TypeError(f"cannot merge a field of types {a.simpleString()} and {b.simpleString()}")
    return a if where[0] >= where[1] else b


def merge(
    sources: Sequence[Series],
    align_schema: bool = True,
    identify: Sequence[str] | None = None,
    index: str = "SOURCE_INDEX",
    typed_defaults: bool = False,
) -> Series:
    """Union of series in time order; at equal times sources keep their listed order.

    The source's position is kept in ``index`` and becomes part of the arrival order.
    ``identify`` adds a TICK_TYPE name per source.  With ``align_schema`` missing fields are
    added and types widened.
    """
    first = sources[0]
    frames = [s.df.withColumnRenamed(s.ts, first.ts) for s in sources]
    if align_schema:
        target: dict[str, T.DataType] = {}
        for df in frames:
            for f in df.schema.fields:
                target[f.name] = _widest(target.get(f.name, f.dataType), f.dataType)
        frames = [
            df.select(*[col(c).cast(target[c]).alias(c) if df.schema[c].dataType != target[c] else col(c) for c in df.columns])
            for df in frames
        ]
    out = None
    for i, df in enumerate(frames):
        df = df.withColumn(index, F.lit(i))
        if identify:
            df = df.withColumn("TICK_TYPE", F.lit(identify[i]))
        out = df if out is None else out.unionByName(df, allowMissingColumns=align_schema)
    if typed_defaults:
        out = fill_typed(out)
    hot = first.hot
    for s in sources[1:]:
        hot = hot.merge(s.hot, hot.columns) if hot is not None else None
    return first.using(out, seq=(index, *first.seq), hot=hot, slice_us=min(s.slice_us for s in sources))


def coalesce(sources: Sequence[Series], max_delay_us: int, names: Sequence[str] | None = None) -> Series:
    """De-duplicate feeds listed by priority.

    A tick is dropped when a feed of higher priority has a tick at most ``max_delay_us``
    before or after it.  Adds SOURCE.
    """
    merged = merge(sources, index=f"{TMP}feed")
    feed, us = F.col(f"{TMP}feed"), merged.us
    higher = range(len(sources) - 1)
    seen = {f"{TMP}b{i}": Fold("max", F.when(feed == i, us)) for i in higher}
    ahead = {f"{TMP}a{i}": Fold("min", F.when(feed == i, us)) for i in higher}
    out = running(merged, seen, peers=True)
    out = running(merged.using(out), ahead, peers=True, reverse=True)
    near = [
        (feed > i)
        & (
            F.coalesce(us - F.col(f"{TMP}b{i}") <= max_delay_us, F.lit(False))
            | F.coalesce(F.col(f"{TMP}a{i}") - us <= max_delay_us, F.lit(False))
        )
        for i in higher
    ]
    covered = ~all_of([~n for n in near])
    labels = F.element_at(F.array(*[F.lit(n) for n in names or [str(i) for i in range(len(sources))]]), feed + 1)
    out = out.where(~covered).withColumn("SOURCE", labels)
    return sources[0].using(out.drop(*seen, *ahead, f"{TMP}feed"))


def diff(
    left: Series,
    right: Series,
    fields: Sequence[str] | None = None,
    ignore: bool = False,
    show: str = "different",
    left_prefix: str = "L",
    right_prefix: str = "R",
    index: bool = False,
    threshold: int | None = None,
) -> DataFrame:
    """Compare two series tick by tick at equal times.

    Ticks match one to one when time and compared fields agree.  The remaining ticks of one
    time are paired in arrival order.  MATCH_STATUS is 0 for a differing pair, 1 for a match
    and 2 for a tick of one source only.  ``show`` is ``different``, ``matching`` or ``all``;
    ``threshold`` returns only the first so many rows in time order.
    """
    common = [c for c in left.payload if c in right.df.columns and c not in (left.ts, *left.seq)]
    if fields is None:
        compared = common
    else:
        compared = [c for c in common if c not in fields] if ignore else list(fields)
    keys, us, side = list(left.keys), f"{TMP}us", f"{TMP}side"

    def tagged(s: Series, n: int) -> DataFrame:
        df = row_number(s, "INDEX") if index else s.df
        body = [c for c in df.columns if c not in (*s.keys, s.ts, *s.seq)]
        return df.select(
            *keys, s.us.alias(us), F.lit(n).alias(side),
            *[col(c).cast("long").alias(f"{TMP}q{i}") for i, c in enumerate(s.seq)],
            *[col(c).alias(f"{TMP}c_{c}") for c in compared],
            F.struct(*[col(c) for c in body]).alias(f"{TMP}{'lr'[n]}"),
        )

    q = [f"{TMP}q{i}" for i in range(max(len(left.seq), len(right.seq)))]
    both = tagged(left, 0).unionByName(tagged(right, 1), allowMissingColumns=True)
    hot = left.hot.merge(right.hot, left.hot.columns) if left.hot is not None else None
    axis = {"us_column": us, "ts": us, "seq": tuple(q), "hot": hot, "slice_us": min(left.slice_us, right.slice_us)}
    series = left.using(both, **axis)
    same = [us, *[f"{TMP}c_{c}" for c in compared]]
    numbered = row_number(series, f"{TMP}occ", by=[side, *same])
    matched = numbered.groupBy(*keys, *same, f"{TMP}occ").agg(
        F.max(f"{TMP}l").alias(f"{TMP}l"), F.max(f"{TMP}r").alias(f"{TMP}r"),
        *[F.min(c).alias(c) for c in q],
    )
    is_match = F.col(f"{TMP}l").isNotNull() & F.col(f"{TMP}r").isNotNull()
    matched = matched.withColumns({
        f"{TMP}match": is_match,
        side: F.when(is_match, F.lit(2)).when(F.col(f"{TMP}l").isNotNull(), F.lit(0)).otherwise(F.lit(1)),
    })
    paired = row_number(left.using(matched, **axis), f"{TMP}n", by=[us, side])
    paired = paired.groupBy(*keys, us, f"{TMP}match", f"{TMP}n").agg(
        F.max(f"{TMP}l").alias(f"{TMP}l"), F.max(f"{TMP}r").alias(f"{TMP}r")
    )
    one_only = F.col(f"{TMP}l").isNull() | F.col(f"{TMP}r").isNull()
    status = F.when(F.col(f"{TMP}match"), 1).when(one_only, 2).otherwise(0)
    out = paired.select(
        *keys,
        F.timestamp_add("MICROSECOND", F.col(us), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")).alias(left.ts),
        status.cast("long").alias("MATCH_STATUS"),
        *[F.col(f"{TMP}l.{c}").alias(f"{left_prefix}_{c}") for c in both.schema[f"{TMP}l"].dataType.names],
        *[F.col(f"{TMP}r.{c}").alias(f"{right_prefix}_{c}") for c in both.schema[f"{TMP}r"].dataType.names],
    )
    if show == "different":
        out = out.where("MATCH_STATUS <> 1")
    elif show == "matching":
        out = out.where("MATCH_STATUS = 1")
    return out if threshold is None else out.orderBy(*[c for c in out.columns]).limit(threshold)


def lee_and_ready(trades: Series, quotes: Series, quote_delay_us: int = 0, show_quote_fields: bool = False) -> Series:
    """Add BuySellFlag: 1 buy, -1 sell, 0 unknown.

    The price is compared with the middle of the latest quote at least ``quote_delay_us`` old;
    a trade at the middle, or without a quote, with the previous trade's price; and an
    unchanged price repeats the previous classification.
    """
    quote = {"BID_PRICE": "BID_PRICE", "ASK_PRICE": "ASK_PRICE"}
    q = asof(trades, quotes, {f"{TMP}{k}": v for k, v in quote.items()}, delay_us=quote_delay_us)
    with_prev = shift(q, {f"{TMP}prev": (col("PRICE"), 1)})
    middle = (F.col(f"{TMP}BID_PRICE") + F.col(f"{TMP}ASK_PRICE")) / 2
    own = (
        F.when(col("PRICE") > middle, 1)
        .when(col("PRICE") < middle, -1)
        .when(col("PRICE") > F.col(f"{TMP}prev"), 1)
        .when(col("PRICE") < F.col(f"{TMP}prev"), -1)
    )
    marked = trades.using(with_prev.withColumn(f"{TMP}own", own))
    out = running(marked, {"BuySellFlag": Fold("last", F.col(f"{TMP}own"))})
    out = out.withColumn("BuySellFlag", F.coalesce(F.col("BuySellFlag"), F.lit(0)).cast("long"))
    if show_quote_fields:
        out = out.withColumnsRenamed({f"{TMP}{k}": k for k in quote})
    return trades.using(out.drop(f"{TMP}prev", f"{TMP}own", *[f"{TMP}{k}" for k in quote]))


def estimate_ts_delay(
    left: Series, right: Series, left_field: str, right_field: str, grid_us: int, max_steps: int,
    buckets: bk.Buckets | None = None,
) -> DataFrame:
    """The lag, in grid steps, at which two series correlate most, with that correlation.

    Both series are averaged on a time grid; the right one is copied to every candidate lag
    (2 * max_steps + 1 copies of one row per cell) and correlated cell by cell.
    """
    cell = f"{TMP}cell"

    def grid(s: Series, c: str, name: str) -> DataFrame:
        return (
            s.df.withColumn(cell, F.floor((s.us - F.lit(s.start_us)) / F.lit(grid_us)))
            .groupBy(*s.keys, cell).agg(F.avg(c).alias(name))
        )

    a = grid(left, left_field, "a")
    if buckets is None:
        a = a.withColumn(bk.BUCKET, F.lit(0).cast("long"))
    else:
        a = a.withColumn(bk.BUCKET, F.floor(F.col(cell) * grid_us / buckets.width_us).cast("long"))
    b = grid(right, right_field, "b").withColumn(
        "lag", F.explode(F.sequence(F.lit(-max_steps), F.lit(max_steps)))
    ).withColumn(cell, F.col(cell) - F.col("lag"))
    ids = [*left.keys, bk.BUCKET]
    by_lag = a.join(b, [*left.keys, cell]).groupBy(*ids, "lag").agg(F.corr("a", "b").alias("correlation"))
    best = F.max(F.struct(F.col("correlation"), (-F.abs("lag")).alias("near"), F.col("lag")))
    ranked = by_lag.where(F.col("correlation").isNotNull() & ~F.isnan("correlation")).groupBy(*ids).agg(best.alias("m"))
    return ranked.select(*ids, F.col("m.lag").cast("long").alias("lag"), F.col("m.correlation").alias("correlation"))


def corp_actions(
    source: Series,
    factors: Series,
    fields: Sequence[str] = ("PRICE",),
    adjustment: datetime | str | None = None,
    adjust_rule: str = "PRICE",
    factor: str = "FACTOR",
    kinds: Sequence[str] | None = None,
    kind: str = "KIND",
) -> Series:
    """Adjust prices (times) or sizes (divided) by the product of factors dated after the tick.

    Factors in ``(t, adjustment]`` apply; ``kinds`` restricts them to some action types.  A factor
    that is missing or not positive is an error.
    """
    if adjust_rule not in ("PRICE", "SIZE"):
        raise ValueError("adjust_rule is 'PRICE' or 'SIZE'")
    until = source.end_us if adjustment is None else literal_micros(adjustment)
    due = factors.df.where(factors.us <= until)
    if kinds is not None:
        due = due.where(col(kind).isin(list(kinds)))
    wrong = F.raise_error(F.lit(f"corp_actions: {factor} must be positive")).cast("double")
    later = {f"{TMP}ln": Fold("sum", F.ln(F.when(col(factor) > 0, col(factor)).otherwise(wrong)))}
    got = _against_right(source, factors.using(due), later, factors.us, inclusive=False, reverse=True)
    product = F.exp(F.coalesce(F.col(f"{TMP}ln"), F.lit(0.0)))
    scale = (lambda c: col(c) * product) if adjust_rule == "PRICE" else (lambda c: col(c) / product)
    return source.using(got.withColumns({f: scale(f) for f in fields}).drop(f"{TMP}ln"))
