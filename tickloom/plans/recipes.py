"""Packaged analytics: bars, execution-quality measures and other user-level pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.core import SECOND, Series, col
from tickloom.functions import numeric as nu
from tickloom.operators import aggregate as ag
from tickloom.operators import joins as jn
from tickloom.operators import project as pj
from tickloom.operators.buckets import Buckets
from tickloom.ordering import Fold, running


def ohlcv(trades: Series, size: float, unit: str = "seconds", fill_empty: bool = False) -> Series:
    """Open, high, low, close, volume and VWAP bars."""
    return ag.agg(
        trades,
        {
            "OPEN": ag.first("PRICE"), "HIGH": ag.max_("PRICE"), "LOW": ag.min_("PRICE"), "CLOSE": ag.last("PRICE"),
            "VOLUME": ag.sum_("SIZE"), "VWAP": ag.vwap("PRICE", "SIZE"),
        },
        Buckets(size, unit),
        fill_empty=fill_empty,
    )


def _mid(bid: str | Column, ask: str | Column) -> Column:
    return (col(bid) + col(ask)) / 2


def _signed(buy: Column) -> Column:
    return F.when(buy, 1.0).otherwise(-1.0)


def with_quote(orders: Series, quotes: Series, prefix: str = "", delay_us: int = 0) -> Series:
    """The bid, ask and middle in force at each tick."""
    out = jn.asof(orders, quotes, {f"{prefix}BID": "BID_PRICE", f"{prefix}ASK": "ASK_PRICE"}, delay_us=delay_us)
    return out.using(out.df.withColumn(f"{prefix}MID", _mid(f"{prefix}BID", f"{prefix}ASK")))


def arrival_prices(orders: Series, quotes: Series) -> Series:
    """Quote at the moment an order arrives."""
    return with_quote(orders, quotes, "ARRIVAL_")


def exit_prices(fills: Series, quotes: Series) -> Series:
    """Quote at the moment an order is done."""
    return with_quote(fills, quotes, "EXIT_")


def effective_spread(trades: Series, quotes: Series, buy: Column) -> Series:
    """Twice the signed distance from the middle, and its share of the quoted spread (infinite where that is 0)."""
    q = with_quote(trades, quotes)
    effective = 2 * _signed(buy) * (col("PRICE") - col("MID"))
    quoted = col("ASK") - col("BID")
    return q.using(
        q.df.withColumns(
            {
                "EFFECTIVE_SPREAD": effective,
                "NOTIONAL_SPREAD": effective * col("SIZE"),
                "ETQ": nu.divide(effective, quoted),
                "NUM_SPREADS": nu.divide(_signed(buy) * (col("PRICE") - col("MID")), quoted),
            }
        )
    )


def touch(trades: Series, quotes: Series, buy: Column) -> Series:
    """Near touch (own side's best) and far touch (other side's best)."""
    q = with_quote(trades, quotes)
    return q.using(
        q.df.withColumns(
            {
                "NEAR_TOUCH": F.when(buy, col("BID")).otherwise(col("ASK")),
                "FAR_TOUCH": F.when(buy, col("ASK")).otherwise(col("BID")),
            }
        )
    )


def window_quote(trades: Series, quotes: Series, before_us: int, after_us: int) -> Series:
    """Lowest ask and highest bid in a window around each trade."""
    return jn.window_join(
        trades, quotes,
        {"MIN_ASK": ag.min_("ASK_PRICE"), "MAX_BID": ag.max_("BID_PRICE")},
        -before_us, after_us,
    )


def window_touch(orders: Series, quotes: Series, buy: Column, before_us: int, after_us: int) -> Series:
    """Near and far touch over a window around each order: from the highest ask and the lowest bid in it."""
    q = jn.window_join(orders, quotes, {"WINDOW_ASK": ag.max_("ASK_PRICE"), "WINDOW_BID": ag.min_("BID_PRICE")}, -before_us, after_us)
    ask, bid = col("WINDOW_ASK"), col("WINDOW_BID")
    return q.using(q.df.withColumns({"WINDOW_NT": F.when(buy, bid).otherwise(ask), "WINDOW_FT": F.when(buy, ask).otherwise(bid)}))


def implementation_shortfall(
    parents: DataFrame, fills: DataFrame, on: Sequence[str], buy: Column, arrival: str = "ARRIVAL_MID",
    last: str = "EXIT_MID",
) -> DataFrame:
    """Cost of the executed part against arrival, and opportunity cost of the rest.

    ``parents`` hold QTY and quotes per order, ``fills`` PRICE and SIZE per execution.
    """
    done = fills.groupBy(*on).agg(
        F.sum("SIZE").alias("FILLED"), F.sum(F.col("PRICE") * F.col("SIZE")).alias("PAID")
    )
    both = parents.join(done, list(on), "left")
    filled, paid = F.coalesce("FILLED", F.lit(0)), F.coalesce("PAID", F.lit(0.0))
    sign = _signed(buy)
    executed = sign * (paid - filled * col(arrival))
    missed = sign * (col("QTY") - filled) * (col(last) - col(arrival))
    return both.withColumns(
        {"EXECUTION_COST": executed, "OPPORTUNITY_COST": missed, "SHORTFALL": executed + missed}
    )


def price_improvement(trades: Series, quotes: Series, buy: Column) -> Series:
    """How much better than the far touch a trade was, and the value traded beyond it (offside)."""
    q = touch(trades, quotes, buy)
    gain = _signed(buy) * (col("FAR_TOUCH") - col("PRICE"))
    return q.using(
        q.df.withColumns(
            {
                "IMPROVEMENT": F.when(gain > 0, gain).when(gain <= 0, F.lit(0.0)) * col("SIZE"),
                "OFFSIDE_VALUE": F.when(gain < 0, -gain).when(gain >= 0, F.lit(0.0)) * col("SIZE"),
            }
        )
    )


def markouts(trades: Series, quotes: Series, buy: Column, offsets_ms: Sequence[int]) -> Series:
    """Signed move of the middle at each offset from the trade: impact, then reversion.

    RIGHT_WAY says whether the market moved the trade's way.
    """
    q = quotes.using(quotes.df.withColumn("MID", _mid("BID_PRICE", "ASK_PRICE")).select(
        *quotes.keys, quotes.ts, *quotes.seq, "MID"))
    flagged = trades.using(trades.df.withColumn("SIGN", _signed(buy)))
    out = jn.point_in_time(flagged, q, offsets_ms, propagate=["PRICE", "SIGN"])
    move = col("SIGN") * (col("MID") - col("PRICE"))
    return out.using(out.df.withColumns({"MARKOUT": move, "RIGHT_WAY": (move > 0).cast("long")}))


def participation_price(
    orders: Series, trades: Series, rate: float, quantity: str = "QTY"
) -> DataFrame:
    """Participation-weighted price: the VWAP of market trades from the order's arrival until the
    market has traded ``quantity / rate``.

    Market trades lie on their cumulative volume axis; an order covers one stretch of it, so
    the price is a difference of two readings of cumulative value, the last trade in part.
    """
    cum = running(
        trades, {"CV": Fold("sum", col("SIZE").cast("double")), "CN": Fold("sum", col("PRICE") * col("SIZE"))}
    )
    market = trades.using(cum)
    begin = jn.asof(orders, market, {"V0": "CV", "N0": "CN"}, inclusive=False)
    started = begin.df.withColumns(
        {"V0": F.coalesce("V0", F.lit(0.0)), "N0": F.coalesce("N0", F.lit(0.0))}
    ).withColumn("V1", F.col("V0") + col(quantity) / rate)
    # On the volume axis, the trade that completes V1 is the first one with CV >= V1.
    target = orders.using(started, us_column="V1", ts="V1", slice_us=1000)
    axis = trades.using(cum.select(*trades.keys, "CV", "CN", "PRICE", *trades.seq), us_column="CV", ts="CV", slice_us=1000)
    done = jn._against_right(
        target, axis,
        {"F": Fold("last", F.struct("CV", "CN", "PRICE"))}, F.col("CV"), inclusive=True, reverse=True,
    )
    value_at_end = F.col("F.CN") - (F.col("F.CV") - F.col("V1")) * F.col("F.PRICE")
    return done.withColumn("PWP", F.try_divide(value_at_end - F.col("N0"), F.col("V1") - F.col("V0"))).drop("F", "N0")


def relative_performance(pwp: DataFrame, on: Sequence[str], fills: DataFrame, buy: Column) -> DataFrame:
    """The fills' VWAP against a benchmark price, signed so that positive is better."""
    own = fills.groupBy(*on).agg(F.try_divide(F.sum(F.col("PRICE") * F.col("SIZE")), F.sum("SIZE")).alias("OWN_VWAP"))
    both = pwp.join(own, list(on))
    return both.withColumn("RPM", nu.divide(_signed(buy) * (F.col("PWP") - F.col("OWN_VWAP")), "PWP"))


def volatility(series: Series, price: str, bucket_seconds: float) -> Series:
    """Standard deviation of log returns between consecutive ticks, per bucket.

    A return from or to a price of 0 is infinite, and the deviation of its bucket NaN.
    """
    s = pj.lag(series, {"PREV": (price, 1)})
    returns = s.using(s.df.withColumn("RET", nu.ln(nu.divide(price, "PREV"))).where(F.col("RET").isNotNull()))
    return ag.agg(returns, {"VOLATILITY": ag.stddev("RET", biased=False), "N": ag.count()}, Buckets(bucket_seconds), fill_empty=False)


def takeout_success(trades: Series, quotes: Series, buy: Column, within_us: int) -> Series:
    """Whether the best price on the traded side moved away within a time after the trade."""
    now = touch(trades, quotes, buy)
    after = jn.asof(now, quotes, {"BID2": "BID_PRICE", "ASK2": "ASK_PRICE"}, delay_us=-within_us)
    moved = F.when(buy, col("ASK2") > col("FAR_TOUCH")).otherwise(col("BID2") < col("FAR_TOUCH"))
    return after.using(after.df.withColumn("SUCCESS", F.coalesce(moved, F.lit(False)).cast("long")))


def seconds(n: float) -> int:
    return round(n * SECOND)
