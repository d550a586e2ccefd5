"""Trade analytics that need their own algorithm: realised profit and option values."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.core import TMP, Series, col
from tickloom.operators import aggregate as ag
from tickloom.operators.buckets import Buckets
from tickloom.ordering import Fold, running, shift


def pnl_realized(
    series: Series,
    price: str = "PRICE",
    size: str = "SIZE",
    side: str = "BUY_SELL_FLAG",
    name: str = "PNL_REALIZED",
    quantity_slice: int = 1_000_000,
) -> Series:
    """First-in-first-out realised profit, booked on the trade that closes a position.

    The k-th unit bought is matched with the k-th unit sold.  Both sides' cumulative
    quantities cut the quantity axis into segments; each segment belongs to one buy and one
    sell, found by a running fold, so trades are never paired with each other.
    """
    flag = col(side)
    if series.df.schema[side].dataType.simpleString() == "string":
        is_buy = F.upper(flag) == "B"
    else:
        is_buy = flag == 0
    q, us, buy = f"{TMP}q", f"{TMP}us", f"{TMP}buy"
    marked = series.using(series.df.withColumns({buy: is_buy, us: series.us}))
    cumulated = running(marked, {q: Fold("sum", col(size).cast("double"))}, by=[buy])
    trade = F.struct(
        F.struct(F.col(us).alias("us"), *[col(s).alias(f"s{i}") for i, s in enumerate(series.seq)]).alias("at"),
        col(price).cast("double").alias("price"),
    )
    ends = cumulated.where(col(size) > 0).select(
        *series.keys, q, F.when(F.col(buy), trade).alias(f"{TMP}b"), F.when(~F.col(buy), trade).alias(f"{TMP}s")
    )
    axis = series.using(ends, us_column=q, ts=q, seq=(), slice_us=quantity_slice)
    # Reading backwards, the latest buy (sell) end seen is the one that covers the segment.
    covered = running(
        axis, {f"{TMP}cb": Fold("last", F.col(f"{TMP}b")), f"{TMP}cs": Fold("last", F.col(f"{TMP}s"))},
        reverse=True, peers=True,
    )
    lengths = shift(axis.using(covered), {f"{TMP}prev": (F.col(q), 1)})
    units = F.col(q) - F.coalesce(F.col(f"{TMP}prev"), F.lit(0.0))
    profit = units * (F.col(f"{TMP}cs.price") - F.col(f"{TMP}cb.price"))
    booked = (
        lengths.where(F.col(f"{TMP}cb").isNotNull() & F.col(f"{TMP}cs").isNotNull() & (units > 0))
        .withColumn(f"{TMP}at", F.greatest(F.col(f"{TMP}cb.at"), F.col(f"{TMP}cs.at")))
        .groupBy(*series.keys, f"{TMP}at")
        .agg(F.sum(profit).alias(name))
        .select(
            *series.keys, F.col(f"{TMP}at.us").alias(us),
            *[F.col(f"{TMP}at.s{i}").alias(s) for i, s in enumerate(series.seq)], name,
        )
    )
    joined = marked.df.join(booked, [*series.keys, us, *series.seq], "left")
    out = joined.withColumn(name, F.coalesce(F.col(name), F.lit(0.0)))
    return series.using(out.drop(us, buy).select(*series.df.columns, name))


# Coefficients of the published rational approximation of the normal
# distribution function (Hart 1968, as given by West 2005), highest power first.
_NUMERATOR = (
    3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
)
_DENOMINATOR = (
    8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
)


def _horner(coefficients: Sequence[float], x):
    out = coefficients[0]
    for c in coefficients[1:]:
        out = out * x + c
    return out


def normal_cdf(x: Column) -> Column:
    """Standard normal distribution function to double precision, as a Column expression."""
    a = F.abs(x)
    bell = F.exp(-a * a / 2)
    near = bell * _horner([F.lit(c) for c in _NUMERATOR], a) / _horner([F.lit(c) for c in _DENOMINATOR], a)
    far = a + 0.65
    for k in (4.0, 3.0, 2.0, 1.0):
        far = a + F.lit(k) / far
    tail = F.when(a > 37, F.lit(0.0)).when(a < 7.07106781186547, near).otherwise(bell / far / 2.506628274631)
    return F.when(x > 0, 1 - tail).otherwise(tail)


def _d1(s: Column, k: Column, t: Column, r: Column, v: Column) -> Column:
    return (F.ln(s / k) + (r + v * v / 2) * t) / (v * F.sqrt(t))


def black_scholes(s: Column, k: Column, t: Column, r: Column, v: Column, is_call: Column) -> dict[str, Column]:
    """Option price and sensitivities (DELTA, GAMMA, THETA per year, VEGA, RHO)."""
    d1 = _d1(s, k, t, r, v)
    d2 = d1 - v * F.sqrt(t)
    discounted = k * F.exp(-r * t)
    density = F.exp(-d1 * d1 / 2) / math.sqrt(2 * math.pi)
    sign = F.when(is_call, 1.0).otherwise(-1.0)
    n1, n2 = normal_cdf(sign * d1), normal_cdf(sign * d2)
    return {
        "VALUE": sign * (s * n1 - discounted * n2),
        "DELTA": sign * n1,
        "GAMMA": density / (s * v * F.sqrt(t)),
        "THETA": -s * density * v / (2 * F.sqrt(t)) - sign * r * discounted * n2,
        "VEGA": s * density * F.sqrt(t),
        "RHO": sign * discounted * t * n2,
    }


def cox_ross_rubinstein(s: Column, k: Column, t: Column, r: Column, v: Column, is_call: Column, steps: int) -> Column:
    """European option value on a binomial tree, as the sum over its final prices."""
    h = t / steps
    up = F.exp(v * F.sqrt(h))
    p = (F.exp(r * h) - 1 / up) / (up - 1 / up)
    log_ways = [
        math.lgamma(steps + 1) - math.lgamma(j + 1) - math.lgamma(steps - j + 1) for j in range(steps + 1)
    ]
    log_up, log_down = F.ln(p), F.ln(1 - p)

    def add(total: Column, j: Column) -> Column:
        log_weight = F.element_at(F.array(*[F.lit(w) for w in log_ways]), j + 1) + j * log_up + (steps - j) * log_down
        price = s * F.exp((j * 2 - steps) * v * F.sqrt(h))
        payoff = F.greatest(F.when(is_call, price - k).otherwise(k - price), F.lit(0.0))
        return total + F.exp(log_weight) * payoff

    return F.exp(-r * t) * F.aggregate(F.sequence(F.lit(0), F.lit(steps)), F.lit(0.0), add)


def option_price(
    series: Series,
    price: str = "PRICE",
    option_type: str = "OPTION_TYPE",
    strike: str = "STRIKE_PRICE",
    days: str = "DAYS_TILL_EXPIRATION",
    volatility: float | str = 0.2,
    interest_rate: float | str = 0.0,
    days_in_year: int = 365,
    model: str = "BS",
    steps: int = 50,
    greeks: Sequence[str] = (),
    buckets: Buckets | None = None,
) -> Series:
    """Value the option on the last tick of each bucket."""
    needed = [price, option_type, strike, days, *[x for x in (volatility, interest_rate) if isinstance(x, str)]]
    ends = ag.agg(series, {c: ag.last(c) for c in dict.fromkeys(needed)}, buckets, fill_empty=False)
    v = col(volatility) if isinstance(volatility, str) else F.lit(float(volatility))
    r = col(interest_rate) if isinstance(interest_rate, str) else F.lit(float(interest_rate))
    s, k, t = col(price).cast("double"), col(strike).cast("double"), col(days).cast("double") / float(days_in_year)
    is_call = F.upper(col(option_type)) == "CALL"
    if model == "BS":
        got = black_scholes(s, k, t, r, v, is_call)
        chosen = {"VALUE": got["VALUE"], **{g: got[g] for g in greeks}}
    elif model == "CRR":
        chosen = {"VALUE": cox_ross_rubinstein(s, k, t, r, v, is_call, steps)}
    else:
        raise ValueError("model is 'BS' or 'CRR'")
    return ends.using(ends.df.withColumns(chosen))


def implied_vol(
    series: Series,
    price: str = "PRICE",
    option_price: str = "OPTION_PRICE",
    option_type: str = "OPTION_TYPE",
    strike: str = "STRIKE_PRICE",
    days: str = "DAYS_TILL_EXPIRATION",
    interest_rate: float = 0.0,
    days_in_year: int = 365,
    buckets: Buckets | None = None,
    highest: float = 10.0,
    iterations: int = 60,
) -> Series:
    """The volatility at which the Black-Scholes value meets the option price, by bisection.

    NULL when no volatility in ``(0, highest]`` does.
    """
    needed = [price, option_price, option_type, strike, days]
    ends = ag.agg(series, {c: ag.last(c) for c in needed}, buckets, fill_empty=False)
    numerator, denominator, rate, year = _NUMERATOR, _DENOMINATOR, float(interest_rate), float(days_in_year)

    def cdf(x: np.ndarray) -> np.ndarray:
        a = np.abs(x)
        bell = np.exp(-a * a / 2)
        near = bell * np.polyval(numerator, a) / np.polyval(denominator, a)
        far = a + 0.65
        for n in (4.0, 3.0, 2.0, 1.0):
            far = a + n / far
        tail = np.where(a < 7.07106781186547, near, bell / far / 2.506628274631)
        return np.where(x > 0, 1 - tail, tail)

    @F.pandas_udf("double")
    def solve(s: pd.Series, o: pd.Series, call: pd.Series, k: pd.Series, d: pd.Series) -> pd.Series:
        s, o, k, t = (x.to_numpy(dtype=float) for x in (s, o, k, d / year))
        sign = np.where(call.to_numpy(dtype=bool), 1.0, -1.0)
        discounted = k * np.exp(-rate * t)

        def value(v: np.ndarray) -> np.ndarray:
            d1 = (np.log(s / k) + (rate + v * v / 2) * t) / (v * np.sqrt(t))
            return sign * (s * cdf(sign * d1) - discounted * cdf(sign * (d1 - v * np.sqrt(t))))

        low, high = np.full(len(s), 1e-9), np.full(len(s), highest)
        with np.errstate(all="ignore"):
            possible = (value(low) <= o) & (o <= value(high))
            for _ in range(iterations):
                middle = (low + high) / 2
                below = value(middle) < o
                low, high = np.where(below, middle, low), np.where(below, high, middle)
        return pd.Series(np.where(possible, (low + high) / 2, np.nan)).replace({np.nan: None}).astype("float64")

    is_call = F.upper(col(option_type)) == "CALL"
    args = [col(c).cast("double") for c in (price, option_price)]
    out = solve(*args, is_call, col(strike).cast("double"), col(days).cast("double"))
    return ends.using(ends.df.withColumn("VALUE", F.when(~F.isnan(out), out)))
