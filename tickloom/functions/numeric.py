"""Numeric functions and operators with guarded edge cases, whatever the session's ANSI mode."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.core import col


def maximum(*values: str | Column) -> Column:
    return F.greatest(*[col(v) for v in values])


def minimum(*values: str | Column) -> Column:
    return F.least(*[col(v) for v in values])


def _log(f: Callable[[Column], Column], c: str | Column) -> Column:
    """A logarithm whose value at 0 is minus infinity; NULL for negative numbers."""
    c = col(c).cast("double")
    return F.when(c == 0, F.lit(float("-inf"))).otherwise(f(c))


def ln(c: str | Column) -> Column:
    return _log(F.ln, c)


def log10(c: str | Column) -> Column:
    return _log(F.log10, c)


def exp(c: str | Column) -> Column:
    return F.exp(col(c))


def sqrt(c: str | Column) -> Column:
    return F.sqrt(col(c))


def sign(c: str | Column) -> Column:
    return F.signum(col(c)).cast("long")


def power(c: str | Column, n: float | Column) -> Column:
    return F.pow(col(c), n if isinstance(n, Column) else F.lit(n))


def pi() -> Column:
    return F.lit(math.pi)


def sin(c: str | Column) -> Column:
    return F.sin(col(c))


def cos(c: str | Column) -> Column:
    return F.cos(col(c))


def tan(c: str | Column) -> Column:
    return F.tan(col(c))


def cot(c: str | Column) -> Column:
    return F.cot(col(c))


def asin(c: str | Column) -> Column:
    return F.asin(col(c))


def acos(c: str | Column) -> Column:
    return F.acos(col(c))


def atan(c: str | Column) -> Column:
    return F.atan(col(c))


def acot(c: str | Column) -> Column:
    return F.lit(math.pi / 2) - F.atan(col(c))


def mod(a: str | Column, b: str | Column | int) -> Column:
    return F.try_mod(col(a), col(b) if isinstance(b, str) else F.lit(b) if isinstance(b, int) else b)


def div(a: str | Column, b: int | Column) -> Column:
    """Integer quotient, truncated toward zero; NULL for a zero divisor."""
    b = F.lit(b) if isinstance(b, int) else b
    quotient = F.try_divide((col(a) - F.try_mod(col(a), b)).cast("decimal(20,0)"), b.cast("decimal(20,0)"))
    return quotient.cast("long")


def gcd(a: str | Column, b: str | Column) -> Column:
    """Greatest common divisor by Euclid's steps: at most five for each digit of the smaller number, and one that swaps the two."""
    x, y = F.abs(col(a)).cast("long"), F.abs(col(b)).cast("long")
    start = F.struct(x.alias("a"), y.alias("b"))
    steps = F.length(F.least(x, y).cast("string")) * 5 + 1

    def step(s: Column, _: Column) -> Column:
        rest = F.when(s["b"] == 0, F.lit(0)).otherwise(F.try_mod(s["a"], s["b"]))
        return F.struct(F.when(s["b"] == 0, s["a"]).otherwise(s["b"]).alias("a"), rest.cast("long").alias("b"))

    return F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda s: s["a"])


def _whole(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of a DOUBLE; values without a fraction, infinities and NaN stay as they are."""
    fractional = F.abs(c) < F.lit(2.0**52)  # false for NaN, which Spark orders above all numbers
    return F.when(fractional, f(F.when(fractional, c)).cast("double")).otherwise(c)


def floor(c: str | Column) -> Column:
    return _whole(col(c).cast("double"), F.floor)


def ceil(c: str | Column) -> Column:
    return _whole(col(c).cast("double"), F.ceil)


def round_(c: str | Column, precision: int = 0, method: str = "upward") -> Column:
    """Round; a half goes ``upward`` (default), ``downward``, ``towards_zero`` or ``away_from_zero``."""
    c = col(c).cast("double")
    scaled = c * F.lit(10.0**precision)
    low, high = _whole(scaled, lambda x: F.floor(x + 0.5)), _whole(scaled, lambda x: F.ceil(x - 0.5))
    chosen = {
        "upward": low,
        "downward": high,
        "towards_zero": F.when(scaled > 0, high).otherwise(low),
        "away_from_zero": F.when(scaled > 0, low).otherwise(high),
    }[method]
    return F.when(F.abs(scaled) < F.lit(2.0**52), chosen / F.lit(10.0**precision)).otherwise(c)


def divide(a: str | Column, b: str | Column) -> Column:
    """Floating division in which x/0 is an infinity and 0/0 is NaN; NULL stays NULL."""
    a, b = col(a).cast("double"), col(b).cast("double")
    nan = F.lit(float("nan"))
    at_zero = F.when((a == 0) | F.isnan(a), nan).when(a > 0, F.lit(float("inf"))).when(a < 0, F.lit(float("-inf")))
    return F.when(b == 0, at_zero).otherwise(F.try_divide(a, b))


def rand(seed: int | None = None) -> Column:
    return F.rand(seed)


def rand_int(low: int, high: int, seed: int | None = None) -> Column:
    """A random integer in ``[low, high)``."""
    return (F.floor(F.rand(seed) * (high - low)) + low).cast("long")


def now() -> Column:
    return F.current_timestamp()


def bit_and(a: str | Column, b: int | Column) -> Column:
    return col(a).bitwiseAND(b)


def bit_or(a: str | Column, b: int | Column) -> Column:
    return col(a).bitwiseOR(b)


def bit_xor(a: str | Column, b: int | Column) -> Column:
    return col(a).bitwiseXOR(b)


def bit_not(a: str | Column) -> Column:
    return F.bitwise_not(col(a))


def bit_at(a: str | Column, i: int) -> Column:
    return F.getbit(col(a), F.lit(i)).cast("long")


def hash_code(c: str | Column, algorithm: str = "sha_256") -> Column:
    """Digest of a text: sha_1, sha_224, sha_256, sha_384 or sha_512 in hex; ``xx_hash_64`` as a number."""
    text = col(c).cast("string")
    if algorithm == "sha_1":
        return F.sha1(text)
    if algorithm in ("sha_224", "sha_256", "sha_384", "sha_512"):
        return F.sha2(text, int(algorithm.rsplit("_", 1)[1]))
    if algorithm == "xx_hash_64":
        return F.xxhash64(text)
    raise ValueError(f"unknown hash {algorithm!r}")


def map_values(c: str | Column, mapping: Mapping[object, object], default: Column | None = None) -> Column:
    """Replace values by a dictionary; others become ``default`` (NULL if none is given)."""
    out = None
    for k, v in mapping.items():
        out = F.when(col(c) == F.lit(k), F.lit(v)) if out is None else out.when(col(c) == F.lit(k), F.lit(v))
    if out is None:
        return default if default is not None else F.lit(None)
    return out if default is None else out.otherwise(default)


def to_int(c: str | Column) -> Column:
    """Integer, truncated toward zero; NULL where there is none."""
    return col(c).try_cast("double").try_cast("long")


def text_to_int(c: str | Column) -> Column:
    """The leading integer of a text, 0 if there is none."""
    return F.coalesce(F.regexp_extract(col(c), r"^\s*([+-]?\d+)", 1).try_cast("long"), F.lit(0))


def text_to_float(c: str | Column) -> Column:
    """The leading number of a text, 0 if there is none."""
    pattern = r"^\s*([+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?))"
    return F.coalesce(F.regexp_extract(col(c), pattern, 1).try_cast("double"), F.lit(0.0))


def float_to_text(c: str | Column, precision: int = 6) -> Column:
    return F.format_string(f"%.{precision}f", col(c).cast("double"))


def decimal_to_text(c: str | Column, precision: int = 8) -> Column:
    return col(c).cast(f"decimal(38,{precision})").cast("string")


def compare(a: str | Column, b: str | Column | float, eps: float) -> Column:
    """0 when the values agree, else the sign of their difference.

    They agree within 1e-12, or within ``eps`` relative to the larger magnitude (at least 1).
    NaN equals NaN and is less than any number.
    """
    x = col(a).cast("double")
    y = (F.lit(b) if isinstance(b, (int, float)) else col(b)).cast("double")
    gap, scale = F.abs(x - y), F.greatest(F.lit(1.0), F.abs(x), F.abs(y))
    return (
        F.when(F.isnan(x) & F.isnan(y), 0)
        .when(F.isnan(x), -1)
        .when(F.isnan(y), 1)
        .when((gap <= 1e-12) | (gap / scale <= eps), 0)
        .when(x > y, 1)
        .otherwise(-1)
    )


def equal(a: str | Column, b: str | Column | float, delta: float) -> Column:
    x = col(a).cast("double")
    y = (F.lit(b) if isinstance(b, (int, float)) else col(b)).cast("double")
    return F.abs(x - y) <= delta
