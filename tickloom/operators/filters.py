"""Row filters, splits, slices and limits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.core import DAY, HOUR, MINUTE, SECOND, TMP, Series, all_of, col, from_micros, micros
from tickloom.functions.numeric import divide
from tickloom.operators.joins import valid_at
from tickloom.ordering import Fold, row_number, running, shift


def where_clause(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """The matching rows and all the others (an unknown condition does not match)."""
    hit = F.coalesce(condition, F.lit(False))
    return df.where(condition), df.where(~hit)


def where(df: DataFrame, condition: Column, discard_on_match: bool = False) -> DataFrame:
    return where_clause(df, condition)[1 if discard_on_match else 0]


def stop_on_first_mismatch(series: Series, condition: Column) -> Series:
    """The ticks of each key before its first tick that fails the condition."""
    hit = F.when(F.coalesce(condition, F.lit(False)), 1).otherwise(0)
    out = running(series, {f"{TMP}ok": Fold("min", hit)})
    return series.using(out.where(F.col(f"{TMP}ok") == 1).drop(f"{TMP}ok"))


def _case(expr: Column, case: object) -> Column:
    if isinstance(case, range):
        return (expr >= case.start) & (expr <= case.stop)
    if isinstance(case, (tuple, list, set)):
        return expr.isin(*case)
    if isinstance(case, float) and case != case:
        return F.isnan(expr)
    return expr == F.lit(case)


def switch(
    df: DataFrame, expr: Column, cases: Mapping[str, object], default: str | None = None
) -> dict[str, DataFrame]:
    """Split rows by the first case that matches: a value, a tuple of values or an inclusive range."""
    out, taken = {}, F.lit(False)
    for name, case in cases.items():
        hit = F.coalesce(_case(expr, case), F.lit(False))
        out[name] = df.where(hit & ~taken)
        taken = taken | hit
    if default is not None:
        out[default] = df.where(~taken)
    return out


def if_else(condition: Column, a: Column, b: Column) -> Column:
    return F.when(condition, a).otherwise(b)


def dropna(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None) -> DataFrame:
    """Remove rows with NaN (or NULL) in any, or in all, of the floating-point columns."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    chosen = [c for c in floating if subset is None or c in subset]
    bad = [F.isnan(col(c)) | col(c).isNull() for c in chosen]
    if not bad:
        return df
    if how == "any":
        return df.where(all_of([~b for b in bad]))
    return df.where(~all_of(bad))


def _hhmmssmmm(t: str | int | time) -> int:
    if isinstance(t, time):
        return t.hour * HOUR + t.minute * MINUTE + t.second * SECOND + t.microsecond
    digits = f"{int(t):09d}"
    return (
        int(digits[:2]) * HOUR + int(digits[2:4]) * MINUTE + int(digits[4:6]) * SECOND + int(digits[6:]) * 1000
    )


def _day_pattern(local: Column, pattern: str) -> Column:
    """``month.week.weekdays``, ``month/day`` or ``year/month/day``; 0 means any, but weekday 0 is Sunday."""
    if "/" in pattern:
        parts = [int(p) for p in pattern.split("/")]
        year, month, day = parts if len(parts) == 3 else [0, *parts]
        tests = [(F.year(local), year), (F.month(local), month), (F.dayofmonth(local), day)]
    else:
        month, week = (int(p) for p in pattern.split(".")[:2])
        weekdays = [int(d) + 1 for d in pattern.split(".")[2]]
        last = F.dayofmonth(F.last_day(local))
        n_th = F.ceil(F.dayofmonth(local) / F.lit(7))
        # Week 6 stands for the last such weekday of the month.
        in_week = F.dayofmonth(local) > last - 7 if week == 6 else n_th == week
        fits = [F.lit(True)]
        if month:
            fits.append(F.month(local) == month)
        if week:
            fits.append(in_week)
        fits.append(F.dayofweek(local).isin(*weekdays))
        return all_of(fits)
    return all_of([c == v for c, v in tests if v])


def time_filter(
    df: DataFrame,
    ts: str,
    start_time: str | int | time | None = None,
    end_time: str | int | time | None = None,
    day_patterns: str | Sequence[str] = (),
    timezone: str | None = None,
    end_time_tick_matches: bool = False,
    discard_on_match: bool = False,
) -> DataFrame:
    """Ticks inside a daily clock window (may wrap midnight) and on matching days.

    Times are ``HHMMSSmmm`` or :class:`datetime.time`, read in ``timezone`` (UTC timestamps
    are converted).  Day patterns are ``month.week.weekdays`` with one digit per weekday from
    Sunday 0 and week 6 for the last one of the month, ``month/day`` or ``year/month/day``.
    """
    local = F.from_utc_timestamp(col(ts), timezone).cast("timestamp_ntz") if timezone else col(ts)
    clock = F.pmod(micros(local), F.lit(DAY))
    tests = []
    if start_time is not None or end_time is not None:
        low = _hhmmssmmm(start_time if start_time is not None else 0)
        high = _hhmmssmmm(end_time) if end_time is not None else DAY
        before_end = clock <= high if end_time_tick_matches else clock < high
        tests.append((clock >= low) & before_end if low <= high else (clock >= low) | before_end)
    patterns = [day_patterns] if isinstance(day_patterns, str) else list(day_patterns)
    if patterns:
        any_day = F.lit(False)
        for p in patterns:
            any_day = any_day | _day_pattern(local, p)
        tests.append(any_day)
    return where(df, all_of(tests), discard_on_match)


def character_present(df: DataFrame, field: str, characters: str | Column, discard_on_match: bool = False) -> DataFrame:
    """Rows whose text holds at least one of the characters (constant or per row)."""
    chars = F.lit(characters) if isinstance(characters, str) else characters
    shorter = F.length(F.translate(col(field), characters, "")) if isinstance(characters, str) else None
    if shorter is not None:
        hit = shorter < F.length(col(field))
    else:
        hit = F.exists(F.split(chars, ""), lambda c: (c != "") & F.contains(col(field), c))
    return where(df, hit, discard_on_match)


def value_present(df: DataFrame, field: str, values: Sequence[object], discard_on_match: bool = False) -> DataFrame:
    return where(df, col(field).isin(*values), discard_on_match)


def primary_exchange(series: Series, reference: Series, exchange: str = "EXCHANGE", primary: str = "PRIMARY") -> Series:
    """Ticks traded on the exchange that is primary for their symbol at the time."""
    found = valid_at(series, reference, [primary])
    return series.using(found.df.where(col(exchange) == col(primary)).drop(primary))


def hide_ticks(df: DataFrame, status: str = "TICK_STATUS") -> DataFrame:
    """What scans do by default: ticks with a non-zero status stay hidden."""
    return df.where(F.coalesce(col(status), F.lit(0)) == 0)


def skip_bad_tick_symmetric(series: Series, field: str, jump_threshold: float, num_neighbor_ticks: int = 1) -> Series:
    """Remove ticks that jump by more than a factor from more than half of their neighbours.

    Looks at the raw ticks on both sides; :func:`tickloom.operators.outliers.skip_bad_tick`
    compares with kept ticks only.  From or to 0 is a jump beyond any factor, from 0 to 0 is none.
    """
    n = num_neighbor_ticks
    earlier = {f"{TMP}b{k}": (col(field), k) for k in range(1, n + 1)}
    later = {f"{TMP}a{k}": (col(field), k) for k in range(1, n + 1)}
    df = shift(series, earlier)
    df = shift(series.using(df), later, lead=True)
    far, known = F.lit(0), F.lit(0)
    for other in [*earlier, *later]:
        ratio = F.greatest(divide(field, other), divide(other, field))
        far = far + F.when((col(field) != F.col(other)) & (ratio > jump_threshold), 1).otherwise(0)
        known = known + F.when(F.col(other).isNotNull(), 1).otherwise(0)
    return series.using(df.where(far * 2 <= known).drop(*earlier, *later))


def row_slice(series: Series, start: int | None = None, stop: int | None = None, step: int = 1) -> Series:
    """Python slicing ``[start:stop:step]`` of the ticks of each key, negatives from the end."""
    if step < 1:
        raise ValueError("step is a positive number of ticks")
    from_start, from_end = f"{TMP}i", f"{TMP}j"
    df = row_number(series, from_start)
    needs_end = any(b is not None and b < 0 for b in (start, stop))
    if needs_end:
        df = row_number(series.using(df), from_end, reverse=True)
    i = F.col(from_start) - 1
    size = F.col(from_start) + F.col(from_end) - 1 if needs_end else None

    def bound(b: int) -> Column:
        return F.lit(b) if b >= 0 else F.greatest(size + b, F.lit(0))

    low = F.lit(0) if start is None else bound(start)
    tests = [i >= low, (i - low) % step == 0]
    if stop is not None:
        tests.append(i < bound(stop))
    return series.using(df.where(all_of(tests)).drop(from_start, from_end))


def limit(series: Series, n: int, offset: int = 0, across_symbols: bool = False) -> Series:
    """The first ``n`` ticks after ``offset``, per key or over all keys together."""
    if across_symbols:
        ordered = series.df.orderBy(*series.order, *series.keys)
        return series.using(ordered.offset(offset).limit(n))
    rank = f"{TMP}rank"
    w = Window.partitionBy(*series.keys).orderBy(*series.order)
    top = series.df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n + offset)
    return series.using(top.where(F.col(rank) > offset).drop(rank))


def head(series: Series, n: int = 5) -> DataFrame:
    return series.df.orderBy(*series.order, *series.keys).limit(n)


def tail(series: Series, n: int = 5) -> DataFrame:
    return series.df.orderBy(*[o.desc() for o in series.order], *series.keys).limit(n)


def count(series: Series) -> int:
    return series.df.count()


def quality_events(series: Series, flag: Column, name: str = "DQ_EVENT") -> Series:
    """Show data-quality marks as rows of their own, in front of the ticks they belong to."""
    from tickloom.operators.project import insert_tick

    marked = series.using(series.df.withColumn(name, F.lit(None).cast("string")))
    return insert_tick(marked, {name: flag}, where=flag.isNotNull(), before=True)


def intercept_quality_events(df: DataFrame, name: str = "DQ_EVENT") -> DataFrame:
    """Remove the rows that only report data quality."""
    return df.where(col(name).isNull())


def throw_for_symbol(series: Series, where: Column | None = None, message: str | Column = "", code: int = 1) -> Series:
    """Ticks that satisfy the condition turn into errors of their symbol; the others stay ticks, with NULL in ERROR_CODE and ERROR_MESSAGE."""
    hit = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    text = F.lit(message) if isinstance(message, str) else message
    return series.using(series.df.withColumns({
        "ERROR_CODE": F.when(hit, F.lit(code)).cast("long"), "ERROR_MESSAGE": F.when(hit, F.coalesce(text.cast("string"), F.lit(""))),
    }))


def show_symbol_errors(series: Series) -> Series:
    """The errors as rows: symbol, ERROR_CODE and ERROR_MESSAGE, stamped with the start of the query interval."""
    begin = from_micros(F.lit(series.start_us)).cast(series.df.schema[series.ts].dataType).alias(series.ts)
    kept = [c for c in series.seq if c not in series.keys]
    return series.using(series.df.where(F.col("ERROR_CODE").isNotNull()).select(*series.keys, begin, *kept, "ERROR_CODE", "ERROR_MESSAGE"))


def intercept_symbol_errors(series: Series, whole_symbols: bool = False) -> Series:
    """Remove the errors, and with ``whole_symbols`` all ticks of a symbol that has one."""
    df = series.df
    if whole_symbols:
        if not series.keys:
            raise ValueError("whole symbols need symbols: the series has no keys")
        failed = df.where(F.col("ERROR_CODE").isNotNull()).select(*series.keys).distinct()
        df = df.join(failed, list(series.keys), "left_anti")
    return series.using(df.where(F.col("ERROR_CODE").isNull()).drop("ERROR_CODE", "ERROR_MESSAGE"))
