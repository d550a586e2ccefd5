"""Column-shaping operators and row synthesis; all of them stay narrow (no shuffle)."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.core import TMP, Series, col, from_micros, typed_default
from tickloom.ordering import Fold, row_number, running, shift


def add_fields(df: DataFrame, fields: Mapping[str, Column], override: bool = False) -> DataFrame:
    clash = [c for c in fields if c in df.columns]
    if clash and not override:
        raise ValueError(f"fields already exist: {clash}")
    return df.withColumns(dict(fields))


def update(
    df: DataFrame, if_set: Mapping[str, Column], else_set: Mapping[str, Column] | None = None, where: Column | None = None
) -> DataFrame:
    """Set fields where the condition holds, and others (``else_set``) where it does not."""
    if where is None:
        return df.withColumns(dict(if_set))
    hit = F.coalesce(where, F.lit(False))
    else_set = else_set or {}
    return df.withColumns(
        {
            c: F.when(hit, if_set.get(c, col(c) if c in df.columns else F.lit(None))).otherwise(
                else_set.get(c, col(c) if c in df.columns else F.lit(None))
            )
            for c in dict.fromkeys([*if_set, *else_set])
        }
    )


def table(df: DataFrame, schema: Mapping[str, T.DataType | str], strict: bool = True) -> DataFrame:
    """Fields in the given order and types; missing ones take their type's default."""
    wanted = []
    for name, dtype in schema.items():
        dtype = T._parse_datatype_string(dtype) if isinstance(dtype, str) else dtype
        source = col(name).try_cast(dtype) if name in df.columns else typed_default(dtype)
        wanted.append(source.alias(name))
    rest = [] if strict else [col(c) for c in df.columns if c not in schema]
    return df.select(*wanted, *rest)


def select(df: DataFrame, *columns: str, regex: bool = False) -> DataFrame:
    """A subset of columns, by name or by full-match pattern."""
    if regex:
        columns = tuple(c for c in df.columns if any(re.fullmatch(p, c) for p in columns))
    return df.select(*[col(c) for c in columns])


def reorder(df: DataFrame, first: Sequence[str]) -> DataFrame:
    return df.select(*[col(c) for c in first], *[col(c) for c in df.columns if c not in first])


def drop(df: DataFrame, *columns: str, regex: bool = False) -> DataFrame:
    if regex:
        columns = tuple(c for c in df.columns if any(re.fullmatch(p, c) for p in columns))
    return df.drop(*columns)


def rename(df: DataFrame, columns: Mapping[str, str], regex: bool = False, skip: Sequence[str] = ()) -> DataFrame:
    """Rename by name, or by pattern with ``\\1`` style groups."""
    if not regex:
        return df.withColumnsRenamed(dict(columns))
    renames = {}
    for c in df.columns:
        if c in skip:
            continue
        for pattern, new in columns.items():
            if re.fullmatch(pattern, c):
                renames[c] = re.sub(pattern, new, c)
                break
    return df.withColumnsRenamed(renames)


def add_prefix(df: DataFrame, prefix: str, columns: Sequence[str] | None = None) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in (df.columns if columns is None else columns)})


def add_suffix(df: DataFrame, suffix: str, columns: Sequence[str] | None = None) -> DataFrame:
    return df.withColumnsRenamed({c: c + suffix for c in (df.columns if columns is None else columns)})


def row_mean(*columns: str) -> Column:
    total = F.lit(0.0)
    for c in columns:
        total = total + col(c).cast("double")
    return total / F.lit(float(len(columns)))


def unite_columns(sep: str, *columns: str) -> Column:
    return F.concat_ws(sep, *[col(c).cast("string") for c in columns])


def transpose_rows(series: Series, n: int, fields: Sequence[str]) -> Series:
    """Every ``n`` ticks become one row: ``X_1`` is the newest of them, ``X_n`` the oldest.

    An incomplete last group produces no row.
    """
    numbered = series.using(row_number(series, f"{TMP}rn"))
    lags = {f"{f}_{k + 1}": (col(f), k) for f in fields for k in range(1, n)}
    wide = shift(numbered, lags) if lags else numbered.df
    wide = wide.where(F.col(f"{TMP}rn") % n == 0)
    rest = [c for c in wide.columns if c not in fields and c not in lags and c != f"{TMP}rn"]
    named = [col(f if k == 1 else f"{f}_{k}").alias(f"{f}_{k}") for f in fields for k in range(1, n + 1)]
    return series.using(wide.select(*[col(c) for c in rest], *named))


def transpose_columns(df: DataFrame, ids: Sequence[str], fields: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide to long: one row per field."""
    return df.unpivot(list(ids), list(fields), name, value)


def fillna(df: DataFrame, value: object, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace NaN and NULL in floating-point columns."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    chosen = [c for c in floating if columns is None or c in columns]
    return df.withColumns({c: F.coalesce(F.nanvl(col(c), F.lit(None)), F.lit(value)) for c in chosen})


def fill_forward(series: Series, columns: Sequence[str]) -> Series:
    """Replace NaN and NULL by the previous valid value of the same key."""
    floating = {f.name for f in series.df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    valid = {c: F.when(~F.isnan(col(c)), col(c)) if c in floating else col(c) for c in columns}
    out = running(series, {f"{TMP}f_{c}": Fold("last", v) for c, v in valid.items()})
    return series.using(out.withColumns({c: F.col(f"{TMP}f_{c}") for c in columns}).drop(*[f"{TMP}f_{c}" for c in columns]))


def cumsum(series: Series, columns: Mapping[str, Column]) -> Series:
    return series.using(running(series, {n: Fold("sum", c) for n, c in columns.items()}))


def lag(series: Series, columns: Mapping[str, tuple[str | Column, int]], typed_defaults: bool = False) -> Series:
    """``col[-n]``: values ``n`` ticks earlier in the same key (NULL or the type's default at the edge)."""
    return _shifted(series, columns, typed_defaults, False)


def lead(series: Series, columns: Mapping[str, tuple[str | Column, int]], typed_defaults: bool = False) -> Series:
    """``col[+n]``: values ``n`` ticks later."""
    return _shifted(series, columns, typed_defaults, True)


def _shifted(series: Series, columns: Mapping, typed: bool, ahead: bool) -> Series:
    df = shift(series, {k: (col(c), n) for k, (c, n) in columns.items()}, lead=ahead)
    if typed:
        df = df.withColumns({k: F.coalesce(col(k), typed_default(df.schema[k].dataType)) for k in columns})
    return series.using(df)


def insert_tick(
    series: Series,
    fields: Mapping[str, Column],
    where: Column | None = None,
    num_ticks: int = 1,
    before: bool = True,
    preserve_input_ticks: bool = True,
) -> Series:
    """Synthesise ticks next to the input ticks that satisfy ``where``.

    Inserted ticks take the time of their neighbour; fields not given are NULL.  The
    position inside the expansion is appended to the arrival order as ``sub``.
    """
    hit = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    own = F.array(F.lit(0)) if preserve_input_ticks else F.array().cast("array<int>")
    steps = range(-num_ticks, 0) if before else range(1, num_ticks + 1)
    inserted = F.when(hit, F.array(*[F.lit(i) for i in steps])).otherwise(F.array().cast("array<int>"))
    spread = series.df.withColumn("sub", F.explode(F.concat(inserted, own)))
    new = F.col("sub") != 0
    fixed = {*series.keys, series.ts, *series.seq}
    out = {
        f.name: F.when(new, fields[f.name] if f.name in fields else F.lit(None).cast(f.dataType)).otherwise(col(f.name))
        for f in series.df.schema.fields
        if f.name not in fixed
    }
    extra = {n: F.when(new, c) for n, c in fields.items() if n not in series.df.columns}
    return series.using(spread.withColumns({**out, **extra}), seq=(*series.seq, "sub"))


def insert_at_end(series: Series, delimiter_name: str = "AT_END") -> Series:
    """One marker row per key at the query end, with ``delimiter_name`` 1 (0 on other rows)."""
    flagged = series.df.withColumn(delimiter_name, F.lit(0))
    if series.keys:
        owners = series.df.select(*series.keys).distinct()
    else:
        owners = series.df.agg(F.count(F.lit(1)).alias(f"{TMP}n")).drop(f"{TMP}n")
    ends = owners.withColumns({
        series.ts: from_micros(F.lit(series.end_us)).cast(series.df.schema[series.ts].dataType),
        delimiter_name: F.lit(1),
    })
    return series.using(flagged.unionByName(ends, allowMissingColumns=True))


def apply_column(df: DataFrame, name: str, fn: Callable[[Column], Column], source: str) -> DataFrame:
    """``col.apply(fn)``: a function from Column to Column, planned by Spark."""
    return df.withColumn(name, fn(col(source)))


def modify_symbol_name(series: Series, name: Column, key: str | None = None) -> Series:
    return series.using(series.df.withColumn(key or series.keys[0], name))


def throw(df: DataFrame, where: Column, message: str | Column) -> DataFrame:
    """Fail the job when a row satisfies the condition; the check is part of the rows' own filter."""
    text = F.lit(message) if isinstance(message, str) else message
    return df.where(F.when(F.coalesce(where, F.lit(False)), F.raise_error(text).cast("boolean")).otherwise(F.lit(True)))


