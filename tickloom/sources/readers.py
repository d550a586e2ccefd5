"""Where ticks come from: tables, files, inline rows, generators; and what is there to read."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.core import TMP, Series, col, from_micros, interval, literal_micros, typed_default
from tickloom.functions.dates import java_pattern
from tickloom.ordering import row_number

# Names of field types in declared schemas and titled CSV headers.
TYPE_NAMES = {
    "byte": T.ByteType(), "short": T.ShortType(), "int": T.IntegerType(), "uint": T.LongType(),
    "long": T.LongType(), "ulong": T.DecimalType(20, 0), "float": T.DoubleType(), "double": T.DoubleType(),
    "decimal": T.DecimalType(38, 18), "string": T.StringType(), "varstring": T.StringType(),
    "msectime": T.TimestampNTZType(), "nsectime": T.TimestampNTZType(), "bool": T.BooleanType(),
}

# The fields each preset declares.
PRESETS = {
    "trades": {"PRICE": "double", "SIZE": "long"},
    "quotes": {"BID_PRICE": "double", "BID_SIZE": "long", "ASK_PRICE": "double", "ASK_SIZE": "long"},
    "nbbo": {"BID_PRICE": "double", "BID_SIZE": "long", "ASK_PRICE": "double", "ASK_SIZE": "long"},
    "orders": {"ID": "string", "BUY_FLAG": "long", "SIDE": "string", "STATE": "string", "ORDTYPE": "string",
               "PRICE": "double", "QTY": "long", "QTY_FILLED": "long"},
}


def _type(t: str | T.DataType) -> T.DataType:
    if isinstance(t, T.DataType):
        return t
    name = re.sub(r"\[\d+\]$", "", t.strip().lower())
    return TYPE_NAMES[name] if name in TYPE_NAMES else T._parse_datatype_string(t)


def conform(df: DataFrame, schema: Mapping[str, str | T.DataType], policy: str = "tolerant") -> DataFrame:
    """Check or complete stored columns against declared ones.

    ``tolerant`` casts compatible fields and gives missing ones their default, ``fail``
    refuses missing or incompatible fields, ``manual`` trusts the declaration.  A ``_strict``
    suffix keeps declared fields only.
    """
    mode, _, strict = policy.partition("_")
    if mode not in ("tolerant", "fail", "manual") or strict not in ("", "strict"):
        raise ValueError(f"unknown schema policy {policy!r}")
    out, stored = [], {f.name: f.dataType for f in df.schema.fields}
    for name, declared in schema.items():
        want = _type(declared)
        if name not in stored:
            if mode == "fail":
                raise ValueError(f"field {name} is not stored")
            out.append(typed_default(want).alias(name))
        elif stored[name] == want:
            out.append(col(name))
        else:
            numbers = isinstance(stored[name], T.NumericType) and isinstance(want, T.NumericType)
            if mode == "fail" or (mode == "tolerant" and not numbers and not isinstance(want, T.StringType)):
                raise TypeError(f"field {name} is stored as {stored[name].simpleString()}, not {want.simpleString()}")
            out.append(col(name).try_cast(want).alias(name))
    rest = [] if strict else [col(c) for c in df.columns if c not in schema]
    return df.select(*out, *rest)


def data_source(
    table: DataFrame | str,
    spark: SparkSession | None = None,
    *,
    ts: str = "ts",
    seq: Sequence[str] = ("seq",),
    keys: Sequence[str] = (),
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    date: str | None = None,
    symbols: Sequence[object] | DataFrame | None = None,
    schema: Mapping[str, str | T.DataType] | None = None,
    schema_policy: str = "tolerant",
    where: Column | None = None,
    identify: str | None = None,
    show_hidden: bool = True,
    **options: object,
) -> Series:
    """A series over a table or a parquet path, restricted to an interval and to symbols.

    All restrictions are plain filters, so Spark pushes them into the scan.  Symbols given as
    a DataFrame become a semi join.  ``identify`` adds SYMBOL_NAME and TICK_TYPE.
    """
    if isinstance(table, str):
        session = spark or SparkSession.active()
        df = session.read.parquet(table) if "/" in table else session.table(table)
    else:
        df = table
    if date is not None:
        start, end = date, str(datetime.fromisoformat(date) + timedelta(days=1))
    if schema is not None:
        df = conform(df, {**schema}, schema_policy if schema_policy.endswith("strict") else schema_policy)
    s = interval(Series(df, ts=ts, seq=tuple(seq), keys=tuple(keys), **options), start, end)
    out = s.df
    if symbols is not None:
        if isinstance(symbols, DataFrame):
            out = out.join(symbols.select(*keys).distinct(), list(keys), "left_semi")
        else:
            out = out.where(col(keys[0]).isin(list(symbols)))
    if where is not None:
        out = out.where(where)
    if not show_hidden and "TICK_STATUS" in out.columns:
        out = out.where(F.coalesce(col("TICK_STATUS"), F.lit(0)) == 0)
    if identify is not None:
        name = F.concat_ws(",", *[col(k).cast("string") for k in keys])
        out = out.withColumns({"SYMBOL_NAME": name, "TICK_TYPE": F.lit(identify)})
    return s.using(out)


def preset(kind: str, table: DataFrame | str, **options: object) -> Series:
    """:func:`data_source` with the declared fields of trades, quotes, nbbo or orders."""
    return data_source(table, schema=PRESETS[kind], **options)


def tick(
    spark: SparkSession, fields: Mapping[str, Column], start: datetime, end: datetime, every_us: int | None = None,
    ticks_per_time: int = 1, stamp: str = "start",
) -> Series:
    """One generated tick per bucket (a single one at the start without ``every_us``)."""
    first, last = literal_micros(start), literal_micros(end)
    n = 1 if every_us is None else -(-(last - first) // every_us)
    step = every_us or (last - first)
    rows = spark.range(n * ticks_per_time).withColumnRenamed("id", "seq")
    bucket = F.floor(F.col("seq") / ticks_per_time)
    us = F.lit(first) + bucket * step + (step if stamp == "end" else 0)
    df = rows.select(from_micros(us.cast("long")).alias("ts"), "seq", *[c.alias(k) for k, c in fields.items()])
    return Series(df, start=start, end=end)


def ticks(
    spark: SparkSession,
    data: Mapping[str, Sequence[object]],
    start: datetime,
    end: datetime | None = None,
    offset_ms: Sequence[float] | None = None,
    schema: Mapping[str, str] | None = None,
) -> Series:
    """Inline rows, one millisecond apart unless offsets are given.  For small literals only."""
    n = len(next(iter(data.values())))
    offsets = range(n) if offset_ms is None else offset_ms
    times = [start + timedelta(milliseconds=o) for o in offsets]
    pdf = pd.DataFrame({"ts": times, "seq": range(n), **data})
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    if schema:
        df = df.withColumns({k: col(k).cast(_type(t)) for k, t in schema.items()})
    return Series(df, start=start, end=end)


def from_pandas(spark: SparkSession, pdf: pd.DataFrame, ts: str, **options: object) -> Series:
    """A small local frame; rows keep their order as arrival order."""
    df = spark.createDataFrame(pdf.assign(seq=range(len(pdf))))
    return Series(df.withColumn(ts, col(ts).cast("timestamp_ntz")), ts=ts, **options)


def empty(spark: SparkSession, schema: Mapping[str, str | T.DataType]) -> Series:
    fields = [T.StructField("ts", T.TimestampNTZType()), T.StructField("seq", T.LongType())]
    fields += [T.StructField(n, _type(t)) for n, t in schema.items()]
    return Series(spark.createDataFrame([], T.StructType(fields)))


def _header(title: str) -> tuple[str, T.DataType | None]:
    """``TYPE NAME`` in a title names the type of a field."""
    words = title.lstrip("#").split()
    if len(words) == 2 and re.sub(r"\[\d+\]$", "", words[0].lower()) in TYPE_NAMES:
        return words[1], _type(words[0])
    return title.lstrip("#").strip(), None


def csv(
    spark: SparkSession,
    path: str,
    timestamp: str | None = None,
    timestamp_format: str | None = None,
    names: Sequence[str] | None = None,
    first_line_is_title: bool = True,
    dtype: Mapping[str, str | T.DataType] | None = None,
    converters: Mapping[str, object] | None = None,
    delimiter: str = ",",
    quote: str = '"',
    escape: str = "\\",
    change_date_to: str | None = None,
    auto_increase_us: int | None = None,
    **options: object,
) -> Series:
    """A typed CSV source.

    Only the title line is read while planning.  Types come from ``dtype``, then from ``TYPE
    NAME`` titles; everything else is text.  ``converters`` are functions from Column to
    Column.  Without ``timestamp`` the rows are stamped with the interval start.
    """
    reader = spark.read.option("sep", delimiter).option("quote", quote).option("escape", escape)
    titled = reader.option("header", first_line_is_title).csv(path)
    parsed = [_header(c) for c in titled.columns]
    if names is not None:
        parsed = [(n, t) for n, (_, t) in zip(names, parsed)]
    elif not first_line_is_title:
        parsed = [(f"COLUMN_{i}", None) for i in range(1, len(titled.columns) + 1)]
    df = titled.toDF(*[n for n, _ in parsed])
    types = {n: t for n, t in parsed if t is not None} | {n: _type(t) for n, t in (dtype or {}).items()}
    exprs = {}
    for n, t in types.items():
        if not isinstance(t, (T.TimestampNTZType, T.TimestampType)):
            exprs[n] = col(n).try_cast(t)
        elif n != timestamp:
            exprs[n] = _time_of(col(n), timestamp_format)
    df = df.withColumns(exprs)
    if converters:
        df = df.withColumns({n: fn(col(n)) for n, fn in converters.items()})
    if timestamp is not None:
        df = df.withColumn("ts", _time_of(col(timestamp), timestamp_format))
        if timestamp != "ts":
            df = df.drop(timestamp)
    else:
        df = df.withColumn("ts", F.lit(str(options["start"])).cast("timestamp_ntz"))
    if change_date_to is not None:
        clock = F.date_format("ts", "HH:mm:ss.SSSSSS")
        df = df.withColumn("ts", F.concat(F.lit(f"{change_date_to} "), clock).cast("timestamp_ntz"))
    # Position in the file: files in name order, rows in file order within a split.
    df = df.withColumn("seq", F.monotonically_increasing_id())
    if auto_increase_us:
        # Row ids leave gaps between splits; the position is counted over slices of the ids.
        positions = Series(df, us_column="seq", ts="ts", seq=(), slice_us=1_000_000)
        df = row_number(positions, f"{TMP}rn")
        step = (F.col(f"{TMP}rn") - 1) * auto_increase_us
        df = df.withColumn("ts", F.timestamp_add("MICROSECOND", step, F.col("ts"))).drop(f"{TMP}rn")
    return Series(df, **options)


def _time_of(c: Column, fmt: str | None) -> Column:
    """A timestamp from a formatted text, an ISO text, or an epoch number (s, ms, us or ns by its size)."""
    if fmt is not None:
        return F.try_to_timestamp(c, F.lit(java_pattern(fmt, parsing=True))).cast("timestamp_ntz")
    n = c.try_cast("decimal(38,9)")
    us = (
        F.when(n >= 10**17, n / 1000).when(n >= 10**14, n).when(n >= 10**11, n * 1000).otherwise(n * 1_000_000)
    )
    return F.coalesce(F.replace(c.cast("string"), F.lit("/"), F.lit("-")).try_cast("timestamp_ntz"), from_micros(F.floor(us).cast("long")))


def read_parquet(
    spark: SparkSession,
    path: str,
    where: Column | None = None,
    fields: Sequence[str] | None = None,
    discard: Sequence[str] = (),
    time_assignment: str = "_START_TIME",
    symbol_name_field: str | None = None,
    **options: object,
) -> Series:
    """A parquet scan with predicate and projection; the time comes from a field or the interval's ends."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    chosen = [c for c in (fields or df.columns) if c not in discard]
    if time_assignment in ("_START_TIME", "_END_TIME"):
        t = options["start"] if time_assignment == "_START_TIME" else options["end"]
        df = df.withColumn("ts", F.lit(str(t)).cast("timestamp_ntz"))
    else:
        df = df.withColumn("ts", col(time_assignment))
    keep = list(dict.fromkeys(["ts", *chosen, *options.get("seq", ()), *([symbol_name_field] if symbol_name_field else [])]))
    keys = (symbol_name_field,) if symbol_name_field else tuple(options.pop("keys", ()))
    return Series(df.select(*keep), **{**options, "keys": keys})


def json_file(
    spark: SparkSession, path: str, schema: Mapping[str, str | T.DataType], timestamp: str, symbol: str | None = None,
    **options: object,
) -> Series:
    """JSON lines with a declared schema (never inferred, so the files are read once)."""
    declared = T.StructType([T.StructField(n, _type(t)) for n, t in schema.items()])
    df = spark.read.schema(declared).json(path).withColumn("seq", F.monotonically_increasing_id())
    return Series(df, ts=timestamp, keys=(symbol,) if symbol else (), **options)


# ---------------------------------------------------------------------------
# Discovery
# ---------------------------------------------------------------------------


def symbols(
    series: Series, pattern: str = "%", discard_on_match: bool = False, key: str | None = None
) -> DataFrame:
    """The distinct symbols whose name matches an SQL LIKE pattern."""
    name = key or series.keys[0]
    hit = col(name).cast("string").like(pattern)
    return series.df.select(name).where(~hit if discard_on_match else hit).distinct()


def by_symbol(series: Series, field: str) -> Series:
    """Dispatch ticks to one series per value of a field."""
    return series.using(series.df, keys=(field,))


def databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def tick_types(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{database}`").select("tableName")


def dates(series: Series) -> DataFrame:
    """The days that hold ticks."""
    return series.df.select(F.to_date(col(series.ts)).alias("date")).distinct()


def last_date(series: Series) -> DataFrame:
    return series.df.agg(F.to_date(F.max(col(series.ts))).alias("last_date"))


def last_not_empty_date(series: Series, last: date, days_back: int) -> DataFrame:
    """The last day with ticks among ``last`` and the ``days_back`` days before, NULL if there is none; only those days are read."""
    begin = F.lit(last - timedelta(days=days_back)).cast("timestamp_ntz")
    end = F.lit(last + timedelta(days=1)).cast("timestamp_ntz")
    here = col(series.ts)
    return series.df.where((here >= begin) & (here < end)).agg(F.to_date(F.max(here)).alias("last_date"))


def schema_of(series: Series) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in series.df.schema.fields}
