"""The time-series view of a DataFrame, and the few helpers everything else shares.

A :class:`Series` says which columns of a DataFrame carry the time, the arrival
number and the symbol.  It owns no data: every operator takes a Series, returns a
Series (or a DataFrame) and leaves planning to Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

#: Column names that start with this prefix belong to the library while a plan is built.
TMP = "_tl_"


def col(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def micros(c: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp column, independent of the session zone."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), col(c).cast("timestamp_ntz"))


def from_micros(c: str | Column) -> Column:
    return F.timestamp_add("MICROSECOND", col(c), F.expr(_EPOCH))


def literal_micros(t: datetime | date | str) -> int:
    if isinstance(t, str):
        t = datetime.fromisoformat(t)
    elif not isinstance(t, datetime):
        t = datetime(t.year, t.month, t.day)
    delta = t.replace(tzinfo=None) - datetime(1970, 1, 1)
    return (delta.days * 86_400 + delta.seconds) * SECOND + delta.microseconds


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def typed_default(dtype: T.DataType) -> Column:
    """The value a missing field takes in typed-default mode: 0, NaN, '' or the epoch."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.lit(float("nan")).cast(dtype)
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return F.expr(_EPOCH).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    return F.lit(None).cast(dtype)


def fill_typed(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace NULL by the default of each column's type (the no-NULL convention)."""
    wanted = set(df.columns if columns is None else columns)
    return df.select(
        *[
            F.coalesce(col(f.name), typed_default(f.dataType)).alias(f.name) if f.name in wanted else col(f.name)
            for f in df.schema.fields
        ]
    )


def truthy(df: DataFrame, name: str) -> Column:
    """Non-zero, non-empty or after the epoch, by the column's type."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(col(name), F.lit(False))
    return F.coalesce(col(name) != typed_default(dtype) if not isinstance(dtype, T.FractionalType) else col(name) != 0, F.lit(False))


class HotKeys:
    """Key values that hold many rows, and how narrow their slices should be.

    Found when first asked for, so that pipelines without ordered operators count nothing.
    """

    def __init__(self, columns: tuple[str, ...], find: Callable[[], tuple[tuple[tuple, ...], int | None]]) -> None:
        self.columns = columns
        self._find = find

    @cached_property
    def _found(self) -> tuple[tuple[tuple, ...], int | None]:
        return self._find()

    @property
    def values(self) -> tuple[tuple, ...]:
        return self._found[0]

    @property
    def width(self) -> int | None:
        return self._found[1]

    def test(self) -> Column:
        """Whether a row belongs to one of them."""
        if len(self.columns) == 1:
            return col(self.columns[0]).isin([v[0] for v in self.values])
        any_of = F.lit(False)
        for value in self.values:
            any_of = any_of | all_of([col(c) == F.lit(v) for c, v in zip(self.columns, value)])
        return any_of

    def merge(self, other: "HotKeys | None", columns: tuple[str, ...]) -> "HotKeys | None":
        """The large keys of two series whose keys correspond."""
        if other is None or len(other.columns) != len(self.columns):
            return None
        if other is self:
            return self

        def both() -> tuple[tuple[tuple, ...], int | None]:
            widths = [h.width for h in (self, other) if h.width is not None]
            return tuple(dict.fromkeys([*self.values, *other.values])), min(widths, default=None)

        return HotKeys(columns, both)


@dataclass(frozen=True)
class Series:
    """A DataFrame read as ticks in time order.

    ``ts``      timestamp column
    ``seq``     arrival-number columns that order equal timestamps; (ts, *seq) is total within a key
    ``keys``    symbol columns, never NULL; one independent series per key value
    ``start``, ``end``  the query interval, end exclusive; anchors buckets
    ``slice_us``  width of the time slices over which order-dependent work on one key is spread;
                  see :meth:`balanced`
    ``seq_slice`` for coarse timestamps (days, say): additionally cut each timestamp's rows every
                  so many arrival numbers, so that a single crowded timestamp is spread as well;
                  needs one integer ``seq`` column
    """

    df: DataFrame
    ts: str = "ts"
    seq: tuple[str, ...] = ("seq",)
    keys: tuple[str, ...] = ()
    start: datetime | None = None
    end: datetime | None = None
    slice_us: int = 10 * MINUTE
    seq_slice: int | None = None
    us_column: str | None = None  # a column that already holds the time in microseconds
    hot: HotKeys | None = None  # which keys are cut into slices; None: all of them

    # -- construction ----------------------------------------------------
    def using(self, df: DataFrame, **changes: object) -> "Series":
        """The same view of another DataFrame.

        What is known about hot keys stays valid for fewer rows and for finer keys, but not on
        another time axis.
        """
        if self.hot is not None and "hot" not in changes:
            keys = changes.get("keys", self.keys)
            if "us_column" in changes or not set(self.hot.columns) <= set(keys):
                changes["hot"] = None
        return replace(self, df=df, **changes)

    def balanced(self, rows_per_task: int = 1_000_000) -> "Series":
        """Slice only the keys that hold more than ``rows_per_task`` rows.

        Counts rows per key in one pass over the key and time columns, once an ordered operator
        asks for it.  What comes back to the
        driver is bounded by design: fewer than total / rows_per_task keys can be that large.
        Without large keys, ordered operators are plain windows over the key.  A series
        without keys stays sliced throughout.
        """
        if not self.keys:
            return self
        names = [f"k{i}" for i in range(len(self.keys))]

        def find() -> tuple[tuple[tuple, ...], int | None]:
            large = (
                self.df.groupBy(*[col(k).alias(n) for k, n in zip(self.keys, names)])
                .agg(F.count(F.lit(1)).alias("n"), F.min(self.us).alias("a"), F.max(self.us).alias("b"))
                .where(F.col("n") > rows_per_task)
                .collect()
            )
            # Four slices for every rows_per_task rows leave room for uneven times.
            widths = [max((row["b"] - row["a"]) * rows_per_task // (4 * row["n"]), 1) for row in large]
            return tuple(tuple(row[n] for n in names) for row in large), min(widths, default=None)

        return replace(self, hot=HotKeys(self.keys, find))

    @property
    def sliced(self) -> bool:
        return self.hot is None or bool(self.hot.values)

    @property
    def slice_width(self) -> int:
        """Width of a slice; wider than any interval when nothing is sliced."""
        if self.hot is None:
            return self.slice_us
        return (self.hot.width or self.slice_us) if self.hot.values else 10**18

    def pipe(self, fn: Callable[..., "Series"], *args: object, **kwargs: object) -> "Series":
        """Apply a reusable sub-pipeline (a function from Series to Series)."""
        return fn(self, *args, **kwargs)

    # -- order -----------------------------------------------------------
    @property
    def us(self) -> Column:
        return col(self.us_column) if self.us_column else micros(self.ts)

    @property
    def order(self) -> list[Column]:
        return [self.us, *[col(s) for s in self.seq]]

    @property
    def order_struct(self) -> Column:
        return F.struct(self.us.alias("us"), *[col(s).alias(f"s{i}") for i, s in enumerate(self.seq)])

    @property
    def position(self) -> Column:
        """One orderable column for the place in the order: the bare time where there is no arrival number.

        A bare time lets Spark pick first and last values by hash aggregation.
        """
        return self.order_struct if self.seq else self.us

    @property
    def start_us(self) -> int:
        if self.start is None:
            raise ValueError("this operator needs the query interval: give start=")
        return literal_micros(self.start)

    @property
    def end_us(self) -> int:
        if self.end is None:
            raise ValueError("this operator needs the query interval: give end=")
        return literal_micros(self.end)

    def slices(self) -> list[Column]:
        """Columns that cut each key into consecutive runs of its order."""
        if not self.sliced:
            return [F.lit(0).cast("long").alias(f"{TMP}slice")]
        cuts = [F.floor(self.us / F.lit(self.slice_width))]
        if self.seq_slice is not None:
            if len(self.seq) != 1:
                raise ValueError("seq_slice needs exactly one integer arrival column")
            cuts = [self.us, F.floor(col(self.seq[0]) / F.lit(self.seq_slice))]
        if self.hot is not None:
            here = self.hot.test()
            cuts = [F.when(here, c).otherwise(F.lit(0).cast("long")) for c in cuts]
        return [c.alias(n) for c, n in zip(cuts, (f"{TMP}slice", f"{TMP}slice_seq"))]

    @property
    def payload(self) -> list[str]:
        """Columns other than the key columns."""
        return [c for c in self.df.columns if c not in self.keys]


def interval(series: Series, start: datetime | str | None = None, end: datetime | str | None = None) -> Series:
    """Restrict a series to ``[start, end)``; a plain comparison, so it reaches the scan."""
    start = datetime.fromisoformat(start) if isinstance(start, str) else start
    end = datetime.fromisoformat(end) if isinstance(end, str) else end
    df = series.df
    dtype = df.schema[series.ts].dataType
    if start is not None:
        df = df.where(col(series.ts) >= F.lit(str(start)).cast(dtype))
    if end is not None:
        df = df.where(col(series.ts) < F.lit(str(end)).cast(dtype))
    return series.using(df, start=start or series.start, end=end or series.end)
