"""User functions: on rows, groups and buckets, and the usual idioms of per-tick state.

State that follows a pattern (a running value, the latest row per key, the last n values)
is an ordinary ordered operator here and is planned by Spark.  What does not follow one
runs as a small Python function over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.core import TMP, Series, col
from tickloom.operators import buckets as bk
from tickloom.operators.aggregate import Agg
from tickloom.operators.buckets import BUCKET, Buckets
from tickloom.operators.joins import asof, window_join
from tickloom.operators.ticks import distinct
from tickloom.ordering import Fold, running, shift


def script(df: DataFrame, fn: Callable[[dict], Iterable[dict] | bool | None], schema: str | T.StructType) -> DataFrame:
    """Run a function on every row.

    It receives the row as a dict, which it may change.  ``False`` drops the row, an iterable
    of dicts replaces it by any number of rows, anything else keeps it.  Rows are
    independent; see the state functions below for what depends on earlier rows.
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = schema.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                got = fn(row)
                if got is False:
                    continue
                out.extend(got if got is not None and got is not True else [row])
            yield pd.DataFrame(out, columns=names)

    return df.mapInPandas(run, schema)


def script_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType) -> DataFrame:
    """Like :func:`script` with a vectorised function from batch to batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def process_by_group(series: Series, fn: Callable[[Series], Series], group_by: Sequence[str]) -> Series:
    """Run a pipeline separately for every group: the group columns become part of the key."""
    keys = (*series.keys, *[g for g in group_by if g not in series.keys])
    return series.using(fn(series.using(series.df, keys=keys)).df)


def generic(series: Series, fn: Callable[[Series], Series], buckets: Buckets, group_by: Sequence[str] = ()) -> DataFrame:
    """Run a pipeline separately for every bucket: the bucket becomes part of the key.

    The result is stamped with the bucket's start or end.
    """
    own = "_tl_own_bucket"  # the pipeline may use buckets of its own
    assigned = bk.assign(series, buckets, group_by)
    keys = (*series.keys, *[g for g in group_by if g not in series.keys], own)
    out = fn(assigned.using(assigned.df.withColumnRenamed(BUCKET, own), keys=keys)).df
    if buckets.by_time:
        out = out.withColumn(series.ts, bk.stamp(series, buckets, F.col(own)))
    return out.drop(own)


# ---------------------------------------------------------------------------
# State idioms
# ---------------------------------------------------------------------------


def state_var(series: Series, name: str, kind: str, value: Column, exclusive: bool = False) -> Series:
    """A running variable: ``sum``, ``min``, ``max``, ``first`` or ``last`` of an expression so far."""
    return series.using(running(series, {name: Fold(kind, value)}, exclusive=exclusive))


def state_from_query(
    series: Series, name: str, query: Series, value: Agg, start_us: int, end_us: int, *, where: Column | None = None,
    initial: Column | None = None, each: Column | None = None, action: str = "replace",
) -> Series:
    """A running variable that ticks set from a query: an aggregate of the query's ticks of their symbol in ``[t + start_us, t + end_us)``.

    Ticks that satisfy ``where`` (all, by default) set it; it keeps its value until the next one, and has ``initial`` before the first.  An
    empty result counts: with ``action='replace'`` the variable becomes NULL, with 'update' it stays as it was.  ``each`` is what every tick puts into
    the variable first, so that ticks which do not set it show that.
    """
    if action not in ("replace", "update"):
        raise ValueError("action is 'replace' or 'update'")
    found = f"{TMP}found"
    asked = window_join(series, query, {found: value}, start_us, end_us)
    sets = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    if action == "update":
        sets = sets & F.col(found).isNotNull()
    if each is not None:
        return series.using(asked.df.withColumn(name, F.when(sets, F.col(found)).otherwise(each)).drop(found))
    # in a struct, so that a NULL result is a value too
    last = running(asked, {name: Fold("last", F.when(sets, F.struct(F.col(found).alias("x"))))})
    before = F.lit(None) if initial is None else initial
    held = F.when(F.col(name).isNull(), before).otherwise(F.col(name)["x"])
    return series.using(last.withColumn(name, held).drop(found))


def last_n(series: Series, name: str, value: str, n: int) -> Series:
    """A deque of the last ``n`` values, newest first, including the current tick."""
    lags = {f"_tl_n{k}": (col(value), k) for k in range(1, n)}
    df = shift(series, lags) if lags else series.df
    window = F.array_compact(F.array(col(value), *[F.col(c) for c in lags]))
    return series.using(df.withColumn(name, window).drop(*lags))


def oldest_by(series: Series, columns: Sequence[str]) -> Series:
    """A tick set that keeps the oldest tick per key: the first tick of each value."""
    return series.using(distinct(series, columns, key_attrs_only=False).drop(BUCKET))


def present_before(series: Series, name: str, columns: Sequence[str]) -> Series:
    """Whether a tick with the same values came earlier (``present`` on a tick set)."""
    own = series.using(series.df, keys=(*series.keys, *[c for c in columns if c not in series.keys]))
    out = running(own, {name: Fold("sum", F.lit(1))}, exclusive=True)
    return series.using(out.withColumn(name, col(name).isNotNull()))


def find_latest(series: Series, collection: Series, fields: Mapping[str, str]) -> Series:
    """``find`` on a tick set that keeps the newest tick per key: its fields as of each tick."""
    return asof(series, collection, fields)


# ---------------------------------------------------------------------------
# Sub-queries, parameters, SQL
# ---------------------------------------------------------------------------


def eval_scalar(df: DataFrame) -> Column:
    """The single value of a one-row, one-column query, for use in another query."""
    return df.scalar()


def eval_symbols(series: Series, symbols: DataFrame) -> Series:
    """Only the symbols that another query returns."""
    return series.using(series.df.join(symbols.select(*series.keys).distinct(), [*series.keys], "left_semi"))


def with_symbol_params(series: Series, params: DataFrame) -> Series:
    """Per-symbol parameters as columns."""
    return series.using(series.df.join(params, [*series.keys], "left"))


def sql(spark: SparkSession, query: str, **tables: DataFrame | Series) -> DataFrame:
    """An SQL query over series and DataFrames, named by keyword in braces: ``FROM {trades}``."""
    return spark.sql(query, **{n: t.df if isinstance(t, Series) else t for n, t in tables.items()})
