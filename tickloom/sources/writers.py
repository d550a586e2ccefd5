"""Where ticks go: stored series, parquet, delimited text, last-n snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.core import TMP, Series, col
from tickloom.functions.dates import strftime


def _in_range(series: Series, action: str) -> DataFrame:
    inside = (series.us >= series.start_us) & (series.us < series.end_us)
    if action == "ignore":
        return series.df.where(inside)
    if action == "load":
        return series.df
    if action == "exception":
        refuse = F.raise_error(F.concat(F.lit("tick outside the interval: "), col(series.ts).cast("string")))
        return series.df.where(F.when(inside, F.lit(True)).otherwise(refuse.cast("boolean")))
    raise ValueError("out_of_range is 'exception', 'ignore' or 'load'")


def write(
    series: Series,
    path: str,
    append: bool = True,
    out_of_range: str = "exception",
    symbol: str | None = None,
    partition_by_symbol: bool = False,
) -> None:
    """Store a series by day (and symbol, when symbols are few).

    Without ``append`` only the days present in the data are replaced.
    """
    df = _in_range(series, out_of_range) if series.start and series.end else series.df
    df = df.withColumn("date", F.to_date(col(series.ts)))
    parts = ["date", *([symbol or series.keys[0]] if partition_by_symbol else [])]
    # Ranges of (day, symbol, time) are of equal size: a large day is several tasks, and a task
    # writes few days.
    place = [*dict.fromkeys([*parts, *series.keys])]
    spread = df.repartitionByRange(*place, *series.order).sortWithinPartitions(*place, *series.order)
    writer = spread.write.partitionBy(*parts)
    if append:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str = "snappy", row_group_bytes: int | None = None,
    mode: str = "error",
) -> None:
    writer = df.write.mode(mode).option("compression", compression)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def as_text(df: DataFrame, formats: Mapping[str, str] | None = None) -> DataFrame:
    """Columns as text; ``formats`` are ``%.2f`` style for numbers, ``%Y-%m-%d`` style for times."""
    formats = formats or {}

    def shown(c: str) -> Column:
        fmt = formats.get(c)
        if fmt is None:
            return col(c).cast("string")
        if df.schema[c].dataType.typeName().startswith("timestamp"):
            return strftime(c, fmt)
        return F.format_string(fmt, col(c))

    return df.select(*[shown(c).alias(c) for c in df.columns])


def write_text(
    df: DataFrame, path: str, separator: str = ",", header: bool = True, order: Sequence[str] | None = None,
    formats: Mapping[str, str] | None = None, mode: str = "error",
) -> None:
    chosen = df if order is None else df.select(*order, *[c for c in df.columns if c not in order])
    as_text(chosen, formats).write.mode(mode).option("sep", separator).option("header", header).csv(path)


def snapshot(series: Series, num_ticks: int = 1, group_by: Sequence[str] = ()) -> DataFrame:
    """The last ``num_ticks`` ticks of each key and group."""
    rank = f"{TMP}rank"
    w = Window.partitionBy(*series.keys, *group_by).orderBy(*[o.desc() for o in series.order])
    return series.df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= num_ticks).drop(rank)


def save_snapshot(series: Series, path: str, num_ticks: int = 1, group_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    snapshot(series, num_ticks, group_by).write.mode(mode).parquet(path)


def read_snapshot(spark: SparkSession, path: str, **options: object) -> Series:
    return Series(spark.read.parquet(path), **options)


def show_snapshots(spark: SparkSession, database: str, pattern: str = "*") -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{database}` LIKE '{pattern}'").select("tableName")


def find_snapshot_symbols(spark: SparkSession, path: str, key: str, pattern: str = "%") -> DataFrame:
    return spark.read.parquet(path).select(key).where(col(key).cast("string").like(pattern)).distinct()
