"""Sequential outlier removal, made parallel by summarising each time slice as a function.

A tick is kept when its value is within a factor of the last *kept* value, so the outcome
depends on everything before.  But a slice acts on the value it is entered with in a simple
way: the first tick close enough to that value is kept, and from there on the path is fixed.
Each slice is therefore reduced to a few value ranges with their exit value; the ranges are
chained per key, and a second pass filters every slice with its known entry value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.core import TMP, Series, col


def _next_close(values: np.ndarray, i: int, factor: float) -> int:
    """Position of the first later value close to ``values[i]``, or -1; looks ahead in growing blocks."""
    start, width = i + 1, 64
    while start < len(values):
        block = values[start : start + width]
        near = np.flatnonzero(np.maximum(block, values[i]) <= factor * np.minimum(block, values[i]))
        if len(near):
            return start + int(near[0])
        start, width = start + width, width * 4
    return -1


def _summarise(values: np.ndarray, factor: float) -> list[tuple[float, float, float]]:
    """Ranges of entry values with the exit value each leads to; uncovered entries pass through.

    The row with a NaN range answers the case of no entry value yet.
    """
    leave = values.copy()
    for i in range(len(values) - 1, -1, -1):
        j = _next_close(values, i, factor)
        if j >= 0:
            leave[i] = leave[j]
    out = [(np.nan, np.nan, leave[0])]
    covered: list[tuple[float, float]] = []
    for v, x in zip(values.tolist(), leave.tolist()):
        low, high = v / factor, v * factor
        pieces = [(low, high)]
        for a, b in covered:
            pieces = [p for lo, hi in pieces for p in ((lo, min(hi, a)), (max(lo, b), hi)) if p[0] < p[1]]
        if not pieces:
            continue
        out.extend((lo, hi, x) for lo, hi in pieces)
        merged: list[tuple[float, float]] = []
        for lo, hi in sorted([*covered, (low, high)]):
            if merged and lo <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
            else:
                merged.append((lo, hi))
        covered = merged
    return out


def _runs(pdf: pd.DataFrame, ids: list[str]) -> Iterator[tuple[tuple, int, int]]:
    """Consecutive rows with equal ids, as (ids, first row, end row)."""
    changed = np.zeros(len(pdf), dtype=bool)
    changed[:1] = True
    for c in ids:
        values = pdf[c].to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    starts = np.flatnonzero(changed).tolist()
    keys = zip(*[pdf[c].to_numpy()[starts].tolist() for c in ids])
    yield from zip(keys, starts, [*starts[1:], len(pdf)])


def skip_bad_tick(
    series: Series, field: str, jump_threshold: float, *, use_absolute_values: bool = False, discard_on_match: bool = False
) -> Series:
    """Keep ticks within the factor ``jump_threshold`` of the last kept tick of their key.

    The first tick of a key is kept.  Values are positive, or their magnitudes count (``use_absolute_values``).  ``discard_on_match`` gives the
    other ticks.
    """
    keys, sl, looked = list(series.keys), f"{TMP}slice", field
    df = series.df.withColumns({sl: series.slices()[0], f"{TMP}us": series.us})
    if use_absolute_values:
        field = f"{TMP}magnitude"
        df = df.withColumn(field, F.abs(col(looked)))
    order = [f"{TMP}us", *series.seq]
    ids = [*keys, sl]
    factor = float(jump_threshold)

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A slice may continue in the next batch: its values are kept until it ends.
        current, parts = None, []

        def close() -> list[tuple]:
            return [(*current, *row) for row in _summarise(np.concatenate(parts), factor)] if parts else []

        for pdf in batches:
            rows, values = [], pdf[field].to_numpy(dtype=float)
            for key, a, b in _runs(pdf, ids):
                if key != current:
                    rows += close()
                    current, parts = key, []
                parts.append(values[a:b])
            yield pd.DataFrame(rows, columns=[*ids, "low", "high", "leave"])
        yield pd.DataFrame(close(), columns=[*ids, "low", "high", "leave"])

    id_fields = df.select(*ids).schema.fields
    ranges_schema = T.StructType([*id_fields, *T._parse_datatype_string("low double, high double, leave double").fields])
    slim = df.select(*ids, *order, field).repartition(*ids).sortWithinPartitions(*ids, *order)
    ranges = slim.mapInPandas(summarise, ranges_schema)

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Few ranges per slice, streamed in slice order; only the running value is remembered.
        owner, current, here, entry, found = None, np.nan, None, np.nan, False
        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False, name=None):
                *key, s, low, high, leave = row
                if key != owner:
                    owner, current, here = key, np.nan, None
                if s != here:
                    here, entry, found = s, current, False
                    rows.append((*key, s, entry))
                hit = low != low if entry != entry else low <= entry <= high
                if hit and not found:
                    current, found = leave, True
            yield pd.DataFrame(rows, columns=[*ids, "entry"])

    entries_schema = T.StructType([*id_fields, T.StructField("entry", T.DoubleType())])
    per_key = ranges.repartition(*keys) if keys else ranges.repartition(1)  # a few rows per slice
    entries = per_key.sortWithinPartitions(*ids).mapInPandas(chain, entries_schema)

    dropped = ["entry", sl, f"{TMP}us", *([field] if use_absolute_values else [])]

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, current = None, np.nan
        for pdf in batches:
            keep, values, entry = [], pdf[field].to_numpy(dtype=float).tolist(), pdf["entry"].tolist()
            for here, a, b in _runs(pdf, ids):
                if here != key:
                    key, current = here, entry[a]
                for v in values[a:b]:
                    near = current != current or max(v, current) <= factor * min(v, current)
                    keep.append(near != discard_on_match)
                    current = v if near else current
            yield pdf.loc[np.array(keep, dtype=bool)].drop(columns=dropped)

    joined = df.join(entries, ids).repartition(*ids).sortWithinPartitions(*ids, *order)
    out_schema = T.StructType([f for f in joined.schema.fields if f.name not in dropped])
    return series.using(joined.mapInPandas(pick, out_schema))
