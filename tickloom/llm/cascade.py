"""Operator 10: allow and block rules for urls, held in cascades of Bloom filters.

A cascade answers "is this key listed?" without a join and without error for every key of a known universe.
Level 1 holds the listed keys.  Level 2 holds the keys of the universe that level 1 wrongly accepts, level 3
the listed keys that level 2 wrongly accepts, and so on until nobody is wrong.  All levels together take a few
bytes per listed key, whatever the size of the universe, because the first level's error rate is set to
(listed / universe); so they can be sent to all tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import free_name, mixed, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Level:
    bits: bytes
    size: int  # in bits
    hashes: int
    seed: int

    def places(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        return _places(h1, h2, self.size, self.hashes, self.seed)

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        if not self.size:
            return np.zeros(len(h1), bool)
        at = self.places(h1, h2)
        words = np.frombuffer(self.bits, np.uint8)
        return ((words[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def _places(h1: np.ndarray, h2: np.ndarray, size: int, hashes: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        first, step = mixed(h1.view(np.uint64), seed), mixed(h2.view(np.uint64), seed) | np.uint64(1)
        at = first[:, None] + step[:, None] * np.arange(hashes, dtype=np.uint64)[None, :]
    return (mixed(at) % np.uint64(size)).astype(np.int64)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether each key is listed: the first level that rejects a key decides, odd levels against it, even ones for it."""
        listed = np.zeros(len(h1), bool)
        open_ = np.arange(len(h1))
        for k, level in enumerate(self.levels):
            inside = level.holds(h1[open_], h2[open_])
            listed[open_[~inside]] = k % 2 == 1
            open_ = open_[inside]
        listed[open_] = len(self.levels) % 2 == 1
        return listed


def _hashed(df: DataFrame) -> DataFrame:
    """Column key with the two hashes that all levels use."""
    return df.select("key", F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit(1)).alias("h2"))


def _level(keys: DataFrame, count: int, error: float, seed: int) -> Level:
    """The filter of keys.  Only its own words, whose number is set by the number of keys, come to the driver."""
    hashes = max(1, round(-math.log2(error)))
    size = max(64, 64 * math.ceil(count * hashes / math.log(2) / 64))

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def places(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(list(_places(h1.to_numpy(np.int64), h2.to_numpy(np.int64), size, hashes, seed)))

    bit = keys.select(F.explode(places("h1", "h2")).alias("at"))
    words = bit.groupBy((F.col("at") / 8).cast("long").alias("word")).agg(F.bit_or(F.expr("shiftleft(1, cast(at % 8 as int))")).alias("bits"))
    out = np.zeros(size // 8, np.uint8)
    for row in words.toLocalIterator():
        out[row["word"]] = row["bits"]
    return Level(out.tobytes(), size, hashes, seed)


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """A cascade exact for every key of the universe and every listed key (column key of both; null keys take no part).

    Repeated keys count once.  With nothing listed the cascade accepts nothing; with an empty universe it is one level.
    """
    inside = stored(_hashed(listed.where("key is not null").select("key").distinct()), "listed")
    known = _hashed(universe.where("key is not null").select("key").distinct())
    outside = stored(known.join(inside.select("key"), "key", "left_anti"), "universe")
    n_in, n_out = inside.count(), outside.count()
    if not n_in:
        return Cascade(())
    levels: list[Level] = []
    error = min(0.5, n_in / max(1, n_out) / math.sqrt(2))
    while n_in:
        level = _level(inside, n_in, error, len(levels))
        levels.append(level)

        @F.pandas_udf("boolean")
        def wrong(h1: pd.Series, h2: pd.Series) -> pd.Series:
            return pd.Series(level.holds(h1.to_numpy(np.int64), h2.to_numpy(np.int64)))

        accepted = stored(outside.where(wrong("h1", "h2")), "accepted")
        inside, outside = accepted, inside
        n_in, error = accepted.count(), 0.5
    return Cascade(tuple(levels))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; path: from there up to '?', '#' or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys under which a rule for this url could be listed, longest first.

    ``shapes`` are the pairs (labels of the host, characters of the path) that occur among the rules; a key of another
    shape cannot be listed.
    """
    if not shapes:
        return F.expr("cast(array() as array<string>)")
    ordered = sorted(shapes, reverse=True)
    pairs = F.array(*[F.struct(F.lit(c).alias("labels"), F.lit(n).alias("chars")) for c, n in ordered])
    labels = F.size(F.split(host, "\\."))

    def key(s: Column) -> Column:
        tail = F.array_join(F.slice(F.split(host, "\\."), labels - s["labels"] + 1, s["labels"]), ".")
        fits = (labels >= s["labels"]) & (F.length(path) >= s["chars"]) & (host != "")
        return F.when(fits, F.concat(tail, F.substr(path, F.lit(1), s["chars"])))

    keys = F.filter(F.transform(pairs, key), lambda k: k.isNotNull())
    return F.array_sort(keys, lambda a, b: F.length(b) - F.length(a))


def judge(
    pages: DataFrame, rules: Iterable[tuple[str, str, str]], *, url: str = "url", default: str = "allow",
) -> DataFrame:
    """pages plus host, path, rule and verdict; columns of pages with these names give way.

    rules: (verdict, host, path) with verdict 'allow' or 'block'.  A rule fits its host and all subdomains if the url's path
    starts with the rule's; the longest rule wins.  A null url, or one without '://', has an empty host and path and no rule.
    Where no rule fits, rule is null and the verdict is ``default``.  A key listed with both verdicts is an error.
    Repeated rows are judged alike.  The rules come as a list on the driver, so they are small; the urls may be many.
    """
    spark: SparkSession = pages.sparkSession
    listed = {}
    for verdict, host, path in rules:
        key = host.translate(str.maketrans(UPPER, LOWER)) + path
        if verdict not in ("allow", "block") or listed.setdefault(key, verdict) != verdict:
            raise ValueError(f"rule {verdict} {key}: verdicts are allow or block, one for each key")
    shapes = sorted({(k.partition("/")[0].count(".") + 1, len(k) - len(k.partition("/")[0])) for k in listed})
    host, path = host_and_path(F.col(url))
    parsed = pages.withColumns({"host": host, "path": path})
    keys = candidate_keys(F.col("host"), F.col("path"), shapes)
    universe = stored(pages.select(host.alias("host"), path.alias("path")).distinct().select(F.explode(keys).alias("key")).distinct(), "keys")
    rows = lambda verdict: spark.createDataFrame([(k,) for k, v in listed.items() if v == verdict], "key string")
    allow, block = build(rows("allow"), universe), build(rows("block"), universe)

    @F.pandas_udf("struct<rule string, verdict string>")
    def first_listed(keys: pd.Series, h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
        sizes = keys.map(len).to_numpy()
        a = np.fromiter((x for row in h1 for x in row), np.int64, sizes.sum())
        b = np.fromiter((x for row in h2 for x in row), np.int64, sizes.sum())
        kind = np.where(allow.holds(a, b), 1, np.where(block.holds(a, b), 2, 0))
        row = np.repeat(np.arange(len(keys)), sizes)
        hit = np.flatnonzero(kind)
        _, first = np.unique(row[hit], return_index=True)
        hit = hit[first]
        start = np.cumsum(sizes) - sizes
        rule, verdict = [None] * len(keys), [default] * len(keys)
        for i in hit:
            r = row[i]
            rule[r], verdict[r] = keys.iloc[r][i - start[r]], ("allow", "block")[kind[i] - 1]
        return pd.DataFrame({"rule": pd.Series(rule, dtype=object), "verdict": pd.Series(verdict, dtype=object)})

    own, hit = free_name(parsed, "keys"), free_name(parsed, "found")
    hashes = [F.transform(own, lambda k: F.xxhash64(k)), F.transform(own, lambda k: F.xxhash64(k, F.lit(1)))]
    found = parsed.withColumn(own, keys).withColumn(hit, first_listed(own, *hashes))
    return found.withColumns({"rule": F.col(f"{hit}.rule"), "verdict": F.col(f"{hit}.verdict")}).drop(own, hit)
