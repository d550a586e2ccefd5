"""What the operators share: the folder for intermediate tables, words, hashes, small graph steps."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_FOLDER: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines see: spark.checkpoint.dir.  Where it is unset, one of our own on a local master, an error elsewhere."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("a cluster needs a shared folder in spark.checkpoint.dir")
    if not _OWN_FOLDER:
        _OWN_FOLDER.append("file://" + tempfile.mkdtemp(prefix="tickloom-"))
    return _OWN_FOLDER[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: work done once, lineage cut, safe when an executor is lost."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not have, in any spelling of case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class WordHashes:
    """64-bit hashes of words (bytes), remembered up to ``limit`` words."""

    def __init__(self, limit: int = 800_000):
        self.known: dict[bytes, int] = {}
        self.limit = limit

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.limit:
            self.known.clear()
        new = set(words).difference(self.known)
        self.known.update(zip(new, map(xxhash.xxh64_intdigest, new), strict=True))
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


#: ASCII white space (fixed values), and a random number for every other byte.
_GAP = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BYTE = np.where(_GAP, 0, np.random.default_rng(20_240_229).integers(1, 2**64, 256, np.uint64)).astype(np.uint64)
_BASE = 0xD6E8FEB86659FD93  # an odd number; fixed value
_POWERS = [np.ones(1, np.uint64)]


def word_hashes(text: bytes) -> np.ndarray:
    """The 64-bit hash of each word of a text (runs of bytes other than ASCII white space), in order, without a loop over words."""
    raw = np.frombuffer(text, np.uint8)
    gap = _GAP[raw]
    start = np.flatnonzero(~gap & np.append(True, gap[:-1])[: len(gap)])
    if not len(start):
        return np.zeros(0, np.uint64)
    place = np.arange(start[0], len(raw)) - np.repeat(start, np.diff(np.append(start, len(raw))))
    longest = int(place.max()) + 1
    if len(_POWERS[0]) < longest:
        size = max(4096, 1 << longest.bit_length())
        _POWERS[0] = np.cumprod(np.append(np.uint64(1), np.full(size - 1, _BASE, np.uint64)), dtype=np.uint64)
    with np.errstate(over="ignore"):
        return mixed(np.add.reduceat(_BYTE[raw[start[0] :]] * _POWERS[0][place], start - start[0]))


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finaliser of SplitMix64: fixed values)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of n consecutive words."""
    with np.errstate(over="ignore"):
        out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
        for k in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - n + 1 + k]
    return mixed(out)


def components(edges: DataFrame, name: str = "component") -> DataFrame:
    """(node, component) of every node in edges (a, b): the smallest node that links lead to.

    Each round hooks a tree's label onto the smallest label next to it and then shortens label chains by one
    self-join, so the rounds grow with the logarithm of a component's width.  Labels stay in Spark.
    """
    both = stored(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges"
    )
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("other")), "b")
            .join(labels.select(F.col("node").alias("a"), "label"), "a")
        )
        # what a label should point to: the smallest label beside any of its nodes; a table, so that Spark can split
        # the join below where one label has very many nodes
        hooks = stored(near.groupBy("label").agg(F.min("other").alias("lower")).where("lower < label"), "hooks")
        moved = labels.join(hooks, "label", "left").select(
            "node", "label", F.coalesce("lower", "label").alias("next")
        )
        jump = moved.select(F.col("node").alias("next"), F.col("next").alias("further"))
        step = stored(
            moved.join(jump, "next", "left").select("node", F.least("next", F.coalesce("further", "next")).alias("new"), "label"), "labels"
        )
        changed = step.where("new <> label").limit(1).count()
        labels = step.select("node", F.col("new").alias("label"))
        if not changed:
            return labels.select("node", F.col("label").alias(name))
