"""Operator 9: long word sequences that repeat across documents, found in suffix trees partitioned by prefix.

A suffix here is the run of ``window`` words that starts at some word of a document.  Suffixes that are equal share the run of
``gram`` words with the smallest hash among all such runs in them, at the same place, so that run is the prefix by which
suffixes are grouped (their order inside a tree does not matter, only which of them share a path).  Neighbouring suffixes
mostly share it, so a group gets one strip of text for a whole run of suffixes instead of one row for each.  Groups seen in
one document only cannot hold a repeat and go.  Every other group fits in memory: its suffixes become a tree level by level,
prefixes of 1, 2, 4 ... words; the nodes at depth ``window`` that several documents share are the repeats.  Crowded groups get the longest prefix there is, all ``window`` words, and are then plain counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import grams, mixed, stored, word_hashes

_PLACE = np.uint64((1 << 28) - 1)


def anchors(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix hash, first and last start of each run of windows that share their smallest ``gram``-word run."""
    n = len(hashes) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    g = grams(hashes, gram)
    low = (g & ~_PLACE) | np.arange(len(g), dtype=np.uint64)  # equal hashes: the leftmost
    width, left = 1, window - gram + 1
    while width * 2 <= left:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < left:
        low = np.minimum(low[: n], low[left - width : left - width + n])
    at = (low & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return g[at[first]], first, np.append(first[1:], n) - 1


def deep_nodes(words: np.ndarray, strip: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """For each place in ``words`` whether the ``window`` words from there also start in a strip of a smaller document.

    words: numbers of all strips' words; strip: the strip of each; doc: the document of each strip, as comparable numbers.
    The tree is grown by doubling: a place's node at depth 2k is the pair of its node at depth k and that of k words further on.
    """
    flagged = np.zeros(len(words), bool)
    if len(words) < window:
        return flagged
    alive = np.flatnonzero(strip[: len(strip) - window + 1] == strip[window - 1 :])
    node = words.astype(np.int64)
    depth = 1
    while True:
        far = min(depth, window - depth)  # the last step overlaps
        if far <= 0:
            break
        pair = node[: len(node) - far] * (int(node.max()) + 1) + node[far:]
        depth += far
        # numbers for the pairs; every place keeps one, for places before it need it
        node = np.unique(pair, return_inverse=True)[1]
    of = node[alive]
    owner = doc[strip[alive]]
    order = np.lexsort((owner, of))
    starts = np.flatnonzero(np.append(True, of[order][1:] != of[order][:-1]))
    smallest = np.repeat(owner[order][starts], np.diff(np.append(starts, len(order))))
    flagged[alive[order]] = owner[order] > smallest
    return flagged


def _runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    if not len(places):
        return places, places
    cut = np.flatnonzero(np.diff(places) != 1)
    return places[np.append(0, cut + 1)], places[np.append(cut, len(places) - 1)]


def _prefixes(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchors(word_hashes(t or b""), window, gram) for t in batch.column(3).to_pylist()]
            lists = [pa.array([x[k].view(np.int64) if k == 0 else x[k] for x in found], pa.list_(pa.int64())) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lists], names=["doc", "t1", "t2", "prefix", "first", "last"])

    return docs.mapInArrow(run, "doc long, t1 long, t2 long, prefix array<long>, first array<long>, last array<long>")


def _strips(texts: DataFrame, window: int) -> DataFrame:
    """One row for each run of suspect suffixes: its text once in a task (null when the task has sent it), or, in crowded groups, a row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[tuple[int, int], None] = {}
        for batch in batches:
            out = []
            for doc, t1, text, runs in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                words = text.split()
                with np.errstate(over="ignore"):
                    hashes = word_hashes(text)
                    sums = [np.append(np.uint64(0), np.cumsum(mixed(hashes, k) * _powers(len(words), _BASE[k]))) for k in (1, 2)]
                thin = [(r["first"], r["last"], r["prefix"]) for r in runs if not r["crowded"]]
                if thin:
                    first, last, _ = (np.array(c) for c in zip(*thin, strict=True))
                    both = [_hashes(s, first, last - first + window, k).tolist() for k, s in zip((1, 2), sums, strict=True)]
                    for (a, z, prefix), *h in zip(thin, *both, strict=True):
                        body, h = None, tuple(h)
                        if h not in sent:
                            if len(sent) > 500_000:
                                sent.clear()
                            sent[h] = None
                            body = b" ".join(words[a : z + window])
                        out.append((doc, t1, a, z, prefix, *h, body))
                every = [np.arange(r["first"], r["last"] + 1) for r in runs if r["crowded"]]
                if every:
                    at = np.concatenate(every)
                    both = [_hashes(s, at, window, k).tolist() for k, s in zip((1, 2), sums, strict=True)]
                    out.extend((doc, t1, p, p, None, x, y, None) for p, x, y in zip(at.tolist(), *both, strict=True))
            for k in range(0, len(out), 5000):
                cols = list(zip(*out[k : k + 5000], strict=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:7]), pa.array(cols[7], pa.binary())], names=_STRIP)

    return texts.mapInArrow(run, "doc long, t1 long, first long, last long, prefix long, h1 long, h2 long, body binary")


_STRIP = ["doc", "t1", "first", "last", "prefix", "h1", "h2", "body"]
_BASE = {1: 0x9E3779B97F4A7C15, 2: 0xC2B2AE3D27D4EB4F}  # odd numbers; fixed values
_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """base ** (0 .. n - 1) modulo 2 ** 64."""
    if len(_POWERS.get(base, ())) < n:
        size = max(4096, 1 << (n - 1).bit_length())
        _POWERS[base] = np.cumprod(np.append(np.uint64(1), np.full(size - 1, base, np.uint64)), dtype=np.uint64)
    return _POWERS[base][:n]


_INVERSE = {k: pow(b, -1, 1 << 64) for k, b in _BASE.items()}


def _hashes(sums: np.ndarray, first: np.ndarray, length: np.ndarray | int, k: int) -> np.ndarray:
    """Hashes of the word runs that start at ``first``, the same wherever they stand: each sum is divided by base ** start."""
    with np.errstate(over="ignore"):
        part = sums[first + length] - sums[first]
        return mixed(part * _powers(len(sums), _INVERSE[k])[first] + np.asarray(length).astype(np.uint64), k).view(np.int64)


def _trees(strips: DataFrame, window: int, batch_words: int = 1_500_000) -> DataFrame:
    """(h1, h2, low, high): places of each distinct strip from which the window also starts in a smaller document."""

    def grown(rows: list[tuple[int, int, int, int, bytes]]) -> pd.DataFrame:
        numbers: dict[bytes, int] = {}
        words, sizes = [], []
        for *_, body in rows:
            w = body.split()
            words.extend(numbers.setdefault(x, len(numbers)) for x in w)
            sizes.append(len(w))
        strip = np.repeat(np.arange(len(rows)), sizes)
        flagged = deep_nodes(np.array(words, np.int64), strip, np.array([r[3] for r in rows], np.int64), window)
        start = np.cumsum(sizes) - sizes
        hit = np.flatnonzero(flagged)
        low, high = _runs(hit)
        # a run of places never leaves its strip: a strip's last places are no starts
        of = strip[low]
        return pd.DataFrame({"h1": [rows[k][1] for k in of], "h2": [rows[k][2] for k in of], "low": low - start[of], "high": high - start[of]}).astype("int64")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, int, int, int, bytes]] = []
        total = 0
        for batch in batches:
            for row in zip(*(batch[c].tolist() for c in ("prefix", "h1", "h2", "doc", "body")), strict=True):
                if total >= batch_words and row[0] != held[-1][0]:
                    yield grown(held)
                    held, total = [], 0
                held.append(row)
                total += row[4].count(b" ") + 1
        if held:
            yield grown(held)

    one = strips.repartition("prefix").sortWithinPartitions("prefix")
    return one.select("prefix", "h1", "h2", "doc", "body").mapInPandas(run, "h1 long, h2 long, low long, high long")


def remove_repeats(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = 50, gram: int = 8, crowd: int = 20_000,
) -> DataFrame:
    """doc_id, n_words, removed (array of [start, end) word ranges, in order and apart) and kept (the other words, joined by one space).

    A word goes if it lies in a run of ``window`` words that also starts in a document with a smaller doc_id, judged on the
    input.  Words are runs of bytes other than ASCII white space.  Null and empty texts have no words.  Rows with a null doc_id take no
    part and stay whole; rows that repeat a doc_id are one document (they do not remove each other's words).  Other columns are
    ignored; an empty table gives no rows.  Words are compared as such inside trees and as 64- or 128-bit hashes elsewhere.
    """
    content = F.col(text).cast("binary")
    docs = docs.select(F.col(doc_id).cast("long").alias("doc"), F.xxhash64(content).alias("t1"), F.xxhash64(content, F.lit(1)).alias("t2"), content.alias("text"))
    profile = stored(_prefixes(docs, window, gram), "prefixes")
    # of exact copies only the smallest is looked into; the others are repeats as a whole
    smallest = profile.where("doc is not null").groupBy("t1", "t2").agg(F.min("doc").alias("origin"))
    own = profile.where("size(prefix) > 0").join(smallest, ["t1", "t2"]).where("doc = origin")
    runs = stored(own.select("doc", "t1", F.inline(F.arrays_zip("prefix", "first", "last"))), "runs")
    # tables of their own, so that Spark can split a crowded key in the joins with them
    suspect = runs.groupBy("prefix").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("n")).where("low < high")
    suspect = runs.join(stored(suspect.select("prefix", (F.col("n") > crowd).alias("crowded")), "suspects"), "prefix")
    per_doc = suspect.groupBy("doc", "t1").agg(F.collect_list(F.struct("first", "last", "prefix", "crowded")).alias("runs"))
    once = docs.join(per_doc, ["doc", "t1"]).select("doc", "t1", "text", "runs")
    strips = stored(_strips(once, window), "strips")

    seen = stored(strips.groupBy("h1", "h2").agg(F.min("doc").alias("origin")), "origins")
    seen = stored(strips.drop("body").join(seen, ["h1", "h2"]), "seen")
    whole = seen.where("doc > origin").select("doc", "t1", "first", "last")
    bodies = strips.where("body is not null").groupBy("prefix", "h1", "h2").agg(F.first("body").alias("body"))
    bodies = bodies.join(seen.where("prefix is not null").groupBy("h1", "h2").agg(F.min("origin").alias("doc")), ["h1", "h2"])
    inside = _trees(bodies, window)
    part = seen.where("doc = origin").join(inside, ["h1", "h2"]).select(
        "doc", "t1", (F.col("first") + F.col("low")).alias("first"), (F.col("first") + F.col("high")).alias("last")
    )
    gone = whole.unionByName(part).groupBy("doc", "t1").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    marked = docs.join(gone, ["doc", "t1"], "left").alias("d").join(
        profile.where("doc is not null").select("doc", "t1", "t2").join(smallest, ["t1", "t2"]).where("doc > origin")
        .select("doc", "t1").distinct().withColumn("copy", F.lit(True)).alias("c"), ["doc", "t1"], "left",
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text_, spans, copy in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                words = (text_ or b"").split()
                n = len(words)
                ranges: list[list[int]] = [[0, n]] if copy and n >= window else []
                if not ranges:
                    for a, b in sorted((s["first"], s["last"] + window) for s in spans or ()):
                        if ranges and a <= ranges[-1][1]:
                            ranges[-1][1] = max(b, ranges[-1][1])
                        else:
                            ranges.append([a, b])
                kept, at = [], 0
                for a, b in ranges:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                out.append((doc, n, [{"start": a, "end": b} for a, b in ranges], b" ".join(kept)))
            cols = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(cols[3], pa.binary())], names=["doc_id", "n_words", "removed", "kept"],
            )

    out = marked.select("doc", "text", "spans", "copy").mapInArrow(cut, "doc_id long, n_words long, removed array<struct<start: long, end: long>>, kept binary")
    return out.withColumn("kept", F.col("kept").cast("string"))
