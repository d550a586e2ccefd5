"""Operator 4: documents linked by the Jaccard overlap of their word n-grams, found by T-occurrence search.

A document x can only link to documents that hold at least T = ceil(t |x|) of its shingles.  In one total order of all
shingles, the rarest first, two linked documents have c common shingles among their first |x| - T + c: the short inverted lists.
Spark builds them for c = |x| / 10 and drops documents that share fewer than c lists with anybody, again and again.
Of the others, all documents of a list for c = 1 meet in the group of the list's smallest document, and there DivideSkip runs in full: the short lists are merged, the longest lists are set aside and probed by binary search, and
documents that reach the overlap are kept.  A group only looks for links that connect what is not connected yet, so
a group of g near copies gives g - 1 links, never g * g.

Two rounds: the first sends each document to one group only, in blocks of bounded size.  The second takes the lists whose
documents are still in different components, each whole, with crowded groups cut into pairs of blocks; it makes the result exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import components, grams, mixed, stored, word_hashes


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's runs of ``size`` words, A-Z lower-cased; of fewer words, the whole text is the only run."""
    words = word_hashes((text or b"").lower())
    if not len(words):
        return words
    runs = np.sort(grams(words, min(size, len(words))))
    return runs[np.append(True, runs[1:] != runs[:-1])]


class Index:
    """Inverted lists of some documents' shingles; list entries are document numbers in ascending order."""

    def __init__(self, sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.docs = np.repeat(np.arange(len(sets)), sizes)[order]
        self.keys, self.first = np.unique(flat[order], return_index=True)
        self.last = np.append(self.first[1:], len(flat))
        self.sizes = sizes
        # every entry as one number, list first, so that many lists can be probed in one go
        self.entries = np.repeat(np.arange(len(self.keys)), self.last - self.first) * len(sets) + self.docs

    def search(self, x: np.ndarray, percent: int, open_: np.ndarray) -> np.ndarray:
        """Numbers of the documents marked in open_ whose overlap with x is at least ``percent`` % of the union (DivideSkip)."""
        need = -(-percent * len(x) // 100)
        at = np.searchsorted(self.keys, x)
        at = at[(at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == x)]
        first, last = self.first[at], self.last[at]
        length = last - first
        if len(at) < need or not need:
            return np.zeros(0, np.int64)
        # DivideSkip's number of long lists; mu = 0.0085 is the value its authors found to work well
        n_long = min(need - 1, int(need / (0.0085 * math.log2(max(2, length.max())) + 1)))
        order = np.argsort(length, kind="stable")
        short, long_ = order[: len(order) - n_long], order[len(order) - n_long :]
        merged = np.concatenate([self.docs[a:b] for a, b in zip(first[short].tolist(), last[short].tolist(), strict=True)])
        merged = merged[open_[merged]]
        # the lists are sorted runs, which a stable sort merges
        found, count = np.unique(np.sort(merged, kind="stable"), return_counts=True)
        keep = count >= need - n_long
        found, count = found[keep], count[keep]
        for a in range(0, len(long_), 64):
            alive = count + len(long_) - a >= need
            if not alive.all():
                found, count = found[alive], count[alive]
            if not len(found):
                break
            probe = (at[long_[a : a + 64], None] * len(self.sizes) + found).ravel()
            place = np.minimum(np.searchsorted(self.entries, probe), len(self.entries) - 1)
            count = count + (self.entries[place] == probe).reshape(-1, len(found)).sum(axis=0)
        union = len(x) + self.sizes[found] - count
        return found[100 * count >= percent * union]


def connect(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join each connected component of these documents: one fewer than it has documents."""
    if len(sets) < 3:  # a pair needs no index
        if len(sets) < 2 or not (len(sets[0]) and len(sets[1])):
            return []
        both = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if 100 * both >= percent * (len(sets[0]) + len(sets[1]) - both) else []
    index, open_ = Index(sets), np.ones(len(sets), bool)
    links = []
    for start in range(len(sets)):
        if not open_[start] or not len(sets[start]):
            continue
        open_[start] = False
        queue = [start]
        while queue:
            x = queue.pop()
            for y in index.search(sets[x], percent, open_).tolist():
                open_[y] = False
                queue.append(y)
                links.append((x, y))
    return links


def _profile(docs: DataFrame, size: int, buckets: int) -> DataFrame:
    """One pass: (doc_id, n, d1, d2) of each document, and rows of counts of shingles by hash bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            rows, cells = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = shingles(text, size)
                cells.append((s & np.uint64(buckets - 1)).astype(np.int32))
                rows.append((doc, len(s), *_digest(s)))
            if cells:
                counts += np.bincount(np.concatenate(cells), minlength=buckets)
            d, n, d1, d2 = zip(*rows, strict=True) if rows else ([], [], [], [])
            none = pa.nulls(len(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(d, pa.int64()), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), none.cast(pa.int32()), none.cast(pa.binary())],
                names=["doc_id", "n", "d1", "d2", "part", "counts"],
            )
        chunks = [counts[a : a + 4096].astype("<i8").tobytes() for a in range(0, buckets, 4096)] if counts.any() else []
        none = pa.nulls(len(chunks), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array(range(len(chunks)), pa.int32()), pa.array(chunks, pa.binary())], names=["doc_id", "n", "d1", "d2", "part", "counts"]
        )

    return docs.mapInArrow(run, "doc_id long, n long, d1 long, d2 long, part int, counts binary")


def _digest(s: np.ndarray) -> tuple[int, int]:
    m = mixed(s, 1)
    return int(m.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(m, initial=np.uint64(0)).view(np.int64))


def _rarity(profile: DataFrame, buckets: int) -> np.ndarray:
    """A byte for each bucket that grows with the number of shingles in it; buckets is the bound on what is collected and sent out."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts, "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["part", "counts"])

    summed = profile.where("part is not null").select("part", "counts").repartition("part").mapInArrow(add, "part int, counts binary")
    total = np.zeros(buckets, np.int64)
    for row in summed.toLocalIterator():
        x = np.frombuffer(row["counts"], "<i8")
        total[row["part"] * 4096 : row["part"] * 4096 + len(x)] = x
    return np.minimum(255, np.log2(total + 1) * 4).astype(np.uint8)


def _postings(docs: DataFrame, size: int, percent: int, rarity: np.ndarray) -> DataFrame:
    """(shingle, n, d1, d2, doc_id, short): the first |x| - T + |x| / 10 lists of each document; short: of the first |x| - T + 1.

    A task writes those of a set once.
    """
    sent = docs.sparkSession.sparkContext.broadcast(rarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = sent.value
        seen: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            keys, flags, rows = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = shingles(text, size)
                if not len(s) or doc is None:
                    continue
                who = (len(s), *_digest(s))
                if seen.get(who, doc + 1) <= doc:  # a copy with a larger id adds nothing
                    continue
                if len(seen) < 1_000_000:
                    seen[who] = doc
                short = len(s) - -(-percent * len(s) // 100) + 1
                order = (rank[(s & np.uint64(len(rank) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8))
                first = np.argsort(order)[: short - 1 + max(1, len(s) // 10)]
                keys.append(s[first])
                flags.append(np.arange(len(first)) < short)
                rows.append((*who, doc))
            for a in range(0, len(rows), 500):
                k, table = keys[a : a + 500], np.array(rows[a : a + 500], np.int64)
                table = np.repeat(table, [len(x) for x in k], axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(k).view(np.int64)), *(pa.array(table[:, c]) for c in range(4)), pa.array(np.concatenate(flags[a : a + 500]))],
                    names=["shingle", "n", "d1", "d2", "doc_id", "short"],
                )

    return docs.mapInArrow(run, "shingle long, n long, d1 long, d2 long, doc_id long, short boolean")


def _with_company(lists: DataFrame) -> DataFrame:
    """Lists of at least two nodes."""
    shared = lists.groupBy("shingle").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    # a table of its own, so that Spark can split a crowded list in the join
    return lists.join(stored(shared.select("shingle"), "shared"), "shingle", "left_semi")


def _links(docs: DataFrame, groups: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) inside each group (center, block, node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # groups follow each other; only one is held, as sets
        key, ids, sets = None, [], []
        out: list[tuple[int, int]] = []
        for batch in batches:
            for *here, node, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if here != key:
                    out.extend((ids[x], ids[y]) for x, y in connect(sets, percent))
                    key, ids, sets = here, [], []
                ids.append(node)
                sets.append(shingles(text, size))
        out.extend((ids[x], ids[y]) for x, y in connect(sets, percent))
        a, b = zip(*out, strict=True) if out else ([], [])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    # always the plan of large inputs, however few groups there are
    texts = groups.join(docs.select(F.col("doc_id").alias("node"), "text").hint("merge"), "node").select("center", "block", "node", "text")
    whole = texts.repartition("center", "block").sortWithinPartitions("center", "block", "node")
    return whole.mapInArrow(run, "a long, b long")


def near_groups(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, block: int = 1000,
) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    Two documents link when they share at least ``percent`` % of the distinct ``size``-word shingles they have together; component_id
    is the smallest doc_id reachable by links.  Null texts and texts without words have no shingles and stand alone; with fewer
    words than ``size`` the whole text is one shingle.  Rows that repeat a doc_id count as one document in each of their texts.  A null
    doc_id takes no part and is its own component (null).  Other columns are ignored; an empty table gives no rows.
    Shingles are 64-bit hashes.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    # the more documents, the finer the estimate of rarity; at most 4 MB
    buckets = 1 << min(22, max(16, docs.count().bit_length()))
    profile = stored(_profile(docs, size, buckets), "profile")
    facts = profile.where("part is null")
    same_set = facts.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("node"))
    lists = _postings(docs, size, percent, _rarity(profile, buckets)).repartition("shingle")
    lists = lists.groupBy("shingle", "n", "d1", "d2").agg(F.min("doc_id").alias("node"), F.first("short").alias("short"))
    # in the partitions that the lists are in already: one shuffle of all lists, and those of one document end here
    whole = Window.partitionBy("shingle")
    lists = lists.withColumns({"low": F.min("node").over(whole), "high": F.max("node").over(whole)}).where("low < high")
    lists = stored(lists.drop("d1", "d2", "low", "high"), "lists")
    # a partner has at least T words, so at least max(1, T // 10) lists are common
    least = F.greatest(F.lit(1), F.ceil(F.col("n") * percent / 100 - 1e-9) / 10).cast("long")
    for _ in range(2):
        enough = lists.groupBy("node", "n").count().where(F.col("count") >= least).select("node", "n")
        lists = stored(_with_company(lists.join(enough, ["node", "n"], "left_semi")), "lists")
    short = lists.where("short")
    center = short.groupBy("shingle").agg(F.min("node").alias("center"), F.max("node").alias("largest")).where("center < largest")
    shared = stored(short.join(center.select("shingle", "center"), "shingle").select("shingle", "node", "center"), "short-lists")

    # round 1: each document in the group of the document that it shares most of its lists with as their smallest
    often = shared.where("center < node").groupBy("node", "center").count()
    home = often.groupBy("node").agg(F.max(F.struct("count", -F.col("center"))).alias("m")).select("node", (-F.col("m.col2")).alias("center"))
    homes = stored(home, "homes")
    many = homes.groupBy("center").agg(F.ceil(F.count("*") / block).alias("blocks"))
    placed = homes.join(many, "center").select("center", F.pmod(F.xxhash64("node"), "blocks").alias("block"), "node")
    centers = many.select("center", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.col("center").alias("node"))
    links = stored(_links(docs, placed.unionByName(centers), size, percent), "links")
    label = components(links, "comp")

    # round 2: whole lists over which more than one component is left
    marked = shared.join(label, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed_lists = marked.groupBy("shingle").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("shingle")
    rest = stored(shared.join(mixed_lists, "shingle").select("center", "node").distinct(), "rest")
    many = rest.groupBy("center").agg(F.ceil(F.count("*") / block).alias("blocks"))
    own = F.pmod(F.xxhash64("node"), "blocks")
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda k: F.least(k, own) * F.col("blocks") + F.greatest(k, own))
    placed = rest.join(many, "center").select("center", F.explode(pairs).alias("block"), "node")
    more = stored(_links(docs, placed, size, percent), "links")
    label = components(links.unionByName(more), "component_id")

    of_set = same_set.join(label, "node", "left").select("n", "d1", "d2", F.coalesce("component_id", "node").alias("component_id"))
    return facts.join(of_set, ["n", "d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.least("component_id", "doc_id")).alias("component_id")
    )
