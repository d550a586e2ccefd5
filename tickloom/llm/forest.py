"""Operator 5: nearest neighbours by inner product, with a forest of random-projection trees.

A tree splits a bounded sample of the vectors again and again, each time at the median of its projections on the
difference of two random points, so leaves hold about as many vectors each.  Every row is put into its leaf of every
tree.  A query walks all trees at once with one priority queue: next comes the branch whose worst margin is best,
in whatever tree, until enough leaves are open.  Spark brings each leaf's rows and its queries together; a task
multiplies a block of one with a block of the other and keeps the best of each query, and the best of all leaves are ranked.

Equal vectors are one point with a list of its smallest ids, as only those can be among a query's nearest.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import stored


@dataclass
class Tree:
    """Inner nodes: direction, threshold, and two children; a child below 0 is leaf -1 - child."""

    direction: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    leaves: int

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of x."""
        out = np.zeros(len(x), np.int64)
        work = [(0, np.arange(len(x)))] if len(self.threshold) else []
        while work:
            node, rows = work.pop()
            right = x[rows] @ self.direction[node] > self.threshold[node]
            for side, part in ((0, rows[~right]), (1, rows[right])):
                to = int(self.child[node, side])
                if not len(part):
                    continue
                if to < 0:
                    out[part] = -1 - to
                else:
                    work.append((to, part))
        return out


def grow(x: np.ndarray, leaf_rows: int, rng: np.random.Generator) -> Tree:
    direction, threshold, child = [], [], []
    leaves = 0

    def split(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf_rows:
            a, b = x[rng.choice(rows, 2, replace=False)]
            d = (a - b) / max(np.linalg.norm(a - b), 1e-12)
            at = x[rows] @ d
            t = float(np.median(at))
            if (at > t).any():
                node = len(threshold)
                direction.append(d)
                threshold.append(t)
                child.append([0, 0])
                for side, part in ((0, rows[at <= t]), (1, rows[at > t])):
                    child[node][side] = split(part)
                return node
        leaves += 1
        return -leaves

    if len(x):
        split(np.arange(len(x)))
    if not threshold:
        return Tree(np.zeros((0, 0)), np.zeros(0), np.zeros((0, 2), np.int64), 1)
    return Tree(np.array(direction), np.array(threshold), np.array(child, np.int64), leaves)


def visit(trees: list[Tree], q: np.ndarray, leaves: int) -> list[tuple[int, int]]:
    """The (tree, leaf) pairs that a query opens, best first: one queue over all trees, ordered by the worst margin on the way."""
    margins = [t.direction @ q - t.threshold if len(t.threshold) else np.zeros(0) for t in trees]
    queue = [(-np.inf, k, 0 if len(t.threshold) else -1) for k, t in enumerate(trees)]
    out = []
    while queue and len(out) < leaves:
        cost, k, node = heapq.heappop(queue)
        if node < 0:
            out.append((k, -1 - node))
            continue
        m = margins[k][node]
        near, far = (1, 0) if m > 0 else (0, 1)
        heapq.heappush(queue, (cost, k, int(trees[k].child[node, near])))
        heapq.heappush(queue, (max(cost, abs(m)), k, int(trees[k].child[node, far])))
    return out


def usable(vectors: DataFrame, vec_id: str, vec: str) -> DataFrame:
    """(id, vec) without null ids and vectors, zero vectors, and vectors with a null or non-finite component."""
    v = F.col(vec).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), v.alias("vec")).where("id is not null and vec is not null")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(fine & F.exists("vec", lambda x: x != 0))


def nearest(
    vectors: DataFrame, *, vec_id: str = "vec_id", vec: str = "embedding", every: int = 20, k: int = 20, n_trees: int = 12, leaf_rows: int = 400,
    open_leaves: int = 160, sample: int = 50_000, seed: int = 11, block: int = 4000,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` nearest found for each row whose id is divisible by ``every``, against all rows.

    Nearness is the inner product in double precision; ties go to the smaller id; a row is no neighbour of itself.  Rows without a
    usable vector take no part; vectors of another length than the most frequent one are an error.  Rows that repeat an id with one vector
    count once; with different vectors, each counts.  Fewer rows than k give all of them; other columns are ignored.
    Trees are fitted on the ``sample`` vectors with the smallest hashes; every row is in the index.
    """
    points = stored(usable(vectors, vec_id, vec).dropDuplicates(["id", "vec"]), "points")
    sizes = [r["n"] for r in points.select(F.size("vec").alias("n")).distinct().limit(2).collect()]
    schema = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return vectors.sparkSession.createDataFrame([], schema)
    if len(sizes) > 1:
        raise ValueError("vectors differ in length")
    # equal vectors: one point, with the k + 1 smallest ids
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = points.withColumn("_k", place).where(F.col("_k") <= k + 1).groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    groups = stored(few.select("vec", "ids", F.element_at("ids", 1).alias("point")), "groups")
    picked = groups.orderBy(F.xxhash64("point"), "point").limit(sample).select("vec")
    base = np.array([r["vec"] for r in picked.toLocalIterator()])
    rng = np.random.default_rng(seed)
    trees = [grow(base, leaf_rows, rng) for _ in range(n_trees)]
    sent = vectors.sparkSession.sparkContext.broadcast(trees)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = np.stack(b["vec"].to_numpy())
                for t, tree in enumerate(sent.value):
                    yield pd.DataFrame({"tree": np.int32(t), "leaf": tree.leaf(x), "point": b["point"], "vec": b["vec"]})

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(t, leaf, point, v) for point, v in zip(b["point"], b["vec"], strict=True) for t, leaf in visit(sent.value, v, open_leaves)]
            yield pd.DataFrame(rows, columns=["tree", "leaf", "point", "vec"])

    kind = "tree int, leaf long, point long, vec array<double>"
    rows = groups.select("point", "vec").mapInPandas(index, kind)
    # a query point stands for all queries with its vector
    asking = points.where(F.col("id") % every == 0).join(groups.select("vec", "point"), "vec")
    queries = asking.groupBy("vec", "point").agg(F.count("*").alias("n")).select("point", "vec").mapInPandas(walk, kind)
    # crowded leaves in parts of about ``block`` rows; each part meets all of the leaf's queries
    rows = stored(rows, "index")
    parts = rows.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / block).alias("parts"))
    placed = rows.join(parts, ["tree", "leaf"]).select("tree", "leaf", F.pmod(F.xxhash64("point"), "parts").alias("part"), "point", "vec")
    asked = queries.join(parts, ["tree", "leaf"]).select("tree", "leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "point", "vec")

    def best(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The k + 1 best points of a leaf's part for each of its queries, that many so that one can be the query itself."""
        if not len(left) or not len(right):
            return pd.DataFrame({"query": [], "point": [], "score": []}).astype({"query": "int64", "point": "int64", "score": "float64"})
        x, names = np.stack(right["vec"].to_numpy()), right["point"].to_numpy()
        order = np.argsort(names)
        x, names = x[order], names[order]
        out = []
        for a in range(0, len(left), 512):
            q = np.stack(left["vec"].iloc[a : a + 512].to_numpy())
            score = q @ x.T
            for name, s in zip(left["point"].iloc[a : a + 512], score, strict=True):
                # ties at the edge all stay: the ids decide later
                edge = np.partition(s, -(k + 1))[-(k + 1)] if len(s) > k + 1 else -np.inf
                hit = np.flatnonzero(s >= edge - abs(edge) * 1e-12) if np.isfinite(edge) else np.arange(len(s))
                out.append(pd.DataFrame({"query": name, "point": names[hit], "score": s[hit]}))
        return pd.concat(out)

    found = asked.groupBy("tree", "leaf", "part").cogroup(placed.groupBy("tree", "leaf", "part")).applyInPandas(best, "query long, point long, score double")
    # one place per pair of points, whatever the trees they met in
    found = found.groupBy("query", "point").agg(F.max("score").alias("rough"))
    top = F.rank().over(Window.partitionBy("query").orderBy(F.desc("rough")))
    short = found.withColumn("_k", top).where(F.col("_k") <= 2 * (k + 1)).select("query", "point")
    # exact reranking on the original vectors, summed in one order
    pair = short.join(groups.select(F.col("point").alias("query"), F.col("vec").alias("qv")), "query").join(groups.select("point", "vec", "ids"), "point")
    exact = F.aggregate(F.zip_with("qv", "vec", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    scored = pair.select("query", exact.alias("score"), F.explode("ids").alias("vec_id"))
    wide = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    lists = scored.withColumn("_k", wide).where(F.col("_k") <= k + 1).drop("_k")
    out = asking.select(F.col("point").alias("query"), F.col("id").alias("query_id")).distinct().join(lists, "query").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
