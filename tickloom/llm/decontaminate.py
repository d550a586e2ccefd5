"""Operator 6: documents that hold benchmark passages, exactly or paraphrased, found in a latent semantic space.

Weights are TF-IDF over the benchmark's words, with document frequencies of the whole corpus.  The space is spanned by the
leading right singular vectors of the matrix of benchmark passages, by a randomised SVD whose products are sums over
Spark's partitions: it has to tell benchmark passages apart, which the corpus's own leading directions (its common
words) do not.  Every window of every document is projected and compared by cosine with every passage, a block of windows at a
time; pairs above a threshold are checked by the longest common subsequence of their words and by the passage's answer.  A space of
bounded rank keeps less of each passage the more passages there are, so pairs that share enough of a passage's rarest words are
checked too: no window that passes the check has fewer of them (``Rare``), whatever its cosine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored

#: Words of a passage at most, and of a half window; a window is two halves, so some window holds any passage whole.
HALF = 32


def passages(text: str | None) -> list[list[bytes]]:
    """A text's words, A-Z lower-cased, cut into parts of nearly equal length of at most HALF words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    parts = max(1, -(-len(words) // HALF))
    cut = [round(k * len(words) / parts) for k in range(parts + 1)]
    return [words[a:b] for a, b in zip(cut, cut[1:], strict=False) if b > a]


def common(passage: list[bytes], window: list[bytes]) -> int:
    """Length of the longest common subsequence, all places of the passage at once as bits of one number."""
    where: dict[bytes, int] = {}
    for k, w in enumerate(passage):
        where[w] = where.get(w, 0) | 1 << k
    full = (1 << len(passage)) - 1
    row = full
    for w in window:
        hit = where.get(w)
        if hit:
            u = row & hit
            row = ((row + u) | (row - u)) & full
    return len(passage) - row.bit_count()


def holds(window: list[bytes], run: list[bytes]) -> bool:
    """Whether the words of run stand in the window, one after another."""
    n = len(run)
    return any(window[k] == run[0] and window[k : k + n] == run for k in range(len(window) - n + 1)) if n else False


@dataclass
class Rare:
    """Each passage's rarest words, listed by word.

    A window that holds a passage has at least ``need`` of its n words, so it lacks at most n - need of them, and of the n - need + 3
    rarest it has at least 3 (all of ``need``, if that is less).
    """

    start: np.ndarray  # of each term's list, and the end of the last
    passage: np.ndarray
    count: np.ndarray  # places of the term among the passage's rarest
    least: np.ndarray  # of each passage

    @classmethod
    def of(cls, texts: list[list[bytes]], terms: dict[bytes, int], df: np.ndarray, loose: float, least_words: int) -> Rare:
        lists, least = [], []
        for p, text in enumerate(texts):
            n = len(text)
            need = n if n < least_words else max(1, math.ceil(loose * n - 1e-9))
            least.append(min(3, need))
            k, count = np.unique(sorted((terms[w] for w in text), key=lambda t: (df[t], t))[: n - need + least[-1]], return_counts=True)
            lists.append((k, np.full(len(k), p), count))
        term, passage, count = (np.concatenate(x) for x in zip(*lists, strict=True))
        order = np.argsort(term, kind="stable")
        return cls(np.searchsorted(term[order], np.arange(len(terms) + 1)), passage[order], count[order].astype(np.float32), np.array(least))

    def shared(self, half: np.ndarray, term: np.ndarray, n_half: int) -> np.ndarray:
        """half x passage: how many places of a passage's rarest words the words (half, term) fill; a word counts once."""
        n_terms, n = len(self.start) - 1, len(self.least)
        half, term = np.divmod(np.unique(half * n_terms + term), n_terms)
        size = self.start[term + 1] - self.start[term]
        at = np.arange(size.sum()) + np.repeat(self.start[term] - np.cumsum(size) + size, size)
        return np.bincount(np.repeat(half, size) * n + self.passage[at], self.count[at], n_half * n).astype(np.float32).reshape(n_half, n)


@dataclass
class Space:
    """What tasks need to search: its size is set by the benchmark alone."""

    terms: dict[bytes, int]
    basis: np.ndarray  # terms x rank, already weighted by IDF
    points: np.ndarray  # passages x rank, of length 1
    items: list[int]
    texts: list[list[bytes]]
    answers: list[list[bytes]]
    df: np.ndarray  # of terms, in windows of the corpus
    rare: Rare | None = None


def _document_frequency(docs: DataFrame, terms: dict[bytes, int]) -> np.ndarray:
    """In how many windows of the corpus each benchmark word occurs; its last entry counts the windows."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        count = np.zeros(len(known) + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = (text or b"").lower().split()
                ids = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
                at = np.flatnonzero(ids >= 0)
                pair = np.unique(at // (2 * HALF) * len(known) + ids[at])
                count[:-1] += np.bincount(pair % max(1, len(known)), minlength=len(known))
                count[-1] += -(-len(words) // (2 * HALF))
        k = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(count[k])], names=["term", "n"])

    out = np.zeros(len(terms) + 1, np.int64)
    for r in docs.select(F.col("text").cast("binary")).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["term"]] = r["n"]
    return out


def _svd(rows: DataFrame, n_terms: int, rank: int, power: int = 2, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors (terms x rank) of the sparse matrix with rows (terms, weights): randomised, with ``power`` iterations.

    Each product A'(A Q) is one pass over the rows; partitions send terms x rank sums, which a grouped sum by term adds up.
    """
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, rank)))[0]
    for _ in range(power + 1):
        sent = rows.sparkSession.sparkContext.broadcast(q)

        def product(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            q = sent.value  # noqa: B023
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for t, w in zip(batch["terms"], batch["weights"], strict=True):
                    y = w @ q[t]
                    for k, x in zip(t.tolist(), w.tolist(), strict=True):
                        total[k] = total.get(k, 0) + x * y
            if total:
                yield pd.DataFrame({"term": list(total), "row": [x.tolist() for x in total.values()]})

        part = rows.mapInPandas(product, "term int, row array<double>").select("term", F.posexplode("row").alias("at", "x"))
        z = np.zeros((n_terms, rank))
        for r in part.groupBy("term", "at").agg(F.sum("x").alias("x")).groupBy("term").agg(F.collect_list(F.struct("at", "x")).alias("row")).toLocalIterator():
            for cell in r["row"]:
                z[r["term"], cell["at"]] = cell["x"]
        q = np.linalg.qr(z)[0]
        sent.unpersist()
    return q


def latent_space(docs: DataFrame, benchmark: DataFrame, *, rank: int = 128, answer_words: int = 5) -> Space | None:
    """The space for (item_id, text[, answer]) over docs (text); None without a benchmark word.

    The benchmark is taken to the driver: it is the stated query set.  Null texts have no passages.  Without an answer, an item's answer
    is its last ``answer_words`` words.
    """
    columns = ["item_id", "text", *(["answer"] if "answer" in benchmark.columns else [])]
    items, texts, answers = [], [], []
    for r in benchmark.select(*columns).where("item_id is not null").distinct().orderBy("item_id", "text").toLocalIterator():
        parts = passages(r["text"])
        answer = ((r["answer"] or "") if len(columns) == 3 else "").encode().lower().split() or [w for p in parts for w in p][-answer_words:]
        for p in parts:
            items.append(r["item_id"])
            texts.append(p)
            answers.append(answer)
    terms = {w: k for k, w in enumerate(sorted({w for p in texts for w in p}))}
    if not terms:
        return None
    df = _document_frequency(docs, terms)
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 0.1
    rows = []
    for p in texts:
        k, n = np.unique([terms[w] for w in p], return_counts=True)
        w = n * idf[k]
        rows.append((k.tolist(), (w / np.linalg.norm(w)).tolist()))
    matrix = stored(docs.sparkSession.createDataFrame(rows, "terms array<int>, weights array<double>"), "passages")
    basis = _svd(matrix, len(terms), min(rank, len(rows), len(terms)))
    points = np.stack([np.array(w) @ basis[np.array(t)] for t, w in rows])
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)
    return Space(terms, (basis * idf[:, None]).astype(np.float32), points.astype(np.float32), items, texts, answers, df[:-1])


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", cosine: float = 0.4, near: float = 0.75,
    loose: float = 0.55, least_words: int = 8, rank: int = 128,
) -> DataFrame:
    """(doc_id, item_id, cosine, share, answer) for each document and benchmark item that it holds; the best window of each pair.

    A passage of an item is held if the longest common subsequence of a window and the passage has at least ``near`` of the passage's
    words, or ``loose`` of them and the item's answer stands in the window.  A passage of fewer than ``least_words`` words
    must stand there word for word.  ``cosine`` and ``rank`` decide which pairs are checked besides those with enough shared words, which
    are all that can be held.  Null and empty texts hold nothing; rows with a null doc_id are left out; repeated
    rows give one result; an empty corpus or benchmark gives no rows; other columns are ignored.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    space = latent_space(docs, benchmark, rank=rank)
    schema = "doc_id long, item_id long, cosine double, share double, answer boolean"
    if space is None:
        return docs.sparkSession.createDataFrame([], schema)
    space.rare = Rare.of(space.texts, space.terms, space.df, loose, least_words)
    sent = docs.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s: Space = sent.value
        get = s.terms.get
        for batch in batches:
            bodies = batch.column(1).to_pylist()
            start = 0
            while start < len(bodies):
                stop, size = start, 0
                words: list[list[bytes]] = []
                while stop < len(bodies) and size < 200_000:
                    words.append((bodies[stop] or b"").lower().split())
                    size += len(words[-1])
                    stop += 1
                yield from search(s, get, batch.column(0).to_pylist()[start:stop], words)
                start = stop

    def search(s: Space, get, names: list[int], docs_words: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        halves = [max(1, -(-len(w) // HALF)) for w in docs_words]
        first = np.cumsum([0, *halves])
        sums = np.zeros((first[-1], s.basis.shape[1]), np.float32)
        ids = np.concatenate([np.fromiter((get(w, -1) for w in words), np.int64, len(words)) for words in docs_words])
        half = np.concatenate([f + np.arange(len(w)) // HALF for f, w in zip(first, docs_words, strict=False)]).astype(np.int64)
        at = np.flatnonzero(ids >= 0)
        if not len(at):
            return
        for a in range(0, len(at), 20_000):  # rows of one half may fall into two parts, so they are added, not set
            b = at[a : a + 20_000]
            cut = np.flatnonzero(np.append(True, half[b][1:] != half[b][:-1]))
            sums[half[b][cut]] += np.add.reduceat(s.basis[ids[b]], cut, axis=0)
        last = np.zeros(first[-1], bool)
        last[first[1:] - 1] = True
        window = sums.copy()
        window[:-1] += np.where(last[:-1, None], 0, sums[1:])
        window /= np.maximum(np.linalg.norm(window, axis=1, keepdims=True), 1e-9)
        best: dict[tuple[int, int], tuple[float, float, bool]] = {}
        known, known_half = ids[at], half[at]
        step = max(1, min(2048, 8_000_000 // len(s.items)))
        for a in range(0, len(window), step):
            near_to = window[a : a + step] @ s.points.T
            # of these halves and the one after them
            lo, hi = np.searchsorted(known_half, [a, a + len(near_to) + 1])
            shared = s.rare.shared(known_half[lo:hi] - a, known[lo:hi], len(near_to) + 1)
            shared = shared[:-1] + np.where(last[a : a + len(near_to), None], 0, shared[1:])
            at_window, at_passage = np.nonzero((near_to >= cosine) | (shared >= s.rare.least))
            at_doc = np.searchsorted(first, a + at_window, side="right") - 1
            last_k = -1
            for k, p, doc in zip(at_window.tolist(), at_passage.tolist(), at_doc.tolist(), strict=True):
                if k != last_k:
                    begin = (a + k - int(first[doc])) * HALF
                    shown, last_k = docs_words[doc][begin : begin + 2 * HALF], k
                    present = set(shown).__contains__
                passage = s.texts[p]
                if sum(map(present, passage)) < loose * len(passage):  # no common subsequence can be longer
                    continue
                if len(passage) < least_words:
                    share, answer = float(holds(shown, passage)), False
                    leak = share == 1
                else:
                    share = common(passage, shown) / len(passage)
                    answer = share >= loose and holds(shown, s.answers[p])
                    leak = share >= near or answer
                if leak:
                    key, row = (names[doc], s.items[p]), (float(near_to[k, p]), share, bool(answer))
                    if key not in best or row[1] > best[key][1]:
                        best[key] = row
        if best:
            cols = zip(*((*k, *v) for k, v in best.items()), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()), strict=True)],
                names=["doc_id", "item_id", "cosine", "share", "answer"],
            )

    found = docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, schema)
    best = F.max(F.struct("share", "answer", "cosine")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.cosine", "b.share", "b.answer")
