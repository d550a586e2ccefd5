"""Operator 3: which documents to keep, from a text classifier and what is known of their hosts and paths.

Two logistic classifiers (good quality; toxic) are fitted here on a bounded sample of labelled rows and score every
document.  Grouped sums of the scores give each host and each path of a host a posterior mean: a path is shrunk towards
its host and a host towards all documents, the more so the fewer documents it has.  How strongly is estimated from the
spread between hosts, and between the paths of hosts (method of moments).  A document's own odds are then multiplied
by how much the odds of its path exceed those of all documents.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, mixed, stored

_UPPER, _LOWER, _DIGIT, _SPACE = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58)), b" \t\n\v\f\r"
_ASCII_LEFT = bytes(set(range(33, 127)) - {*_UPPER, *_LOWER, *_DIGIT})
_EDGE = re.compile(r"^\W+|\W+$")
HEADS = ("quality", "toxic")


def surface(text: str, words: list[str]) -> list[float]:
    """Numbers that describe how a text looks."""
    raw = text.encode("utf-8", "replace")
    n, w = max(1, len(raw)), max(1, len(words))
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / n
    lines = text.split("\n")
    upper = share(_UPPER)
    odd = share(_ASCII_LEFT)
    again = sum(map(str.__eq__, words, words[1:])) / w
    distinct = len(set(words)) / w
    return [
        np.log1p(len(words)), upper, odd, share(_DIGIT), share(_SPACE), min(n / w, 50.0), distinct, again, len(set(lines)) / len(lines),
        raw.count(b"|") / w, raw.count(b"!") / w, float(odd > 0.1), float(upper > 0.3), float(again > 0.1), float(distinct < 0.3), float(len(words) < 5),
    ]


N_SURFACE = len(surface("", []))


def terms(words: list[str]) -> set[str]:
    """Distinct words, lower-cased, without signs around them, and their first 5 and 7 letters, marked 'once' and 'thrice'."""
    count: dict[str, int] = {}
    for x, n in Counter(words).items():
        x = x.lower() if x.isalnum() else _EDGE.sub("", x).lower()
        count[x] = count.get(x, 0) + n
    out = set(count)
    for k in (5, 7):
        heads: dict[str, int] = {}
        for x, n in count.items():
            if len(x) >= k:
                heads[x[:k]] = heads.get(x[:k], 0) + n
        out.update([f"{x}*" for x in heads], [f"{x}*3" for x, n in heads.items() if n >= 3])
    return out


@dataclass
class Classifier:
    """Weights of the two heads over surface numbers and the presence of words; at most ``max_words`` words, so small enough to send to all tasks."""

    words: dict[str, int] = field(default_factory=dict)
    mean: np.ndarray = field(default_factory=lambda: np.zeros(N_SURFACE))
    scale: np.ndarray = field(default_factory=lambda: np.ones(N_SURFACE))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((2, N_SURFACE)))
    word_weights: np.ndarray = field(default_factory=lambda: np.zeros((2, 0)))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(2))

    def scores(self, texts: pd.Series) -> np.ndarray:
        """P(good quality) and P(toxic) of each text; a null counts as empty."""
        out = np.empty((len(texts), 2))
        get = self.words.get
        for k, text in enumerate(texts):
            text = text or ""
            words = text.split()
            z = self.weights @ ((np.array(surface(text, words)) - self.mean) / self.scale) + self.bias
            at = [i for w in terms(words) if (i := get(w)) is not None]
            out[k] = z + self.word_weights[:, at].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def near_copies(sets: list[np.ndarray], least: float = 0.8, bands: int = 16, rows: int = 4, seed: int = 5) -> np.ndarray:
    """A group number for each sorted array of distinct hashes: those that agree in all min-hashes of a band and have a Jaccard of at least ``least`` share one."""
    factor = np.random.default_rng(seed).integers(0, 2**63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    group = list(range(len(sets)))

    def root(k: int) -> int:
        while group[k] != k:
            group[k] = k = group[group[k]]
        return k

    buckets: dict[tuple[int, bytes], list[int]] = {}
    for k, x in enumerate(sets):
        low = mixed(factor[:, None] * x).min(axis=1) if len(x) else np.zeros(bands * rows, np.uint64)
        for b in range(bands):
            first = buckets.setdefault((b, low[b * rows : (b + 1) * rows].tobytes()), [])
            for other in first:  # texts of this band that are no near copies of each other
                same = root(other) == root(k)
                if not same:
                    both = len(np.intersect1d(sets[other], x, assume_unique=True))
                    same = both >= least * (len(sets[other]) + len(x) - both)
                    if same:
                        group[root(k)] = root(other)
                if same:
                    break
            else:
                first.append(k)
    return np.array([root(k) for k in range(len(sets))], np.int64)


def _telling(row: np.ndarray, col: np.ndarray, n_terms: int, y: np.ndarray, share: np.ndarray, least_docs: float, least: float = 25.0) -> dict[int, float]:
    """Terms (numbers ``col`` of row ``row``) whose presence goes with a label beyond chance, with their likelihood ratio G2 of at least ``least`` for some head.

    A row counts as its ``share``; only terms of at least ``least_docs`` rows count.
    """
    best: dict[int, float] = {}
    often = np.bincount(col, share[row], n_terms) >= least_docs - 1e-9
    for h in range(y.shape[1]):
        use = share * ~np.isnan(y[:, h])
        target = np.nan_to_num(y[:, h])
        n, n1 = use.sum(), (use * target).sum()
        if not 0 < n1 < n:
            continue
        a, c = np.bincount(col, (use * target)[row], n_terms), np.bincount(col, use[row], n_terms)
        number = np.flatnonzero(often & (c > 0))
        a, c = a[number], c[number]
        g = np.zeros(len(number))
        for seen, expected in ((a, c * n1 / n), (c - a, c * (n - n1) / n), (n1 - a, (n - c) * n1 / n), (n - n1 - c + a, (n - c) * (n - n1) / n)):
            g += 2 * np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)
        for w, x in zip(number.tolist(), g.tolist(), strict=True):
            if x >= least:
                best[w] = max(x, best.get(w, 0.0))
    return best


def _hashed(words: set[str]) -> np.ndarray:
    return np.sort(np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "replace")) for w in words), np.uint64, len(words)))


def with_labels(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", sample: int = 8000) -> DataFrame:
    """(text, quality, toxic) of at most ``sample`` rows of labels, those whose ids have the smallest hashes; so few that every task can get them."""
    known = labels.where(F.col(doc_id).isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
    picked = known.select(doc_id, "quality", "toxic").orderBy(F.xxhash64(doc_id), doc_id, "quality", "toxic").limit(sample)
    return docs.select(doc_id, text).join(F.broadcast(picked), doc_id).select(F.col(text).alias("text"), "quality", "toxic")


def fit(labelled: DataFrame, *, sample: int = 8000, max_words: int = 20_000, min_docs: int = 4, rounds: int = 250) -> Classifier:
    """A classifier from rows (text, quality, toxic), of which at most ``sample``, those with the smallest hashes, are used.

    All of them are used; near copies (texts whose sets of words have a Jaccard of at least 0.8) share the weight of one row.  A null label says nothing about its head.  A head without rows of both kinds predicts the (smoothed) share that it has seen.
    """
    key = F.xxhash64("text", "quality", "toxic")
    rows = labelled.select("text", "quality", "toxic").where("text is not null").withColumn("k", key).orderBy("k").limit(sample)
    rows = stored(rows.select("text", "quality", "toxic", "k"), "labelled").orderBy("k", "text")
    dense, found, hashes, label = [], [], [], []
    for r in rows.toLocalIterator():
        words = r["text"].split()
        hashes.append(_hashed(set(words)))
        dense.append(surface(r["text"], words))
        found.append(_hashed(terms(words)))  # only hashes stay on the driver, 8 bytes a term
        label.append([np.nan if r[h] is None else float(r[h]) for h in HEADS])
    model = Classifier()
    if not dense:
        return model
    x, y = np.array(dense), np.array(label)
    group = near_copies(hashes)
    del hashes
    share = 1 / np.bincount(group)[group]
    size = np.array([len(f) for f in found])
    row, every = np.repeat(np.arange(len(found), dtype=np.int32), size), np.concatenate(found)
    del found
    known, col = np.unique(every, return_inverse=True)
    del every
    best = _telling(row, col, len(known), y, share, min_docs)
    strength = {int(known[c]): v for c, v in best.items()}
    spelt: dict[str, int] = {}  # the words behind the chosen hashes, from a second look at the same rows
    for r in rows.select("text").toLocalIterator() if strength else ():
        for w in terms(r["text"].split()):
            if w not in spelt and (h := xxhash.xxh64_intdigest(w.encode("utf-8", "replace"))) in strength:
                spelt[w] = h
    chosen = sorted(spelt, key=lambda w: (-strength[spelt[w]], w))[:max_words]
    model.words = {w: k for k, w in enumerate(chosen)}
    place = np.full(len(known), -1, np.int64)
    place[np.searchsorted(known, np.array([spelt[w] for w in chosen], np.uint64))] = np.arange(len(chosen))
    at = place[col]
    kept = at >= 0
    row, col = row[kept], at[kept]
    del known, at, kept
    model.mean = np.average(x, axis=0, weights=share)
    model.scale = np.sqrt(np.average((x - model.mean) ** 2, axis=0, weights=share)) + 1e-6
    x = (x - model.mean) / model.scale
    model.word_weights = np.zeros((2, len(chosen)))
    for h in range(2):
        use = ~np.isnan(y[:, h])
        good, n = np.nansum(y[:, h] * share), (share * use).sum()
        model.bias[h] = np.log((good + 1) / (n - good + 1))
        if not 0 < good < n:
            continue
        w, v, b = np.zeros(N_SURFACE), np.zeros(len(chosen)), model.bias[h]
        slope = [np.zeros(N_SURFACE), np.zeros(len(chosen)), 0.0]
        square = [np.zeros(N_SURFACE), np.zeros(len(chosen)), 0.0]
        weight = share * use
        target = np.nan_to_num(y[:, h])
        for t in range(1, rounds + 1):
            z = x @ w + np.bincount(row, v[col], len(x)) + b
            gap = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / n
            grads = [x.T @ gap + 1e-4 * w, np.bincount(col, gap[row], len(chosen)) + 2e-5 * v, gap.sum()]
            steps = []
            for k, g in enumerate(grads):
                slope[k] = 0.9 * slope[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                steps.append(0.08 * slope[k] / (1 - 0.9**t) / (np.sqrt(square[k] / (1 - 0.99**t)) + 1e-6))
            w, v, b = w - steps[0], v - steps[1], b - steps[2]
        model.weights[h], model.word_weights[h], model.bias[h] = w, v, b
    return model


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(p / (1 - p))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """(host, path, n, <head>_site, <head>_all): posterior means of each path of each host, and of all documents, for both heads.

    A site's mean is (strength * prior + sum) / (strength + n).  The strength is the number of documents that the prior counts
    for: the variance within sites over that between them, as estimated from all sites, within [1, 10000].
    """
    sums = [F.count("*").alias("n"), *(F.sum(f"p_{h}").alias(f"s_{h}") for h in HEADS), *(F.sum(F.col(f"p_{h}") ** 2).alias(f"q_{h}") for h in HEADS)]
    paths = stored(scored.groupBy("host", "path").agg(*sums), "paths")
    total = [F.sum("n").alias("n"), *(F.sum(f"{c}_{h}").alias(f"{c}_{h}") for c in "sq" for h in HEADS)]
    hosts = stored(paths.groupBy("host").agg(*total), "hosts")
    row = hosts.agg(*total).first()
    n_all = row["n"] or 0
    mean = {h: (row[f"s_{h}"] or 0.0) / max(1, n_all) for h in HEADS}

    def strength(sites: DataFrame, h: str, prior: Column) -> float:
        """Within-site variance over the variance between sites of sites' means around their prior."""
        m = F.col(f"s_{h}") / F.col("n")
        r = sites.agg(
            F.sum(F.col(f"q_{h}") - F.col(f"s_{h}") * m).alias("within"), F.sum("n").alias("n"), F.count("*").alias("sites"),
            F.sum(F.col("n") * (m - prior) ** 2).alias("between"),
        ).first()
        if not r["n"] or r["n"] <= r["sites"]:
            return 100.0
        within = max(r["within"], 0.0) / (r["n"] - r["sites"])
        between = max(0.0, (r["between"] - r["sites"] * within) / r["n"])
        return float(min(10_000.0, max(1.0, within / between if between > 0 else 10_000.0)))

    for h in HEADS:
        k = strength(hosts, h, F.lit(mean[h]))
        hosts = hosts.withColumn(f"host_{h}", (F.lit(k * mean[h]) + F.col(f"s_{h}")) / (k + F.col("n")))
    up = hosts.select(F.col("host").alias("_host"), *(f"host_{h}" for h in HEADS))
    sites = stored(paths.join(up, F.col("host").eqNullSafe(F.col("_host"))).drop("_host"), "sites")
    for h in HEADS:
        k = strength(sites, h, F.col(f"host_{h}"))
        sites = sites.withColumn(f"{h}_site", (k * F.col(f"host_{h}") + F.col(f"s_{h}")) / (k + F.col("n")))
    return sites.select("host", "path", "n", *(f"{h}_site" for h in HEADS), *(F.lit(mean[h]).alias(f"{h}_all") for h in HEADS))


def judge(
    docs: DataFrame, model: Classifier, *, text: str = "text", host: str = "host", path: str = "path", carry_text: bool = True,
    min_quality: float = 0.5, max_toxic: float = 0.5,
) -> DataFrame:
    """docs (without the text, if not carried) plus struct column ``verdict``: p_quality, p_toxic (of the text), quality, toxic (posterior), site_n, keep.

    keep: posterior quality of at least ``min_quality`` and posterior toxicity below ``max_toxic``.  A null text counts as empty;
    null hosts and paths are values like others; repeated rows are judged alike and each counts; an empty table gives no rows.  A column
    named verdict gives way.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<p_quality double, p_toxic double>")
    def scores(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(sent.value.scores(texts), columns=["p_quality", "p_toxic"])

    own, about = free_name(docs, "scores"), free_name(docs, "site")
    scored = docs.drop("verdict").withColumn(own, scores(F.col(text)))
    scored = stored(scored if carry_text else scored.drop(text), "scored")
    sites = site_posteriors(scored.select(F.col(host).alias("host"), F.col(path).alias("path"), f"{own}.*"))
    sites = sites.select(F.struct("*").alias(about))
    joined = scored.join(sites, F.col(host).eqNullSafe(F.col(f"{about}.host")) & F.col(path).eqNullSafe(F.col(f"{about}.path")))
    post = {
        h: 1 / (1 + F.exp(-(_logit(F.col(f"{own}.p_{h}")) + _logit(F.col(f"{about}.{h}_site")) - _logit(F.col(f"{about}.{h}_all")))))
        for h in HEADS
    }
    keep = (post["quality"] >= min_quality) & (post["toxic"] < max_toxic)
    verdict = F.struct(f"{own}.p_quality", f"{own}.p_toxic", *(post[h].alias(h) for h in HEADS), F.col(f"{about}.n").alias("site_n"), keep.alias("keep"))
    return joined.withColumn("verdict", verdict).drop(own, about)
