"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import pytest


@pytest.fixture
def frame(spark):
    """Documents with extra columns whose names the operators use themselves."""

    def build(rows, columns="doc_id long, text string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(rows, columns)
        clash = ("node", "label", "t1", "doc", "n", "center", "spans", "key", "ids", "start", "line", "_s")
        return df.withColumns({c: F.lit("x") for c in clash if c not in df.columns}).repartition(3)

    return build


def words(text):
    return (text or "").encode().split()


def corpus(seed=3, n=60):
    """(doc_id, text): prose from a small vocabulary, copies, near copies, shared passages and lines, and odd texts."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("aeioubcdlmnrst") for _ in range(r.randint(2, 7))) for _ in range(400)]
    sentence = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    passage = sentence(70)
    docs = []
    for i in range(n):
        kind = i % 6
        if kind == 1 and docs:
            text = r.choice(docs)[1]
        elif kind == 2 and docs:
            w = (r.choice(docs)[1] or "x").split(" ")
            w[r.randrange(len(w))] = "changed"
            text = " ".join(w)
        elif kind == 3:
            text = f"{sentence(r.randint(0, 40))} {passage} {sentence(r.randint(0, 40))}"
        else:
            text = "\n".join([sentence(r.randint(3, 60)), f"page {i} of the common footer line here", sentence(12)])
        docs.append((i * 3 + 1, text))
    odd = [(2, None), (5, ""), (8, " \n\t"), (11, "one"), (14, "one"), (17, "two words"), (20, "Two Words"), (23, "x\u00a0y  z \U0001f642"), (26, passage), (29, passage)]
    return docs + odd


def components(docs, size, percent):
    """{doc_id: (n_shingles, component)} by comparing every pair."""
    sets = {}
    for d, t in docs:
        w = (t or "").encode().lower().split()
        k = min(size, len(w))
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def without_repeats(docs, window):
    """{doc_id: (words, removed, kept)}."""
    first = {}
    for d, t in sorted(docs):
        w = words(t)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), d)
    out = {}
    for d, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out[d] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode())
    return out


def without_templates(docs, depth, min_docs, similarity):
    """{doc_id: kept text}."""
    field = b"<*>"

    def key(line):
        masked = [field if re.search(rb"\d", w) else w for w in line.split()]
        worded = any(w != field and re.search(rb"[A-Za-z\x80-\xff]", w) for w in masked)
        return tuple(masked if worded else line.split())

    origin, lines = {}, collections.defaultdict(lambda: [0, None])
    for d, t in sorted(docs, key=lambda x: x[0]):
        if t in origin:
            continue
        origin[t] = d
        for k in {key(x) for x in (t or "").encode().split(b"\n")} - {()}:
            lines[k][0] += 1
            lines[k][1] = d if lines[k][1] is None else lines[k][1]
    leaf = lambda k: (len(k), k[:depth])
    count = collections.Counter()
    for k, (n, _) in lines.items():
        for i, w in enumerate(k):
            count[leaf(k), i, w] += n
    template, found = {}, collections.defaultdict(lambda: [0, None])
    for k, (n, d) in lines.items():
        worded = [(count[leaf(k), i, w], i, w) for i, w in enumerate(k) if w != field]
        often = sorted((x for x in worded if x[0] >= min_docs), reverse=True)
        need = max(1, -(-len(worded) * round(similarity * 100) // 100))
        if len(often) >= need:
            template[k] = leaf(k), frozenset((i, w) for c, i, w in often if c >= often[need - 1][0])
            e = found[template[k]]
            e[0] += n
            e[1] = d if e[1] is None else min(e[1], d)
    out = {}
    for d, t in docs:
        drop = lambda x: (p := template.get(key(x))) and found[p][0] >= min_docs and found[p][1] != d  # noqa: B023, E731
        out[d] = None if t is None else b"\n".join(x for x in t.encode().split(b"\n") if not drop(x)).decode()
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
