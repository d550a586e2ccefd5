"""Filter audits and integer clusters against plain versions and SQL."""

import collections
import hashlib
import itertools
import math
import random

import numpy as np
import pytest
from conftest import SF
from oracle import compare, connect
from plain import corpus, frame  # noqa: F401

from tickloom.llm import audit, pivots
from tickloom.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", ["op12_pivot_clusters", "op13_filter_audit"])
def test_query(spark, name):
    assert compare(spark, connect(SF), SF, QUERIES[name], ORACLE[name]) is None


def plain_audit(docs, labels, few):
    """{(part, order, step): figures}, filter by filter and row by row."""
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, x in labels if x == 1}
    rows = []
    for d, t, part in docs:
        t = t or ""
        w = t.encode().split()
        fails = {
            "A": len(w) < few, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": d is not None and any(x is not None and x < d and (u or "") == t for x, u, _ in docs),
        }
        rows.append((part or "", {f for f, x in fails.items() if x}, d in good and d is not None, d in toxic and d is not None))
    out, shapley = {}, collections.Counter()
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[part, f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in r[1] for r in own) - len(gone), sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone),
                ]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_row_by_row(spark, frame):  # noqa: F811
    r = random.Random(2)
    texts = [t for _, t in corpus(n=40)] + ["A B C d", "x | y", "$ $ $ $", "\U0001f642 A" + "b" * 20, "AÄÖ", "\x1cab cd\x0b\x0cef"]
    docs = [(r.choice([None, *range(60)]), r.choice([*texts, None, ""]), r.choice(["en", "de", "", None])) for _ in range(150)]
    docs += [(7, "same under one id", "en")] * 3 + [(r.randrange(1000), "hot copy", "hot") for _ in range(200)]
    labels = [(r.choice([None, *range(60)]), r.choice([0, 1, None]), r.choice([0, 1, None])) for _ in range(40)]
    df = frame(docs, "doc_id long, text string, lang string").withColumnsRenamed({"node": "mask", "label": "good", "t1": "same", "doc": "id", "key": "first", "n": "part"})
    got = audit.interactions(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), few=12).collect()
    assert {(x["part"], x["filter_order"], x["step"]): tuple(x[3:]) for x in got} == plain_audit(docs, labels, 12)


def test_audit_without_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.interactions(none, labels).collect() == []
    one = audit.interactions(spark.createDataFrame([(1, "a", None)], none.schema), labels).collect()
    assert len(one) == 600 and {x["part"] for x in one} == {""}


def plain_clusters(rows, k, rounds, width):
    whole = [
        (d, [math.floor(1024 * x) for x in v]) for d, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    first = sorted(whole, key=lambda x: (x[0] is None, hashlib.sha256(f"3:{x[0]}".encode()).hexdigest(), x[1]))[:k]
    at = [v for _, v in first]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for r in range(rounds + 1):
        found = [min((distance(v, c), i) for i, c in enumerate(at)) for _, v in whole]
        if r < rounds:
            for i in range(len(at)):
                own = [v for (_, v), (_, j) in zip(whole, found) if i == j]
                at[i] = [sum(x) // len(own) for x in zip(*own)] if own else at[i]
    inertia = collections.Counter()
    for d, i in found:
        inertia[i] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return collections.Counter((d, i, x, inertia[i], sum(inertia.values()), names[i]) for (d, _), (x, i) in zip(whole, found))


def vectors(kind, n=160, width=6):
    r = np.random.default_rng(3)
    x = {
        "normal": r.normal(size=(n, width)), "groups": r.normal(size=(5, width))[r.integers(0, 5, n)] * 50 + r.normal(size=(n, width)), "same": np.ones((n, width)),
        "grid": r.integers(-2, 3, (n, width)) / 1024.0, "large": r.normal(size=(n, width)) * 10_000, "few": r.normal(size=(3, width)),
    }[kind]
    return [(int(i), [float(y) for y in v]) for i, v in enumerate(x)]


@pytest.mark.parametrize("kind", ["normal", "groups", "same", "grid", "large", "few"])
def test_clusters_are_exact(spark, kind):
    rows = vectors(kind)
    odd = [
        (None, rows[0][1]), (None, rows[1][1]), (1, rows[2][1]), (1, rows[1][1]), (500, None), (501, []), (502, [1.0] * 5), (503, [1.0] * 7),
        (504, [None] + [1.0] * 5), (505, [math.nan] + [1.0] * 5), (506, [1.0] * 5 + [-math.inf]), (507, [0.0] * 6),
    ]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS v", "'y' AS id", "'z' AS cluster", "'w' AS far").repartition(5)
    got = collections.Counter(tuple(x) for x in pivots.cluster(df, width=6, pivots=4).collect())
    assert got == plain_clusters(rows + odd, 8, 10, 6)


def test_clusters_of_nothing(spark):
    assert pivots.cluster(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    assert pivots.cluster(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).collect() == []
    with pytest.raises(Exception, match="too large"):
        pivots.cluster(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<float>"), width=1).collect()


def test_pivots_leave_out_what_cannot_win():
    r = np.random.default_rng(1)
    centers = r.integers(-5000, 5000, (8, 16))
    v = centers[r.integers(0, 8, 3000)] + r.integers(-300, 300, (3000, 16))
    fixed = pivots.spread_out(v[:200], 8)
    far, reach = (np.sqrt(np.stack([pivots.squared(x, p) for p in fixed], 1).astype(float)) for x in (v, centers))
    cluster, best, used = pivots.nearest(v, far, centers, reach)
    every = ((v[:, None] - centers) ** 2).sum(2)
    assert (cluster == every.argmin(1)).all() and (best == every.min(1)).all()
    assert used < 2 * len(v)  # of 8 each
