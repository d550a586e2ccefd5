"""Personal data against the patterns as they are written, and the field against a plain message passing."""

import itertools
import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import frame, sha  # noqa: F401

from tickloom.llm import private
from tickloom.llm.queries import op11_personal_data

# The patterns of the contract.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_base(text):
    found = [(m.start(), i, m.end()) for i, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if holds(k, m.group())]
    return sorted(found)


def told(spans):
    return ",".join(f"{private.KINDS[k]}:{s}:{e}" for s, k, e in spans)


ODD = [
    "a@b.c@d.e", "a@b.c.@d.e", "x@y", "@a.b", "a.@b..c", "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.1.1.256", "0001.2.3.004", "1.2.3", "+1 (784) 555-9263 4111 1111 1111 1111",
    "+1 (784) 555-9263\n4111111111111111", "4111-1111 1111-1111", "4111  1111 1111 1111", "+1+2+345678901", "+1 2", "+12", "(+49) 30 123456-78.", "١٢ 1 2",
    "\U0001f642 me@x.org \U0001f642 +1 (784) 555-9263", "z" * 300 + "@" + "a." * 100 + "b", "7" * 5000, "1." * 3000, "a@" * 2000, "+1 " * 900, "", " ", "4111111111111111 4111111111111111",
]


@pytest.mark.parametrize("text", ODD)
def test_patterns_are_those_of_the_contract(text):
    assert private.patterns(text) == plain_base(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.@+-0179 ()\né", max_size=60))
def test_patterns_on_any_text(text):
    assert private.patterns(text) == plain_base(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "a." * 1_000_000 + "@", "1." * 1_000_000, "+1(" * 600_000, "1 " * 300_000):
        dropped = []
        assert private.nodes(text, private.patterns(text, dropped), dropped) is not None


def test_messages_are_exact_on_a_tree_and_plain_elsewhere():
    rng = np.random.default_rng(4)
    own, chain, skip = rng.normal(size=(5, 5)), rng.normal(size=(5, 5)), rng.normal(size=(5, 5))
    skip = skip + skip.T
    tree = [(np.array([0, 1]), np.array([1, 2]), chain), (np.array([1, 0]), np.array([3, 4]), skip)]
    exact = np.zeros((5, 5))
    for y in itertools.product(range(5), repeat=5):
        p = math.exp(sum(own[i, y[i]] for i in range(5)) + sum(t[y[a], y[b]] for x in tree for a, b, t in zip(x[0], x[1], [x[2]] * 2)))
        for i in range(5):
            exact[i, y[i]] += p
    assert np.allclose(private.marginals(own, tree), exact / exact.sum(1, keepdims=True), atol=1e-6)

    loop = [(np.array([0, 1, 2]), np.array([1, 2, 3]), chain), (np.array([0, 0]), np.array([2, 3]), skip)]
    links = [(a, b, t) for x, z, t in loop for a, b in zip(x.tolist(), z.tolist())]
    directed = [(a, b, t) for a, b, t in links] + [(b, a, t.T) for a, b, t in links]
    message = {(a, b): [0.0] * 5 for a, b, _ in directed}
    for _ in range(30):
        new = {}
        for a, b, t in directed:
            z = [math.log(sum(math.exp(own[a, x] + sum(message[c, d][x] for c, d in message if d == a and c != b) + t[x, y]) for x in range(5))) for y in range(5)]
            new[a, b] = [0.3 * o + 0.7 * (v - max(z)) for o, v in zip(message[a, b], z)]
        message = new
    want = np.array([[math.exp(own[i, y] + sum(m[y] for (c, d), m in message.items() if d == i)) for y in range(5)] for i in range(5)])
    assert np.allclose(private.marginals(own, loop), want / want.sum(1, keepdims=True), atol=1e-9)


def trained(n=40):
    """Texts from which the shapes can be learned, with things that are none of the four."""
    out = []
    for i in range(n):
        out += [
            f"call +1 (2{i % 10}{i // 10}) 555-{1000 + 7 * i} now", f"write to name.{i}@mail{i % 7}.example.com soon", f"host 10.{i}.7.{3 * i} is up",
            f"card {card(i)} ok", f"number 41111111111{i:04d}0 fails" if not holds("card", f"41111111111{i:04d}0") else "none", f"page {i} of 12.0", f"key a{i}f9e{i}",
        ]
    return out


def card(i):
    stem = f"4111 {2000 + i} 3333 444"
    return next(f"{stem}{d}".replace(" ", "") for d in range(10) if holds("card", f"{stem}{d}"))


def test_labels_travel_to_what_the_patterns_miss(spark):
    phone = "reach me at 784-555-9263; +1 (784) 555-9263 is the same, and so is 784-555-9263"
    crowded = f"+1 (784) 555-9263 {card(3)} and more"
    twice = f"{card(5)} {card(5)}"
    clean = "page 3 of 10, version 2.0, January 2004, 1234567890123456"
    texts = [phone, crowded, twice, clean, None, "", *trained()]
    rows = {r["doc_id"]: r for r in private.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    text_of = lambda d: [(s["kind"], texts[d][s["start"] : s["end"]]) for s in rows[d]["spans"]]
    assert text_of(0) == [("phone", "784-555-9263"), ("phone", "+1 (784) 555-9263"), ("phone", "784-555-9263")]
    assert text_of(1) == [("phone", "+1 (784) 555-9263"), ("card", card(3))]
    assert text_of(2) == [("card", card(5)), ("card", card(5))]
    assert [rows[d]["spans"] for d in (3, 4, 5)] == [[], [], []]
    for d, t in enumerate(texts):
        r = rows[d]
        base = [(s["start"], private.KINDS.index(s["kind"]), s["end"]) for s in r["base"]]
        assert base == plain_base(t)
        assert [r[f"n_{k}"] for k in private.KINDS] == [sum(x[1] == i for x in base) for i in range(4)]
        assert {tuple(s) for s in r["base"]} <= {tuple(s) for s in r["spans"]}


def test_odd_tables(spark, frame):  # noqa: F811
    rows = [(1, "me@x.org"), (1, "me@x.org"), (None, "+1 (784) 555-9263"), (2, None), (3, ""), (4, "1 " * 30_000), (5, "a" * 100_000), *[(6, t) for t in ODD]]
    got = private.find(frame(rows)).collect()
    assert len(got) == len(rows)
    assert sorted((r["doc_id"] or 0, told([(s["start"], private.KINDS.index(s["kind"]), s["end"]) for s in r["base"]])) for r in got) == sorted(
        (d or 0, told(plain_base(t))) for d, t in rows
    )
    assert private.find(spark.createDataFrame([], "doc_id long, text string, node_from string")).collect() == []
    assert [r["spans"] for r in private.find(frame([(1, "no data")])).collect()] == [[]]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op11_personal_data(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        base = plain_base(docs[r["doc_id"]])
        assert r["base_sha256"] == sha(told(base))
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(sum(x[1] == k for x in base) for k in range(4))
        assert set(filter(None, told(base).split(","))) <= set(r["spans"].split(","))
