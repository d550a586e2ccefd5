"""Personal data: patterns, and a skip-chain conditional random field that carries their labels to tokens they miss.

Every token with a digit or an at sign is a node of its document's field, with the labels none, email, ip, card and phone;
a token without either cannot be part of one.  Neighbouring nodes share a chain potential.  Nodes with the same content (the
same last digits, mailbox or dotted number) share a skip potential, however far apart: each is linked to the first of them, so
the links grow with the tokens and two occurrences are never more than two steps apart.  Nodes inside a pattern's match
are clamped to its kind, loopy message passing does the rest.

The weights are fitted to the patterns' own matches in the whole corpus by pseudo-likelihood: what that needs are counts of
(shape, label, neighbours' labels), which Spark sums.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored

KINDS = ("email", "ip", "card", "phone")

# The character classes and patterns of the four kinds.
MAILBOX = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPACE = " \t\n\x0b\f\r"

_DIGITS = re.compile("[0-9]+")
_SIGN = re.compile("[0-9]+|@")
_GAP = re.compile(f"[{_SPACE}]")
_NOT_DIGIT = re.compile("[^0-9]+")
_TRIM = ".,;:!?\"'()[]{}<>"

#: What is seen of a token; a shape is a sum of these bits.
SHAPES = (
    "mail", "at", "dotted", "luhn", "no luhn", "plus", "phone marks only", "1-3 digits", "4-6 digits", "7-11 digits", "12-19 digits",
    "20 digits", "letters", "bracket", "hyphen", "dot", "after plus", "digits only",
)
NODE = ("from", "to", "shape", "key", "chained", "label", "unsure")

_FOUND = "n_email long, n_ip long, n_card long, n_phone long, base array<long>, " + ", ".join(f"node_{c} array<long>" for c in NODE)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for d in digits[-2::-2]:
        total += 2 * int(d) - (9 if d > "4" else 0)
    return total % 10 == 0


def _dotted(text: str) -> bool:
    return all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in text.split("."))


def patterns(text: str, dropped: list[tuple[int, int]] | None = None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the patterns find, in that order; leftmost, not overlapping within a kind.

    ``dropped`` takes the ends of matches over several tokens that fail their check.  Runs in time proportional to the text: a pattern is tried only where it can begin, at the first digit of a run, at a plus or
    around an at sign.
    """
    found, last = [], 0
    for m in _DOMAIN.finditer(text):
        at = m.start()
        size = 64
        while True:  # the mailbox: back from the sign, not into the match before
            low = max(last, at - size)
            begin = low + len(text[low:at].rstrip(MAILBOX))
            if begin > low or low == last:
                break
            size *= 2
        if begin < at:
            last = m.end()
            found.append((begin, 0, last))
    ip_end = card_end = 0
    for m in _DIGITS.finditer(text):
        begin, end = m.span()
        if begin >= ip_end and text.startswith(".", end) and (x := _IP.match(text, begin)):
            ip_end = x.end()
            if _dotted(x.group()):
                found.append((begin, 1, ip_end))
        if begin >= card_end and (x := _CARD.match(text, begin)):
            card_end = x.end()
            digits = _NOT_DIGIT.sub("", x.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((begin, 2, card_end))
            elif dropped is not None and len(digits) >= 12 and " " in x.group():
                dropped.append((begin, card_end))
    for m in _PHONE.finditer(text):
        if 9 <= (n := len(_NOT_DIGIT.sub("", m.group()))) <= 15:
            found.append((m.start(), 3, m.end()))
        elif dropped is not None and n > 15 and " " in m.group():
            dropped.append(m.span())
    return sorted(found)


def shape_of(token: str, core: str, digits: str, after_plus: bool) -> int:
    n, mail = len(digits), "@" in core
    plain = not mail and 12 <= n <= 19 and not core.strip("0123456789-")
    checked = plain and luhn(digits)
    seen = (
        mail and _DOMAIN.search(core) is not None, mail, bool(core.count(".") == 3 and _IP.fullmatch(core) and _dotted(core)), checked, plain and not checked,
        token.startswith("+"), not core.strip("0123456789().+-"), n <= 3, 4 <= n <= 6, 7 <= n <= 11, 12 <= n <= 19, n > 19,
        bool(core.strip("0123456789().+-@_%/:=")), token.startswith("("), "-" in core, "." in core, after_plus, n == len(core),
    )
    return sum(1 << i for i, s in enumerate(seen) if s)


def key_of(core: str, digits: str) -> int:
    """The same number for tokens that say the same thing: last seven digits, mailbox, dotted number; 0 for none."""
    if "@" in core:
        name = "w" + core.partition("@")[0].lower()
    elif core.strip("0123456789().+-"):
        name = "w" + core.lower()
    elif core.count(".") == 3:
        name = "i" + core
    else:
        name = "d" + digits[-7:]
    return xxhash.xxh64_intdigest(name) >> 1 if len(name) > 4 else 0


def _overlapping(spans: list[tuple]) -> Callable[[int, int], list[tuple]]:
    """What of spans (first: start, last: end) meets a token; to be asked for tokens in order."""
    rest, current = iter(sorted(spans)), []
    ahead = next(rest, None)

    def at(left: int, right: int) -> list[tuple]:
        nonlocal ahead, current
        while ahead is not None and ahead[0] < right:
            current.append(ahead)
            ahead = next(rest, None)
        current = [s for s in current if s[-1] > left]
        return current

    return at


def nodes(text: str, base: list[tuple[int, int, int]], dropped: list[tuple[int, int]] = ()) -> list[tuple[int, ...]]:
    """Tokens with a digit or an at sign, in order: (from, to, shape, key, whether chained to the one before, label, unsure).

    Unsure is a token without label in a match that failed as a whole: it may well be part of one.
    """
    out, end, before, plus = [], 0, -1, False
    labelled, doubtful = _overlapping(base), _overlapping(dropped)
    for m in _SIGN.finditer(text):
        if m.start() < end:
            continue
        begin = max(text.rfind(c, end, m.start()) for c in _SPACE) + 1
        begin = max(begin, end)
        gap = _GAP.search(text, m.end())
        end = gap.start() if gap else len(text)
        token = text[begin:end]
        left = begin + len(token) - len(token.lstrip(_TRIM))
        core = token.strip(_TRIM)
        right, digits = left + len(core), _NOT_DIGIT.sub("", core)
        chained = before >= 0 and not text[before:begin].strip(_SPACE)
        after_plus = chained and plus
        label = min((s[1] for s in labelled(left, right)), default=-1) + 1
        unsure = bool(doubtful(left, right)) and not label
        out.append((left, right, shape_of(token, core, digits, after_plus), key_of(core, digits), int(chained), label, int(unsure)))
        before, plus = end, token.startswith("+")
    return out


def _lists(rows: list[list[int]]) -> pa.Array:
    return pa.array(rows, pa.list_(pa.int64()))


def extract(docs: DataFrame) -> DataFrame:
    """One row per document: what the patterns found and its nodes.  The only pass over the texts."""
    types = dict(docs.dtypes)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, bases, parts = [[] for _ in KINDS], [], [[] for _ in NODE]
            for text in b.column("text").to_pylist():
                dropped: list[tuple[int, int]] = []
                base = patterns(text or "", dropped)
                for k, c in enumerate(counts):
                    c.append(sum(x[1] == k for x in base))
                bases.append([v for x in base for v in x])
                columns = list(zip(*nodes(text or "", base, dropped))) or [()] * len(NODE)
                for part, values in zip(parts, columns):
                    part.append(values)
            names = ["doc_id", *[f"n_{k}" for k in KINDS], "base", *[f"node_{c}" for c in NODE]]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts], _lists(bases), *map(_lists, parts)], names)

    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {types['doc_id']}, {_FOUND}")


def _field(b: pa.RecordBatch) -> tuple[np.ndarray, dict[str, np.ndarray], np.ndarray]:
    """The nodes of a batch, document after document: document number, columns, and the first node of each node's key (-1: it is the first)."""
    sizes = b.column("node_from").value_lengths().to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(b.num_rows), sizes)
    columns = {c: b.column(f"node_{c}").flatten().to_numpy(zero_copy_only=False) for c in NODE}
    order = np.lexsort((np.arange(len(doc)), columns["key"], doc))
    d, k = doc[order], columns["key"][order]
    new = np.append(True, (d[1:] != d[:-1]) | (k[1:] != k[:-1]))[: len(doc)]
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))]
    first = np.full(len(doc), -1)
    first[order] = np.where(new | (k == 0), -1, head)
    return doc, columns, first


_WAYS = len(KINDS) + 2  # a neighbour's label, or no neighbour


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (shape, left label, right label, label at the first occurrence, own label); 0 stands for no neighbour.

    Unsure tokens teach nothing, neither themselves nor as neighbours.
    """
    for b in filter(len, batches):
        _, c, first = _field(b)
        if not len(first):
            continue
        sure, chained = c["unsure"] == 0, c["chained"] > 0
        label = np.where(sure, c["label"], -1)
        left = np.where(chained, np.append(-1, label[:-1]), -1) + 1
        right = np.where(np.append(chained[1:], False), np.append(label[1:], -1), -1) + 1
        skip = np.where(first >= 0, label[first], -1) + 1
        code = (((c["shape"] * _WAYS + left) * _WAYS + right) * _WAYS + skip) * _WAYS + label
        found, n = np.unique(code[sure], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["code", "n"])


def _agreement() -> np.ndarray:
    """Skip potentials by two parameters: same kind, both none."""
    k = len(KINDS) + 1
    out = np.zeros((2, k, k))
    out[0][np.arange(1, k), np.arange(1, k)] = 1
    out[1][0, 0] = 1
    return out


class Weights:
    """Potentials: ``shape`` (bit, label), ``chain`` (label, next label), ``skip`` (same kind, both none)."""

    def __init__(self) -> None:
        k = len(KINDS) + 1
        self.shape = np.zeros((len(SHAPES) + 1, k))
        self.shape[-1, 0] = 2.0  # without evidence a token is nothing
        self.chain = np.zeros((k, k))
        self.skip = np.array([4.0, 1.0])

    def own(self, shape: np.ndarray) -> np.ndarray:
        bits = (shape[:, None] >> np.arange(len(SHAPES))) & 1
        return bits @ self.shape[:-1] + self.shape[-1]

    def skip_table(self) -> np.ndarray:
        return np.tensordot(self.skip, _agreement(), 1)


def fit(counts: list[tuple[int, int]], *, strength: float = 10_000.0, steps: int = 400) -> Weights:
    """Maximum a posteriori weights from counted contexts.

    Counts are turned into shares of ``strength`` tokens, so the fit does not depend on the size of the corpus.  The prior is
    normal around no evidence, but for tokens of the same content, which agree.
    """
    w = Weights()
    if not counts:
        return w
    code, n = (np.array(x) for x in zip(*sorted(counts)))
    share = n * (strength / n.sum())
    k = len(KINDS) + 1
    label, skip, right, left, shape = code % _WAYS, code // _WAYS % _WAYS, code // _WAYS**2 % _WAYS, code // _WAYS**3 % _WAYS, code // _WAYS**4
    bits = np.hstack([(shape[:, None] >> np.arange(len(SHAPES))) & 1, np.ones((len(shape), 1), int)])
    hot = lambda x: np.eye(k + 1)[x][:, 1:]  # noqa: E731  no neighbour: a row of zeros
    before, after, same, truth = hot(left), hot(right), hot(skip), np.eye(k)[label]
    agree = _agreement()
    mean = [w.shape.copy(), w.chain.copy(), w.skip.copy()]
    values = [w.shape, w.chain, w.skip]
    seen = [np.zeros_like(v) for v in values]
    for _ in range(steps):
        score = bits @ w.shape + before @ w.chain + after @ w.chain.T + np.einsum("na,p,pab->nb", same, w.skip, agree)
        p = np.exp(score - score.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        miss = (truth - p) * share[:, None]
        slopes = [bits.T @ miss, before.T @ miss + miss.T @ after, np.einsum("na,pab,nb->p", same, agree, miss)]
        for v, m, g, s in zip(values, mean, slopes, seen):
            g = g - (v - m)
            s += g * g
            v += 0.5 * g / np.sqrt(s + 1e-9)
    return w


def marginals(own: np.ndarray, edges: list[tuple[np.ndarray, np.ndarray, np.ndarray]], rounds: int = 30, damping: float = 0.3) -> np.ndarray:
    """Label probabilities of each node by loopy message passing; edges are (from, to, table of log potentials)."""
    k = own.shape[1]
    source = np.concatenate([x for a, b, _ in edges for x in (a, b)] or [np.zeros(0, int)])
    target = np.concatenate([x for a, b, _ in edges for x in (b, a)] or [np.zeros(0, int)])
    back, tables, at = [], [], 0
    for a, _, table in edges:
        e = len(a)
        back += [np.arange(at + e, at + 2 * e), np.arange(at, at + e)]
        tables += [(slice(at, at + e), table), (slice(at + e, at + 2 * e), table.T)]
        at += 2 * e
    back = np.concatenate(back or [np.zeros(0, int)])

    def gathered(message: np.ndarray) -> np.ndarray:
        return own + np.stack([np.bincount(target, message[:, y], len(own)) for y in range(k)], 1)

    message = np.zeros((len(source), k))
    for _ in range(rounds if len(source) else 0):
        out = gathered(message)[source] - message[back]
        new = np.empty_like(message)
        for part, table in tables:
            for y in range(k):
                z = out[part] + table[:, y]
                top = z.max(1, initial=-np.inf)
                new[part, y] = top + np.log(np.exp(z - top[:, None]).sum(1))
        new -= new.max(1, keepdims=True)
        message = damping * message + (1 - damping) * new
    belief = gathered(message) if len(source) else own
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


_CLAMP = 40.0


def added(b: pa.RecordBatch, w: Weights, sure: float) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of the spans that the field adds to each document of a batch."""
    doc, c, first = _field(b)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(b.num_rows)]
    if not len(doc):
        return out
    own = w.own(c["shape"])
    clamped = np.flatnonzero(c["label"])
    own[clamped, c["label"][clamped]] += _CLAMP
    follower, repeat = np.flatnonzero(c["chained"]), np.flatnonzero(first >= 0)
    p = marginals(own, [(follower - 1, follower, w.chain), (first[repeat], repeat, w.skip_table())])
    best = p.argmax(1)
    # a mailbox alone is no address: an added address has the sign
    new = (c["label"] == 0) & (best > 0) & (p.max(1) >= sure) & ((best != 1) | (c["shape"] >> SHAPES.index("at") & 1 == 1))
    whole = c["shape"] >> SHAPES.index("12-19 digits") & 1 == 1
    for i in np.flatnonzero(new).tolist():
        spans, kind = out[doc[i]], int(best[i]) - 1
        # a phone or card may be written in parts; two whole cards side by side stay two
        if c["chained"][i] and new[i - 1] and best[i - 1] == best[i] and (kind == 3 or (kind == 2 and not whole[i - 1] and not whole[i])):
            spans[-1] = (spans[-1][0], kind, int(c["to"][i]))
        else:
            spans.append((int(c["from"][i]), kind, int(c["to"][i])))
    return out


def find(docs: DataFrame, *, sure: float = 0.8) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans) of every row of documents.

    The counts are those of the patterns.  ``base`` and ``spans`` are arrays of (kind, start, end) in code points, end exclusive, by
    start and then kind; ``spans`` holds all of ``base`` and what the field is at least ``sure`` of.  Tokens inside a match of
    a pattern are never added again.  A NULL text is empty; every row gives a row, also one that repeats a doc_id or has none.
    Other columns are not read.  An empty table, or one without any token of interest, leaves the weights at their prior.

    The texts are read once; the nodes are written to the shared folder.  To the driver come counted contexts only, whose number
    depends on the number of shapes, not of documents.
    """
    scanned = stored(extract(docs), "private-nodes")
    contexts = scanned.select(*[f"node_{c}" for c in NODE]).mapInArrow(_contexts, "code long, n long")
    w = fit([(r["code"], r["n"]) for r in contexts.groupBy("code").agg(F.sum("n").alias("n")).collect()])
    kept = ["doc_id", *[f"n_{k}" for k in KINDS]]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = whole.column("node_from").value_lengths().to_numpy(zero_copy_only=False)
            group = np.cumsum(sizes) // 200_000  # documents that share one pass of messages; no message leaves its document
            for begin, end in _runs(group):
                b = whole.slice(begin, end - begin)
                base = [list(zip(x[0::3], x[1::3], x[2::3])) for x in b.column("base").to_pylist()]
                every = [sorted(x + y) for x, y in zip(base, added(b, w, sure))]
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], _spans(base), _spans(every)], [*kept, "base", "spans"])

    span = "array<struct<kind: string, start: long, end: long>>"
    types = dict(scanned.dtypes)
    return scanned.mapInArrow(label, ", ".join(f"{c} {types[c]}" for c in kept) + f", base {span}, spans {span}")


def _runs(group: np.ndarray) -> Iterator[tuple[int, int]]:
    borders = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
    return ((a, b) for a, b in zip(borders, borders[1:]) if b > a)


def _spans(rows: list[list[tuple[int, int, int]]]) -> pa.Array:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    return pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans] for spans in rows], kind)


def told(column: str) -> Column:
    """Spans as one text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
