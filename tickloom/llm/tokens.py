"""Exact token ids at a fraction of the cost: texts are cut where the tokenizer cuts anyway, and each distinct piece is encoded once."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import cache
from itertools import chain
from string import ascii_lowercase, ascii_uppercase
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that are encoded as one text, where the ids tell which piece they belong to.
TOGETHER = 500
#: Pieces that the patterns cut from one another: a blank first and a visible sign or Latin letter last, or one word of Latin letters.
_BLANK_FIRST = r"\A[ \n](?s:.*)(?:[!-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])\z"
_BLANK_WORD = r"\A (?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+\z"
_ONE_WORD = r"\A[ \n]?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+\z"
#: The characters that stand for bytes in the vocabulary of a byte-level tokenizer.
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SIGNS = {b: chr(b) for b in _SELF} | {b: chr(256 + k) for k, b in enumerate(sorted({*range(256)}.difference(_SELF)))}
#: Words with a blank first, written in these characters, a space between them.
_SPELLED = str.maketrans(_SIGNS | {32: " " + _SIGNS[32]})
#: Of each byte: 1 for a space or line end, 2 for a sign that starts a piece.
_KIND = bytes(1 if b in b" \n" else 2 if b in b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~' else 0 for b in range(256))


@cache
def _letters() -> np.ndarray:
    """Which characters of the basic plane are letters or digits, and end in one when a tokenizer has normalised and lower-cased them."""
    return np.array([chr(c).isalnum() and normalize("NFC", normalize("NFC", chr(c)).lower())[-1].isalnum() for c in range(1 << 16)])


def _starts(raw: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces start in UTF-8 texts one after another, that start at ``first`` (none of them empty).

    The patterns of the tokenizers used here always start a new piece at a space or line end after a letter, digit or visible ASCII character
    (white space joins only what follows it), and at an ASCII sign other than an apostrophe after a letter or digit.  So pieces cut there are
    encoded as they would be in place.
    """
    kind = np.frombuffer(raw.tobytes().translate(_KIND), np.uint8)
    at = np.flatnonzero(kind != 0)
    before = raw[np.maximum(at - 1, 0)]
    letter = _letters()[:128].take(before & 127)
    cut = np.where(kind[at] == 1, (before > 32) & (before < 127), letter) & (before < 128)
    high = np.flatnonzero(before >= 128)
    if len(high):  # the character before, of two or three bytes; a longer one does not cut
        a, b, c = (raw[np.maximum(at[high] - k, 0)].astype(np.int64) for k in (3, 2, 1))
        two, three = b >= 0xC0, (b < 0xC0) & (a >= 0xE0) & (a < 0xF0)
        code = np.where(two, (b & 31) << 6, ((a & 15) << 12) | ((b & 63) << 6)) | (c & 63)
        cut[high] = (two | three) & _letters()[code & 0xFFFF]
    starts = np.zeros(len(raw), bool)
    starts[at[cut]] = True
    starts[first] = True
    return starts


class ChunkEncoder:
    """Ids as tokenizers.Tokenizer.encode(text, add_special_tokens=False) gives them.

    A text that holds a special token as a string gets that token's id there, as from the library; it is encoded whole.  Remembers the ids of up to ``limit`` pieces.
    """

    def __init__(self, path: str, limit: int = 1_100_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        same = [self.tokenizer.encode(x, add_special_tokens=False).ids for x in (ascii_uppercase, ascii_lowercase)]
        self.fold = same[0] == same[1]  # the tokenizer lower-cases, so both cases of a piece can share one entry
        self.together, self.bytes_of, self.last, self.speller = None, None, None, None
        if not any(" " in t or "\n" in t for t in self.special):
            self._look(json.loads(self.tokenizer.to_str()))
        self._forget()

    def _look(self, spec: dict) -> None:
        """Which pieces can be encoded as one text, and what tells their ids apart: the bytes that ids stand for, or ids that end a word."""
        model, cutter = spec["model"], spec["pre_tokenizer"] or {}
        vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix")
        alphabet = [t for t in vocabulary if len(t) == 1]
        if model["type"] != "BPE" or len(alphabet) != 256 or model.get("continuing_subword_prefix"):
            return
        size = max(vocabulary.values()) + 1
        if not suffix and not spec["normalizer"] and cutter.get("type") == "ByteLevel" and not cutter["add_prefix_space"]:
            self.together, self.bytes_of = _BLANK_FIRST, np.zeros(size, np.int64)
            for token, n in vocabulary.items():
                self.bytes_of[n] = len(token)  # a character of the vocabulary is a byte
            if set(alphabet) == set(_SIGNS.values()):  # the same model, for words that need no pattern to be cut any more
                from tokenizers import Tokenizer, pre_tokenizers

                self.speller = Tokenizer(self.tokenizer.model)
                self.speller.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        elif suffix and all(t + suffix in vocabulary for t in alphabet) and [c["type"] for c in cutter.get("pretokenizers", [])] == ["Split", "ByteLevel"]:
            self.together, self.last = _ONE_WORD, np.zeros(size, bool)
            self.last[[n for token, n in vocabulary.items() if token.endswith(suffix)]] = True

    def _forget(self) -> None:
        self.known = pa.array([], pa.binary())
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _encoded(self, texts: list[str], spelled: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each has."""
        new = [e.ids for e in (self.speller if spelled else self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, new), np.int64, len(new))
        return np.fromiter(chain.from_iterable(new), np.uint32, int(size.sum())), size

    def _side_by_side(self, pieces: list[bytes], spelled: bool) -> tuple[np.ndarray, np.ndarray] | None:
        """As _encoded, by longer texts of many pieces each; None where the ids do not tell the pieces apart."""
        between = b" " if self.bytes_of is None else b""
        texts = [between.join(pieces[k : k + TOGETHER]) for k in range(0, len(pieces), TOGETHER)]
        ids, _ = self._encoded([t.decode("latin-1").translate(_SPELLED) if spelled else t.decode() for t in texts], spelled)
        if self.bytes_of is None:
            last = np.flatnonzero(self.last[ids])
            told = len(last) == len(pieces)
        else:
            edges, reached = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))), np.cumsum(self.bytes_of[ids])
            last = np.searchsorted(reached, edges)
            told = last[-1] < len(reached) and np.array_equal(reached[last], edges)
        return (ids, np.diff(last + 1, prepend=0)) if told else None

    def _learn(self, new: pa.Array, whole: set[bytes]) -> None:
        """Encode new pieces, those in ``whole`` alone; others side by side, where that gives the same."""
        pieces = _listed(new)
        how = np.zeros(len(pieces), np.uint8)  # 0: alone, 1: side by side, 2: spelled
        for k, pattern in ((1, self.together), (2, self.speller and _BLANK_WORD)):
            if pattern:
                how[pc.match_substring_regex(new, pattern).to_numpy(zero_copy_only=False)] = k
        if whole:
            how[np.fromiter((p in whole for p in pieces), bool, len(pieces))] = 0
        groups = []
        for k in range(3):
            at = np.flatnonzero(how == k)
            if len(at):
                some = [pieces[n] for n in at.tolist()]
                groups.append((at, *((k and self._side_by_side(some, k == 2)) or self._encoded([p.decode() for p in some]))))
        order, ids, size = (np.concatenate(x) for x in zip(*groups, strict=True))
        if len(groups) > 1:
            back = np.argsort(order)
            ids = _parts(_runs(np.append(0, np.cumsum(size)), ids).take(pa.array(back)))[1].view(np.uint32)
            size = size[back]
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(size)])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: list[str] | pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has; ``end`` is appended to each text.  A null text is empty."""
        if len(self.known) > self.limit:
            self._forget()
        column = flat(texts)
        at, raw = _parts(column)
        first = at[:-1][np.diff(at) > 0]  # of texts that are not empty
        marked = np.zeros(len(column), bool)
        for token in self.special:
            marked |= pc.match_substring(column, token, ignore_case=self.fold).to_numpy(zero_copy_only=False)
        starts = _starts(raw, first)
        for k in np.flatnonzero(marked):
            starts[at[k] + 1 : at[k + 1]] = False
        cuts = np.flatnonzero(starts)
        edges = np.append(cuts, len(raw))
        if self.fold and len(cuts):
            plain = np.maximum.reduceat(raw, cuts) < 128
            for k in np.flatnonzero(marked):
                plain[np.searchsorted(cuts, at[k])] = False
            upper = (raw >= 65) & (raw <= 90)
            if not plain.all():
                upper &= np.repeat(plain, np.diff(edges))
            raw = raw + (upper.view(np.uint8) << 5)
        kind, wide = (pa.binary(), np.int32) if len(raw) + self.known.nbytes < 2**31 else (pa.large_binary(), np.int64)
        cut = pa.Array.from_buffers(kind, len(cuts), [None, pa.py_buffer(edges.astype(wide)), pa.py_buffer(raw)])
        # known pieces first, so that they keep their numbers and new ones come behind
        known = len(self.known)
        coded = pa.concat_arrays([self.known.cast(kind), cut]).dictionary_encode()
        if len(coded.dictionary) > known:
            self._learn(coded.dictionary.slice(known), {raw[at[k] : at[k + 1]].tobytes() for k in np.flatnonzero(marked)})
            self.known = coded.dictionary
        runs = _runs(self.ends, self.ids).take(coded.indices.slice(known))
        before, out = _parts(runs)
        before, out = before // 4, out.view(np.uint32)
        lengths = np.diff(before[np.searchsorted(cuts, at)])
        if end is not None:
            out = np.insert(out, np.cumsum(lengths), end)
            lengths = lengths + 1
        return out, lengths


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder for all tasks that a Python worker runs."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def flat(texts: list[str] | pa.Array) -> pa.Array:
    """Texts as one column without nulls (those are empty)."""
    column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def _listed(values: pa.Array) -> list[bytes]:
    """As to_pylist, in a third of the time."""
    at, raw = _parts(values.cast(pa.large_binary()))
    at, raw = at.tolist(), raw.tobytes()
    return [raw[a:b] for a, b in zip(at, at[1:], strict=False)]


def _runs(ends: np.ndarray, ids: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(4 * ends), pa.py_buffer(ids)])


def _parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The edges of the values (large strings or binaries), from 0, and their bytes."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw


def slices(texts: list[str] | pa.Array, budget: int = 16_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``budget`` bytes each; a longer text stands alone."""
    at, _ = _parts(flat(texts))
    start = 0
    while start < len(at) - 1:
        stop = max(start + 1, int(np.searchsorted(at, at[start] + budget, side="right")) - 1)
        yield start, stop
        start = stop
