"""Operator 2: token ids in files of independently reset, checksummed blocks, arithmetic-coded under mixed predictions.

Model of a segment.  Order 2 and order 1 each predict one id, the most frequent that follows the same two ids (their hash) or the same id in
this segment, with a confidence of 0 to 3; how often predictions of such confidences come true in this segment weighs them.  Order 0
spreads the rest of the probability over all ids by their counts.  The head of the segment holds these tables.
The mixture drives a range coder of 64 bits that emits words of 32 bits; a carry goes into the words already emitted.
Coder and contexts start anew in each block.

All blocks of a segment are coded side by side, one id of each at a time, so each step is one set of array operations; what does
not depend on the coder is worked out for many steps at once.
A segment holds whole documents and stands for itself:

    magic, version, block size, documents, ids, blocks,
    bytes of the tables                                      7 little-endian unsigned 64-bit numbers
    document ids                                             int64 each, then one byte each: 1 if the id is null
    ids of each document                                     uint32 each
    ids, words and crc32 of each block                       uint32 each
    tables of the model                                      deflated
    crc32 of all that                                        uint32
    words of each block, one block after another             uint32 each
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import stored
from tickloom.llm.tokens import encoder, flat, slices

MAGIC, VERSION, BLOCK = 0x315344494B4F54, 2, 4096
#: Bits of the probability scale: of the shares of the orders, of order 0, and both.
MIX, FLAT = 12, 16
TOTAL = MIX + FLAT
#: Bits of the hash of two ids.
O2 = 16
LOW = np.uint64(0xFFFFFFFF)
MOST = 1 << 16
#: A context predicts if its most frequent id came so often; the share of that id gives the confidence.
OFTEN, SURE = 3, (0.12, 0.3, 0.6)
#: Pairs of confidences, and whether both orders predict the same id.
COMBINATIONS = 32
#: Ids for which the encoder prepares the steps at once.
AHEAD = 60_000
#: Bytes of text that are encoded at once.
SLICE = 24_000_000
#: Blocks lie so many ids apart in memory, as steps of a power of two share few lines of the processor's cache.
APART = 80


def _hash(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Of the id before (uint32) and that before it."""
    return (one * np.uint32(0x9E3779B1) + two * np.uint32(0x85EBCA6B)) >> np.uint32(32 - O2)


def _followers(context: np.ndarray, ids: np.ndarray, contexts: int) -> np.ndarray:
    """For each context (below 65,536) the id that most often follows and, from bit 16 on, the confidence."""
    table = np.zeros(contexts, np.int32)
    pairs = np.sort(context << np.uint32(16) | ids)
    new = np.ones(len(pairs), bool)
    np.not_equal(pairs[1:], pairs[:-1], out=new[1:])
    at = np.flatnonzero(new)
    count, pair = np.diff(at, append=len(pairs)), pairs[at].astype(np.int64)
    of = pair >> 16
    first = np.flatnonzero(np.diff(of, prepend=-1))
    best, total = np.maximum.reduceat(count << 16 | pair & 0xFFFF, first), np.add.reduceat(count, first)
    often = best >> 16
    table[of[first]] = np.where(often >= OFTEN, best & 0xFFFF | np.digitize(often / total, SURE) << 16, 0)
    return table


class _Model:
    """The predictions of all blocks (lanes) of a segment, and the spans of ids on the probability scale."""

    def __init__(self, follow1: np.ndarray, follow2: np.ndarray, share: np.ndarray, flat: np.ndarray):
        self.tables = follow1, follow2, share, flat
        self.follow1, self.follow2 = follow1, follow2 + (follow2 >> 16) * (3 << 16)  # the confidence of order 2 from bit 18 on
        m2, m12 = share[:, 0].astype(np.uint64), share.sum(axis=1, dtype=np.uint64)
        zero, m0 = np.zeros_like(m2), np.uint64(1 << MIX) - m12
        self.m2, self.m12, self.m0 = (m2 << np.uint64(FLAT)).astype(np.int64), (m12 << np.uint64(FLAT)).astype(np.int64), m0
        self.part = 1 / m0
        # by combination and outcome (neither, order 1, and order 2 twice): span = start + flat * of each id, size + flat * of each id
        self.start = (np.stack([m12, m2, zero, zero], axis=1) << np.uint64(FLAT)).ravel()
        self.size = (np.stack([zero, m12 - m2, m2, m2], axis=1) << np.uint64(FLAT)).ravel()
        self.flat = np.stack([m0, zero, zero, zero], axis=1).ravel()
        # place of an id in order 0 from bit 32 on, its room there from bit 48 on; in the same way, behind the id itself, for what is at each place
        room = flat.astype(np.uint64)
        self.spot = (np.cumsum(room) - room) << np.uint64(32) | room << np.uint64(48)
        self.owner = np.repeat(self.spot | np.arange(MOST, dtype=np.uint64), flat)

    @classmethod
    def fit(cls, ids: np.ndarray, block: int) -> tuple[_Model, np.ndarray]:
        """The model of all ids (uint32), and the combination and outcome of each."""
        one, two = np.roll(ids, 1), np.roll(ids, 2)
        one[::block], two[::block], two[1::block] = 0, 0, 0
        hashed = _hash(one, two)
        follow1, follow2 = _followers(one, ids, MOST), _followers(hashed, ids, 1 << O2)
        share, flat = np.zeros((COMBINATIONS, 2), np.uint16), np.zeros(MOST, np.uint16)
        early = cls(follow1, follow2, share, flat)
        key = np.empty(len(ids), np.uint8)
        for a in range(0, len(ids), AHEAD):
            b = slice(a, a + AHEAD)
            id1, id2, combination = early.predict(one[b], hashed[b])
            key[b] = (combination << 2) + ((id2 == ids[b]).view(np.uint8) << 1) + (id1 == ids[b])
        came = np.bincount(key, minlength=4 * COMBINATIONS).reshape(-1, 4)
        total = np.maximum(came.sum(axis=1), 1)
        share[:, 0] = 4 + came[:, 2:].sum(axis=1) * ((1 << MIX) - 16) // total
        share[: COMBINATIONS // 2, 1] = 4 + came[: COMBINATIONS // 2, 1] * ((1 << MIX) - 16) // total[: COMBINATIONS // 2]
        count = np.bincount(ids[(key & 3) == 0], minlength=MOST)
        there = np.flatnonzero(count)
        if len(there):
            ends = np.cumsum(count[there])
            ends = ends * (MOST - 1 - len(there)) // ends[-1] + np.arange(1, len(there) + 1)
            flat[there] = np.diff(ends, prepend=0)
        return cls(follow1, follow2, share, flat), key

    def dump(self) -> bytes:
        return zlib.compress(b"".join(t.astype(t.dtype.newbyteorder("<")).tobytes() for t in self.tables), 1)

    @classmethod
    def load(cls, data: bytes) -> _Model:
        raw, at, tables = zlib.decompress(data), 0, []
        for kind, n in (("<i4", MOST), ("<i4", 1 << O2), ("<u2", 2 * COMBINATIONS), ("<u2", MOST)):
            tables.append(np.frombuffer(raw, kind, n, at))
            at += tables[-1].nbytes
        return cls(tables[0], tables[1], tables[2].reshape(-1, 2), tables[3])

    def predict(self, one: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids that order 1 and 2 predict, and the combination (uint8)."""
        found1, found2 = self.follow1.take(one, mode="clip"), self.follow2.take(hashed, mode="clip")
        id1, id2 = found1 & 0xFFFF, found2 & 0xFFFF
        return id1, id2, ((found1 | found2) >> 16).astype(np.uint8) + ((id1 == id2).view(np.uint8) << 4)

    def span(self, ids: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of ids on the probability scale, by their combination and outcome."""
        key = key.astype(np.intp)
        return self._span(self.spot.take(ids, mode="clip"), key, self.flat.take(key, mode="clip"))

    def _span(self, spot: np.ndarray, key: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = spot >> np.uint64(32) & np.uint64(0xFFFF)
        return self.start.take(key, mode="clip") + flat * place, self.size.take(key, mode="clip") + flat * (spot >> np.uint64(48))

    def find(self, v: np.ndarray, one: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids (uint32) at places v (int64) of the probability scale, and their spans."""
        id1, id2, combination = self.predict(one, hashed)
        which = combination.astype(np.intp)
        over, flat = v - self.m12.take(which, mode="clip"), self.m0.take(which, mode="clip")
        hit2, hit12 = v < self.m2.take(which, mode="clip"), over < 0
        if len(self.owner):  # over // flat: half a place more keeps the rounded product off the whole numbers
            at = ((over + 0.5) * self.part.take(which, mode="clip")).astype(np.intp)
            spot = self.owner.take(at, mode="clip")
            np.putmask(spot, hit12, np.uint64(0))
        else:
            spot = np.zeros(len(v), np.uint64)
        ids = spot.astype(np.int32)
        np.putmask(ids, hit12, id1)
        np.putmask(ids, hit2, id2)
        return ids.view(np.uint32), *self._span(spot, (which << 2) + (hit2.view(np.uint8) << 1) + hit12, flat)


def _running(lengths: np.ndarray) -> list[int]:
    """How many blocks still run at each step; the longest come first."""
    return (len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")).tolist()


def encode_blocks(model: _Model, ids: np.ndarray, key: np.ndarray, block: int) -> list[np.ndarray]:
    """The words of each block of ids."""
    lengths = np.diff(np.append(np.arange(0, len(ids), block), len(ids)))
    steps, lanes = int(lengths[0]), len(lengths)
    by_lane = []
    for x in (ids.astype(np.uint16), key):
        filled = np.zeros((lanes, steps + APART), x.dtype)
        full = len(x) // steps
        filled[:full, :steps] = x[: full * steps].reshape(full, steps)
        filled[full:, : len(x) - full * steps] = x[full * steps :]
        by_lane.append(filled)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    words, at = np.zeros((lanes, steps + 2), np.uint32), np.zeros(lanes, np.int64)
    ahead = max(1, AHEAD // lanes)
    with np.errstate(over="ignore"):
        for t, n in enumerate(_running(lengths)):
            if t % ahead == 0:
                starts, shares = model.span(*(np.ascontiguousarray(x[:, t : t + ahead].T) for x in by_lane))
            r = size[:n] >> np.uint64(TOTAL)
            new_low, new_size = low[:n] + r * starts[t % ahead, :n], r * shares[t % ahead, :n]
            carry = np.flatnonzero(new_low < low[:n])
            back = at[carry] - 1
            while len(carry):
                words[carry, back] += np.uint32(1)
                on = words[carry, back] == 0
                carry, back = carry[on], back[on] - 1
            lane = np.flatnonzero(new_size <= LOW)
            out, to = new_low[lane], at[lane]
            words[lane, to] = out >> np.uint64(32)
            at[lane] = to + 1
            new_low[lane] = out << np.uint64(32)
            new_size[lane] <<= np.uint64(32)
            low[:n], size[:n] = new_low, new_size
    for word in (low >> np.uint64(32), low & LOW):
        words[np.arange(lanes), at] = word.astype(np.uint32)
        at += 1
    return [words[lane, : at[lane]] for lane in range(lanes)]


def decode_blocks(model: _Model, coded: list[np.ndarray], lengths: np.ndarray) -> list[np.ndarray]:
    """The ids of each block; no block is longer than the one before."""
    if not coded:
        return []
    steps, lanes = int(lengths[0]), len(coded)
    wide = max(map(len, coded)) + 2
    words = np.zeros((lanes, wide), np.uint32)
    for lane, x in enumerate(coded):
        words[lane, : len(x)] = x
    # the code is kept as its distance from the start of the range
    code, at = (words[:, 0].astype(np.uint64) << np.uint64(32)) | words[:, 1], np.arange(lanes) * wide + 2
    words, last = words.ravel(), np.arange(1, lanes + 1) * wide - 1
    ids, size = np.zeros((lanes, steps + APART), "<u4"), np.full(lanes, 2**64 - 1, np.uint64)
    ahead = max(1, AHEAD // lanes)
    found = np.zeros((ahead, lanes), np.uint32)
    one = two = np.zeros(lanes, np.uint32)
    most = np.uint64((1 << TOTAL) - 1)
    with np.errstate(over="ignore"):
        for t, n in enumerate(_running(lengths)):
            if n < len(one):
                one, two, code, size, at = one[:n], two[:n], code[:n], size[:n], at[:n]
            r = size >> np.uint64(TOTAL)
            x, start, share = model.find(np.minimum(code // r, most).view(np.int64), one, _hash(one, two))
            code, size = code - r * start, r * share
            lane = np.flatnonzero(size <= LOW)
            to = at[lane]
            code[lane] = (code[lane] << np.uint64(32)) | words[np.minimum(to, last[lane])]
            at[lane] = to + 1
            size[lane] <<= np.uint64(32)
            found[t % ahead, :n] = x
            if t % ahead == ahead - 1 or t == steps - 1:
                ids[:, t - t % ahead : t + 1] = found[: t % ahead + 1].T
            one, two = x, one
    return [ids[lane, :n] for lane, n in enumerate(lengths.tolist())]


def write_segment(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    if len(ids) and int(ids.max()) >= MOST:
        raise ValueError(f"ids must be below {MOST}")
    ids = ids.astype("<u4")
    blocks = [ids[a : a + block] for a in range(0, len(ids), block)]
    tables, coded = b"", []
    if blocks:
        model, key = _Model.fit(ids, block)
        tables, coded = model.dump(), encode_blocks(model, ids, key, block)
    head = b"".join((
        np.array([MAGIC, VERSION, block, len(doc_ids), len(ids), len(blocks), len(tables)], "<u8").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bytes(d is None for d in doc_ids), sizes.astype("<u4").tobytes(),
        *(np.array(x, "<u4").tobytes() for x in ([len(b) for b in blocks], [len(c) for c in coded], [zlib.crc32(b) for b in blocks])), tables,
    ))
    return b"".join((head, np.array([zlib.crc32(head)], "<u4").tobytes(), *(c.astype("<u4").tobytes() for c in coded)))


def read_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their numbers of ids, and all ids.  Raises ValueError when a checksum does not fit."""
    magic, version, _, docs, n_ids, blocks, n_tables = np.frombuffer(data, "<u8", 7).tolist()
    if (magic, version) != (MAGIC, VERSION):
        raise ValueError("not a segment of this version")
    tables = 56 + 13 * docs + 12 * blocks
    at = tables + n_tables
    if at + 4 > len(data) or zlib.crc32(memoryview(data)[:at]) != np.frombuffer(data, "<u4", 1, at)[0]:
        raise ValueError("the head of a segment is damaged")
    names, null = np.frombuffer(data, "<i8", docs, 56).tolist(), data[56 + 8 * docs : 56 + 9 * docs]
    sizes = np.frombuffer(data, "<u4", docs, 56 + 9 * docs)
    lengths, words, sums = np.frombuffer(data, "<u4", 3 * blocks, 56 + 13 * docs).reshape(3, -1).astype(np.int64)
    model, coded = _Model.load(data[tables:at]) if blocks else None, []
    at += 4
    for w in words.tolist():
        coded.append(np.frombuffer(data, "<u4", w, at))
        at += 4 * w
    plain = decode_blocks(model, coded, lengths)
    for k, (x, crc) in enumerate(zip(plain, sums.tolist(), strict=True)):
        if zlib.crc32(x) != crc:
            raise ValueError(f"block {k} of a segment is damaged")
    ids = np.concatenate(plain) if plain else np.zeros(0, np.uint32)
    if len(ids) != n_ids:
        raise ValueError("a segment is incomplete")
    return [None if z else d for d, z in zip(names, null, strict=True)], sizes, ids


def write_ids(
    docs: DataFrame, path: str, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", end: int = 0, segment_ids: int = 8_000_000,
) -> None:
    """Write all documents' ids in ascending order of doc_id, each document followed by ``end``, to a folder of files.

    Rows of the files: part and segment, which give the order, the number of ids, and the segment.  Null texts are empty (one id); null document ids
    come first; repeated ones stay, in any order among themselves; an empty table gives an empty folder; other columns are
    ignored.  Documents are never split over segments, so a segment can exceed ``segment_ids`` by one document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        part, segment = TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal segment, total
            if names:
                data = write_segment(names, np.concatenate([s for _, s in held]), np.concatenate([i for i, _ in held]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([total], pa.int64()), pa.array([data], pa.binary())],
                    names=["part", "segment", "n_ids", "data"],
                )
                segment, total = segment + 1, 0
                names.clear()
                held.clear()

        for batch in batches:
            ids_of, texts = batch.column(0).to_pylist(), flat(batch.column(1))
            for a, b in slices(texts, SLICE):
                ids, sizes = encode(texts.slice(a, b - a), end)
                names.extend(ids_of[a:b])
                held.append((ids, sizes))
                total += len(ids)
                if total >= segment_ids:
                    yield from flush()
        yield from flush()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, "part int, segment int, n_ids long, data binary").write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (binary, little-endian unsigned 32-bit) of each document in the files of ``write_ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, n_ids, data in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                names, sizes, ids = read_segment(data)
                if len(ids) != n_ids:
                    raise ValueError("a segment is not the one that was written")
                raw, at = ids.astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                for a in range(0, len(names), 2000):
                    b = min(a + 2000, len(names))
                    parts = [raw[4 * x : 4 * y] for x, y in zip(at[a:b].tolist(), at[a + 1 : b + 1].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[a:b], pa.int64()), pa.array(base + at[a:b]), pa.array(sizes[a:b].astype(np.int64)), pa.array(parts, pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    files = spark.read.schema("part int, segment int, n_ids long, data binary").parquet(path)
    before = F.sum("n_ids").over(Window.orderBy("part", "segment").rowsBetween(Window.unboundedPreceding, -1))
    # one row for each segment of millions of ids; as a table, its size is known and it goes to the segments, not they to it
    base = stored(files.select("part", "segment", F.coalesce(before, F.lit(0)).cast("long").alias("base")), "segment-starts")
    placed = files.join(base, ["part", "segment"]).select("base", "n_ids", "data")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
