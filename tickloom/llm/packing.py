"""Operator 7: token sequences of one length, balanced by what attention will cost."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tokens import encoder, flat, slices

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def assign(
    lengths: np.ndarray, capacity: int = 2048, linear: float = 1.0, quadratic: float = 1 / 4096,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, sequence, offset) arrays of the pieces of documents with these lengths.

    A document's cost is linear * n + quadratic * n ** 2.  Whole multiples of the capacity fill sequences of their own; the
    rests, longest first, go to the sequence of lowest cost that still has room for all of it.  There are as many such
    sequences as the rests fill completely.  A rest that fits nowhere whole is cut to fill the gaps, cheapest sequence first, and
    what is then left goes into sequences whose lengths are powers of two, so nothing is padded at all.
    """
    out: list[tuple[int, int, int, int, int]] = []
    n_seq = 0
    rests = []
    for d, n in enumerate(lengths.tolist()):
        for start in range(0, n - capacity + 1, capacity):
            out.append((d, start, capacity, n_seq, 0))
            n_seq += 1
        if n % capacity:
            rests.append((-(n % capacity), d, n - n % capacity))
    rests.sort()
    cost = lambda n: linear * n + quadratic * n * n
    count = -sum(r for r, _, _ in rests) // capacity
    base, n_seq = n_seq, n_seq + count
    used, spent = [0] * count, [0.0] * count
    ready = [(0.0, s) for s in range(count)]
    parked: list[list[int]] = [[] for _ in range(capacity + 1)]  # sequences by their room, until a rest is that short
    level, left = capacity, []
    for minus, d, start in rests:
        n = -minus
        while level > n:
            level -= 1
            for s in parked[level]:
                heapq.heappush(ready, (spent[s], s))
            parked[level] = []
        while ready and capacity - used[ready[0][1]] < n:
            s = heapq.heappop(ready)[1]
            parked[capacity - used[s]].append(s)
        if not ready:
            left.append((d, start, n))
            continue
        s = heapq.heappop(ready)[1]
        out.append((d, start, n, base + s, used[s]))
        used[s] += n
        spent[s] += cost(n)
        room = capacity - used[s]
        if room >= level:
            heapq.heappush(ready, (spent[s], s))
        elif room:
            parked[room].append(s)
    gaps = [(base + s, used[s], capacity - used[s]) for s in sorted(range(count), key=lambda s: (spent[s], s)) if used[s] < capacity]
    over = sum(n for _, _, n in left) - sum(room for _, _, room in gaps)
    for bit in reversed(range(over.bit_length())):
        if over >> bit & 1:
            gaps.append((n_seq, 0, 1 << bit))
            n_seq += 1
    gaps.reverse()
    for d, start, n in left:
        while n:
            s, at, room = gaps.pop()
            take = min(n, room)
            out.append((d, start, take, s, at))
            start, n = start + take, n - take
            if room > take:
                gaps.append((s, at + take, room - take))
    table = np.array(out, np.int64).reshape(-1, 5)
    return tuple(table.T)


def pack(
    docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", end: int = 1, capacity: int = 2048,
    chunk_tokens: int = 3_000_000,
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    Each document's ids are its tokens and ``end``; each id is in one piece, and a sequence's pieces have no gap between them.
    Each task packs what it reads, in turns of ``chunk_tokens`` ids, in one pass and without a shuffle: a sequence is
    full, or its length is a power of two.  Null texts are empty (one id); null or repeated document ids are packed like others; a
    long document spans several sequences; an empty table gives no rows; other columns are ignored.  sequence_id joins the task's
    number and a count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        task = TaskContext.get().partitionId() << 40
        held_docs: list[int | None] = []
        held_ids: list[np.ndarray] = []
        held_sizes: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal task
            if not held_docs:
                return
            ids, sizes = np.concatenate(held_ids).astype("<u4"), np.concatenate(held_sizes)
            names = pa.array(held_docs, pa.int64())
            d, start, length, sequence, offset = assign(sizes, capacity)
            first = (np.cumsum(sizes) - sizes)[d] + start
            raw = ids.tobytes()
            for a in range(0, len(d), 4096):
                b = slice(a, a + 4096)
                parts = [raw[4 * f : 4 * (f + n)] for f, n in zip(first[b].tolist(), length[b].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(d[b])), pa.array(start[b]), pa.array(length[b]), pa.array(parts, pa.binary()),
                     pa.array(sizes[d[b]]), pa.array(task + sequence[b]), pa.array(offset[b])],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )
            task += int(sequence.max()) + 1
            held_docs.clear()
            held_ids.clear()
            held_sizes.clear()

        total = 0
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), flat(batch.column(1))
            for a, b in slices(texts):
                ids, sizes = encode(texts.slice(a, b - a), end)
                held_docs.extend(names[a:b])
                held_ids.append(ids)
                held_sizes.append(sizes)
                total += len(ids)
                if total >= chunk_tokens:
                    yield from flush()
                    total = 0
        yield from flush()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)
