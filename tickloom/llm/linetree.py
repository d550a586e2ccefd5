"""Operator 8: lines made from recurring templates, found with a log-template tree of fixed depth.

The tree leads from a line's number of tokens over its first tokens (those with a digit count as variable) to a leaf.  In a leaf, the
tokens of a line that the most documents have at their places are its template; the others are variable fields.
So each line has one template, whatever the order in which lines are seen, and everything is counted with
grouped sums: no leaf is ever gathered in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import WordHashes, stored

_HASHES = WordHashes()
_VARIABLE = re.compile(rb"\S*\d\S*")
_DIGIT = re.compile(rb"\d")
_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")
FIELD = b"<*>"


def _masked(line: bytes) -> list[bytes]:
    """A line's tokens, those with a digit as FIELD; a line without any other word keeps its numbers, as they are all it says."""
    if not _DIGIT.search(line):
        return line.split()
    masked = _VARIABLE.sub(FIELD, line).split()
    return masked if any(w != FIELD and _LETTER.search(w) for w in masked) else line.split()


def place(line: bytes, depth: int) -> tuple[int, int] | None:
    """Leaf and identity of a line as signed 64-bit numbers; None for a blank line."""
    masked = _masked(line)
    if not masked:
        return None
    leaf = xxhash.xxh64_intdigest(b" ".join((str(len(masked)).encode(), *masked[:depth])))
    return leaf - (1 << 63), xxhash.xxh64_intdigest(b" ".join(masked)) - (1 << 63)


def tokens(line: bytes) -> np.ndarray:
    """Hashes of a line's tokens; 0 for variable ones."""
    words = _masked(line)
    h = _HASHES.of(words).view(np.int64).copy()
    h[[k for k, w in enumerate(words) if w == FIELD]] = 0
    return h


def drop_templates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", depth: int = 3, min_docs: int = 10, similarity: float = 0.8,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, n_lines, dropped (line numbers from 0, in order), kept (the other lines) and the columns ``carry`` of every document.

    A template recurs when documents of at least ``min_docs`` different texts hold it and at least ``similarity`` of its tokens are
    fixed.  Of the tokens that ``min_docs`` texts have at their place in the leaf, a line's fixed ones are the most frequent,
    as many as ``similarity`` asks for and those as frequent as the last of them, so a field of many values stays a field however
    many texts have each value; tokens with a digit match any other and are left out of the share, but a line that has nothing else
    matches its copies only.  The template's lines are dropped from all documents but the one with the smallest doc_id that has it, so no content is lost
    altogether.  Exact copies of a text count once.  Lines end at \\n; tokens are runs without ASCII white space; blank
    lines are kept and belong to no template.  Null texts count as empty (kept is null).  Rows with a null doc_id are kept whole and not
    counted; rows that repeat a doc_id are treated by their own texts.  Other columns are ignored; an empty table gives no rows.
    """
    content = F.col(text).cast("binary")
    extra = [F.col(c).alias(f"carried_{k}") for k, c in enumerate(carry)]
    docs = docs.select(F.col(doc_id).cast("long").alias("doc"), F.xxhash64(content).alias("t1"), content.alias("text"), *extra)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, leaf, line = [], [], []
            for k, body in enumerate(batch.column(2).to_pylist()):
                found = {p for x in (body or b"").split(b"\n") if (p := place(x, depth))}
                where.extend([k] * len(found))
                leaf.extend(p[0] for p in found)
                line.extend(p[1] for p in found)
            at = pa.array(where, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(leaf, pa.int64()), pa.array(line, pa.int64())], names=["doc", "t1", "leaf", "line"]
            )

    lines = stored(docs.where("doc is not null").select("doc", "t1", "text").mapInArrow(parse, "doc long, t1 long, leaf long, line long"), "lines")
    # one document for each text; a line of a text counts once
    origin = docs.where("doc is not null").groupBy("t1").agg(F.min("doc").alias("doc"))
    distinct = lines.join(origin, ["t1", "doc"], "left_semi").dropDuplicates(["t1", "leaf", "line"]).groupBy("leaf", "line").agg(
        F.count("*").alias("n"), F.min("doc").alias("first")
    )
    distinct = stored(distinct, "distinct-lines")
    busy = distinct.groupBy("leaf").agg(F.sum("n").alias("all")).where(F.col("all") >= min_docs).select("leaf")
    asked = distinct.join(busy, "leaf")
    wanted = asked.groupBy(F.col("first").alias("doc")).agg(F.collect_list(F.struct("line", "n")).alias("wanted"))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, line, count, first, toks = [], [], [], [], []
            for doc, body, want in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                open_ = {w["line"]: w["n"] for w in want}
                for x in (body or b"").split(b"\n"):
                    p = place(x, depth)
                    if p and p[1] in open_:
                        leaf.append(p[0])
                        line.append(p[1])
                        count.append(open_.pop(p[1]))
                        first.append(doc)
                        toks.append(tokens(x))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in (leaf, line, count, first)), pa.array(toks, pa.list_(pa.int64()))], names=["leaf", "line", "n", "first", "tokens"]
            )

    spelt = docs.join(wanted, "doc").select("doc", "text", "wanted").mapInArrow(spell, "leaf long, line long, n long, first long, tokens array<long>")
    spelt = stored(spelt.dropDuplicates(["leaf", "line"]), "spelt")
    token = spelt.select("leaf", "line", "n", "first", F.posexplode("tokens").alias("at", "token"))
    fixed = token.where("token <> 0").groupBy("leaf", "at", "token").agg(F.sum("n").alias("docs")).where(F.col("docs") >= min_docs)
    shape = token.join(fixed, ["leaf", "at", "token"], "left").groupBy("leaf", "line", "n", "first").agg(
        F.collect_list(F.when(F.col("docs").isNotNull(), F.struct("docs", "at", "token"))).alias("fixed"), F.count_if(F.col("token") != 0).alias("size"),
    )
    asked_for = F.greatest(F.lit(1), F.ceil(F.col("size") * similarity - 1e-9)).cast("int")
    shape = shape.where(F.size("fixed") >= asked_for)
    shape = shape.withColumn("rarest", F.element_at(F.sort_array("fixed", asc=False), asked_for)["docs"])
    shape = shape.withColumn("fixed", F.filter("fixed", lambda x: x["docs"] >= F.col("rarest")))
    template = F.xxhash64(F.array_sort(F.transform("fixed", lambda x: F.struct(x["at"], x["token"])))).alias("template")
    shape = stored(shape.select("leaf", "line", "n", "first", template), "templates")
    recurring = shape.groupBy("leaf", "template").agg(F.sum("n").alias("docs"), F.min("first").alias("keeper")).where(F.col("docs") >= min_docs)
    drop = shape.join(recurring, ["leaf", "template"]).select("line", "keeper")
    gone = lines.join(drop, "line").where("doc <> keeper").groupBy("doc", "t1").agg(F.collect_list("line").alias("gone"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, body, gone_ in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                rows = (body or b"").split(b"\n")
                away = set(gone_ or ())
                dropped = [k for k, x in enumerate(rows) if (p := place(x, depth)) and p[1] in away] if away else []
                leave = set(dropped)
                out.append((doc, len(rows), dropped, b"\n".join(x for k, x in enumerate(rows) if k not in leave) if body is not None else None))
            cols = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int64())), pa.array(cols[3], pa.binary()), *batch.columns[3:]],
                names=["doc_id", "n_lines", "dropped", "kept", *batch.schema.names[3:]],
            )

    names = [f"carried_{k}" for k in range(len(carry))]
    marked = docs.join(gone, ["doc", "t1"], "left").select("doc", "text", "gone", *names)
    schema = T.StructType.fromDDL("doc_id long, n_lines long, dropped array<long>, kept binary")
    for f in marked.schema.fields[3:]:
        schema = schema.add(f)
    out = marked.mapInArrow(cut, schema)
    return out.select("doc_id", "n_lines", "dropped", F.col("kept").cast("string").alias("kept"), *(F.col(n).alias(c) for n, c in zip(names, carry, strict=True)))
