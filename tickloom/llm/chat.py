"""Operator 1: reply trees turned into conversations, with a loss mask over what the assistant says."""

from __future__ import annotations

import hashlib
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import stored

#: One turn is HEAD role MIDDLE text END.  Inside roles and texts these strings and the backslash are replaced, so a
#: formatted text can be cut at END alone; every backslash in it starts one of the replacements.
HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
ESCAPES = [("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t")]
ROLE_ESCAPES = [*ESCAPES, (": ", "\\c")]


def escaped(text: Column, table: list[tuple[str, str]] = ESCAPES) -> Column:
    for plain, safe in table:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: str, table: list[tuple[str, str]] = ESCAPES) -> str:
    for plain, safe in reversed(table):
        text = text.replace(safe, plain)
    return text


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of a formatted conversation, exactly as they went in."""
    turns = []
    for turn in formatted.split(END)[:-1]:
        role, _, text = turn[len(HEAD) :].partition(MIDDLE)
        turns.append((unescape(role, ROLE_ESCAPES), unescape(text)))
    return turns


def best_paths(nodes: DataFrame, top: int = 1) -> DataFrame:
    """(tree, leaf, node, position) of the root-to-leaf paths with the highest summed scores, ``top`` per tree.

    nodes: tree, node, parent, score.  Self-joins double the reach of every node's pointer to an ancestor, so a tree of
    depth d takes log2(d) of them; the same pointers, largest first, then list each chosen leaf's ancestors once.
    A missing parent makes a root.  Nodes on a ring of parents, or below one, lie on no path from a root and give none.
    """
    start = nodes.alias("n").join(
        nodes.select(F.col("tree").alias("t"), F.col("node").alias("p")).alias("q"),
        (F.col("n.tree").eqNullSafe(F.col("t"))) & (F.col("n.parent") == F.col("p")), "left",
    ).select("n.tree", "n.node", F.col("p").alias("jump"), F.when(F.col("p").isNull(), 0).otherwise(1).cast("long").alias("depth"),
             F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("gain"))
    state = stored(start, "reach")
    largest = state.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    pointers = []
    for _ in range(math.ceil(math.log2(max(2, largest))) + 1):
        if not state.where("jump is not null").limit(1).count():
            break
        pointers.append(state.select(F.col("tree").alias("t"), F.col("node").alias("from"), F.col("jump").alias("to")).where("to is not null"))
        far = state.select(F.col("tree").alias("t"), F.col("node").alias("p"), F.col("jump").alias("j"), F.col("depth").alias("d"), F.col("gain").alias("g"))
        further = state.where("jump is not null").join(far, F.col("tree").eqNullSafe(F.col("t")) & (F.col("jump") == F.col("p"))).select(
            "tree", "node", F.col("j").alias("jump"), (F.col("depth") + F.col("d")).alias("depth"), (F.col("gain") + F.col("g")).alias("gain")
        )
        state = stored(state.where("jump is null").unionByName(further), "reach")
    parents = nodes.where("parent is not null").select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    leaves = state.where("jump is null").join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("p")), "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("gain"), "node"))
    chosen = leaves.withColumn("_rank", rank).where(F.col("_rank") <= top)
    paths = chosen.select("tree", F.col("node").alias("leaf"), "node", F.col("depth").alias("position"))
    for k in reversed(range(len(pointers))):
        hop = paths.where(F.col("position") >= 2**k).join(pointers[k], F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("from")))
        hop = hop.select("tree", "leaf", F.col("to").alias("node"), (F.col("position") - 2**k).alias("position"))
        paths = stored(paths.unionByName(hop), "paths")
    return paths


def format_conversations(
    turns: DataFrame, *, tree: str = "tree", node: str = "node", parent: str = "parent", role: str = "role", text: str = "text",
    score: str | None = None, top: int = 1, learn: str = "assistant",
) -> DataFrame:
    """tree, leaf, n_turns, formatted and loss_spans of the best ``top`` root-to-leaf paths of each reply tree.

    A path's rank is the sum of its nodes' scores (null or no score: 0), ties go to the smaller leaf.  loss_spans are the
    [start, end) positions, in code points of ``formatted``, of each text whose role is ``learn``, in order.  Null texts and
    roles count as empty.  Rows without a node id belong to no tree and are left out; null is a tree id like any other; of rows
    that repeat a node id the first by (parent, role, text) stands.  Other columns are ignored; an empty table gives no rows.
    A conversation becomes one row, so its text has to fit into one task.
    """
    c = lambda name, kind=None: F.coalesce(F.col(name), F.lit("")) if kind else F.col(name)
    rows = turns.select(
        c(tree).alias("tree"), c(node).alias("node"), c(parent).alias("parent"), c(role, str).alias("role"), c(text, str).alias("text"),
        (F.col(score).cast("double") if score else F.lit(0.0)).alias("score"),
    ).where("node is not null")
    rows = rows.groupBy("tree", "node").agg(F.min(F.struct("parent", "role", "text", "score")).alias("r")).select("tree", "node", "r.*")
    rows = stored(rows, "turns")
    paths = best_paths(rows.select("tree", "node", "parent", "score"), top).alias("p")
    told = paths.join(rows.alias("r"), F.col("p.tree").eqNullSafe(F.col("r.tree")) & (F.col("p.node") == F.col("r.node"))).select(
        "p.tree", "leaf", "position", "role", escaped(F.col("role"), ROLE_ESCAPES).alias("label"), escaped(F.col("text")).alias("body")
    )
    size = F.length("label") + F.length("body") + len(HEAD) + len(MIDDLE) + len(END)
    before = F.sum(size).over(Window.partitionBy("tree", "leaf").orderBy("position").rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(before, F.lit(0)) + len(HEAD) + F.length("label") + len(MIDDLE)
    piece = F.concat(F.lit(HEAD), "label", F.lit(MIDDLE), "body", F.lit(END))
    span = F.when(F.col("role") == learn, F.struct(start.alias("start"), (start + F.length("body")).alias("end")))
    parts = told.select("tree", "leaf", F.struct("position", piece.alias("piece"), span.alias("span")).alias("s"))
    parts = parts.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list("s")).alias("s"))
    return parts.select(
        "tree", "leaf", F.size("s").cast("long").alias("n_turns"), F.array_join(F.col("s.piece"), "").alias("formatted"),
        F.filter(F.col("s.span"), lambda x: x.isNotNull()).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turn and loss digests, computed from the formatted text and the spans alone."""

    @F.pandas_udf("struct<n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string>")
    def digests(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for text, marks in zip(texts, spans, strict=True):
            turns = parse(text)
            whole = "".join(f"{role}\n{said}\n" for role, said in turns)
            learnt = "".join(unescape(text[m["start"] : m["end"]]) for m in marks)
            out.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest()))
        return pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256"])

    return formatted.select("tree", digests("formatted", "loss_spans").alias("d"), F.length("formatted").cast("long").alias("formatted_chars"))
