"""How filters overlap: what each removes in every order, from one contingency tensor per part.

One pass over the texts turns a document into a few flags.  Rows with the same flags are counted in Spark, so a part
is a tensor with one axis of length two (passes, fails) per filter.  Every figure of every order is a contraction of
that tensor with a vector for each axis: pass, fail, or all.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored

#: Runs of ASCII white space (fixed value): what separates words.
GAP = r"[\x20\x09-\x0D]+"

PASS, FAIL, ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
MEASURES = ("n", "good", "toxic")

RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, "
    "toxic_lost long, shapley long"
)


def text_filters(text: Column, few: int = 200) -> dict[str, Column]:
    """Failure conditions that a text alone decides.

    A: under ``few`` words; B: fewer distinct words than half of all; C: more than 3 % capitals A-Z; D: a mark of ``#$%&*|``.
    """
    words = F.array_remove(F.split(text, GAP), "")
    n, capitals = F.size(words), F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < few,
        "B": F.size(F.array_distinct(words)) * 100 < n * 50,
        "C": capitals.cast("long") * 100 > F.length(text).cast("long") * 3,
        "D": text.rlike("[#$%&*|]"),
    }


def flags(docs: DataFrame, labels: DataFrame, *, part: str = "lang", few: int = 200) -> tuple[DataFrame, str]:
    """(part, mask, good, toxic) of each row of documents, and the letters of the filters, lowest bit first.

    Filter E fails a row whose text also belongs to a smaller doc_id.  The first document of each text is found by a
    grouped minimum and joined on (doc_id, text hash), which no group of copies makes a hot key.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    alone = text_filters(text, few)
    letters = "".join(alone) + "E"
    mask = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(alone.values())), F.lit(0))
    rows = stored(
        docs.select(
            F.col("doc_id").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.sha2(text, 256).alias("same"), mask.alias("mask"),
        ),
        "audit-flags",
    )
    # a label may be given more than once; any 1 counts
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.col("quality").eqNullSafe(1).cast("int")).alias("good"),
        F.max(F.col("toxic").eqNullSafe(1).cast("int")).alias("toxic"),
    )
    first = rows.where("id is not null").groupBy("same").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    judged = rows.join(first, ["id", "same"], "left").join(known, "id", "left")
    return judged.select(
        "part", (F.col("mask") + F.when(copy, 1 << len(alone)).otherwise(0)).alias("mask"),
        F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"),
    ), letters


def contract(tensor: np.ndarray, chosen: dict[int, np.ndarray]) -> np.ndarray:
    """Sum of the cells that the chosen axes select; the other filter axes take all.  The last axis holds the measures."""
    k = tensor.ndim - 1
    operands: list = [tensor, [*range(k + 1)]]
    for axis in range(k):
        operands += [chosen.get(axis, ALL), [axis]]
    return np.einsum(*operands, [k])


def contractions(tensor: np.ndarray, letters: str) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for all orders of the filters."""
    k = len(letters)
    removed: dict[tuple[frozenset, int], np.ndarray] = {}
    for order in permutations(range(k)):
        for step, f in enumerate(order):
            before = frozenset(order[:step])
            if (before, f) not in removed:
                removed[before, f] = contract(tensor, {**dict.fromkeys(before, PASS), f: FAIL})
    fails = [contract(tensor, {f: FAIL})[0] for f in range(k)]
    alone = [contract(tensor, {**dict.fromkeys(range(k), PASS), f: FAIL})[0] for f in range(k)]
    shapley = [0] * k
    for order in permutations(range(k)):
        for step, f in enumerate(order):
            shapley[f] += int(removed[frozenset(order[:step]), f][0])
    for order in permutations(range(k)):
        for step, f in enumerate(order):
            gone = removed[frozenset(order[:step]), f]
            kept = contract(tensor, dict.fromkeys(order[: step + 1], PASS))[0]
            yield "".join(letters[i] for i in order), step + 1, kept, gone[0], fails[f] - gone[0], alone[f], gone[1], gone[2], shapley[f]


def interactions(docs: DataFrame, labels: DataFrame, *, part: str = "lang", few: int = 200) -> DataFrame:
    """One row per part, order of the filters A to E and step, with what that step keeps, removes and loses.

    A NULL text is empty, a NULL part the part ''.  A row without doc_id is nobody's copy and has no label.  Rows that
    repeat a doc_id each count; equal texts under one doc_id are not copies of each other.  Without rows there is no
    part and so no result.  Other columns of the input are not read.  What one task holds per part is 2^5 counts.
    """
    rows, letters = flags(docs, labels, part=part, few=few)
    counts = rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    k = len(letters)

    def each(cells: pd.DataFrame) -> pd.DataFrame:
        flat = np.zeros((1 << k, len(MEASURES)), np.int64)
        flat[cells["mask"].to_numpy()] = cells[list(MEASURES)].to_numpy()
        # bit i of the mask becomes axis i
        tensor = flat.reshape((2,) * k + (len(MEASURES),)).transpose([*range(k - 1, -1, -1), k])
        return pd.DataFrame([(cells["part"].iloc[0], *row) for row in contractions(tensor, letters)], columns=[c.split()[0] for c in RESULT.split(", ")])

    return counts.groupBy("part").applyInPandas(each, RESULT)
