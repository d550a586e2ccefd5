"""From raw documents to packed sequences: STAGES in order, each reading what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontaminate, linetree, overlap, packing, quality
from tickloom.llm.common import stored, table
from tickloom.llm.queries import vocabulary


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    model = quality.fit(quality.with_labels(docs, table(spark, sf_dir, "labels")))
    return quality.judge(docs, model, host="source", path="lang").where("verdict.keep").select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines of recurring templates."""
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    out = linetree.drop_templates(docs, carry=rest).withColumnRenamed("kept", "text").withColumn("n_chars", F.length("text").cast("long"))
    return out.select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; documents without an id stay."""
    extra = overlap.near_groups(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(extra, "doc_id", "left_anti").select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; documents without an id stay."""
    leaks = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_good), ("line dedup", drop_lines), ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", drop_leaks), ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs


#: The classifier and the tokenizer have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None
