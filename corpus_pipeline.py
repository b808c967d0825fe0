"""The corpus pipeline: documents in, packed training sequences out, one written table between stages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm.jaccard import one_of_each
from paperloom.llm.line_chunks import RESERVED, dedup_lines
from paperloom.llm.mixing import mixed_texts
from paperloom.llm.packing import pack
from paperloom.llm.quality_rules import keep_good
from paperloom.session import shared_folder


def sized(docs: DataFrame) -> DataFrame:
    """Texts that a stage has cut get their new length."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of lines that stand earlier in the corpus; those left empty go."""
    prefix = "__own"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    inner = docs.toDF(*[f"{prefix}{i}" if c.lower() in RESERVED else c for i, c in enumerate(docs.columns)])
    cut = dedup_lines(inner)
    return sized(cut.where("n_removed_lines = 0 OR text <> ''").select(inner.columns).toDF(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return one_of_each(docs, width=5, num=80, den=100)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row for each round that takes a document."""
    return sized(mixed_texts(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in their training sequences."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("source_mixing", mixing),
    ("best_fit_packing", packing),
]

#: Packing cuts tokens of a public vocabulary, which SQL can't express; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/paperloom-pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
