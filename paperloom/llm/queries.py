"""The operators over whole tables, with production parameters, and their SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import sql
from paperloom.llm.alignment import alignment
from paperloom.llm.ann import search
from paperloom.llm.common import table
from paperloom.llm.decontaminate import contamination
from paperloom.llm.html_text import main_text
from paperloom.llm.jaccard import link
from paperloom.llm.licences import scan
from paperloom.llm.line_chunks import dedup_lines
from paperloom.llm.manifest import manifest
from paperloom.llm.mixing import mix, n_words
from paperloom.llm.nbsvm import quality
from paperloom.llm.packing import pack
from paperloom.llm.quality_rules import judge
from paperloom.llm.sharding import layout, shard


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("places")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), n_words(F.col("text"))).drop("source")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).drop("longest_repeat")


def op4_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(table(spark, sf_dir, "documents"), layout(16), layout(17))
    return placed.withColumn("law", F.lit("key"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


def op7_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op9_nb_support_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_line_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed_lines", "text")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"))


def op12_benchmark_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items", "n_near")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"), tampered=F.crc32(F.col("doc_id").cast("string")) % 7 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_licence_scan, op2_source_mix, op3_quality_rules, op4_learned_partitions, op5_hash_tree_shards, op6_ngram_jaccard_join,
        op7_html_main_text, op8_best_fit_packing, op9_nb_support_vectors, op10_line_chunk_dedup,
        op11_token_alignment, op12_benchmark_index, op13_merkle_manifest,
    )
}

ORACLE_SQL = {
    "op1_licence_scan": sql.LICENCES,
    "op2_source_mix": sql.MIX,
    "op3_quality_rules": sql.QUALITY,
    "op5_hash_tree_shards": sql.SHARDS,
    "op6_ngram_jaccard_join": sql.JACCARD,
    "op10_line_chunk_dedup": sql.LINES,
    "op12_benchmark_index": sql.DECONTAMINATION,
    "op13_merkle_manifest": sql.MANIFEST,
}
