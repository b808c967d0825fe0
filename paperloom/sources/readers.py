"""Sources: JSON, JSON lines and file listings, each with its explicit schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom import constants as K
from paperloom import schemas as S
from paperloom.functions.predicates import is_pending
from paperloom.functions.text import nonempty


def _objects(spark: SparkSession, root: str, schema: T.StructType, name: str, recursive: bool = True) -> DataFrame:
    """One JSON object per file.  Many small files: land them as Parquet once when read often."""
    reader = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", name)
    return reader.option("recursiveFileLookup", recursive).json(root).withColumn("file_path", _plain(F.col("_metadata.file_path")))


def _plain(uri: Column) -> Column:
    """Path of a file URI, with its escapes undone."""
    return F.url_decode(F.replace(F.regexp_replace(uri, "^file:/+", "/"), F.lit("+"), F.lit("%2B")))


def _folder(path: Column, up: int) -> Column:
    return F.element_at(F.split(path, "/"), -1 - up)


def labels(spark: SparkSession, root: str) -> DataFrame:
    """All ``label.json`` files below ``root``; the folder names the case where the file does not."""
    rows = _objects(spark, root, S.LABEL, "label.json")
    return rows.select(
        F.coalesce("case_id", _folder(F.col("file_path"), 1)).alias("case_id"),
        *[c for c in S.LABEL.names if c != "case_id"], F.col("file_path").alias("label_path"),
        is_pending(F.col("file_path"), root.rstrip("/")).alias("pending"), F.col("case_id").isNotNull().alias("has_case_id"),
    )


def expected_cases(spark: SparkSession, root: str, id_from: str = "payload") -> DataFrame:
    """``expected.json`` files: id from the payload (any depth) or from the folder (one level)."""
    rows = _objects(spark, root, S.EXPECTED, "expected.json")
    if id_from == "folder":
        depth = F.size(F.split(F.col("file_path"), "/")) - len(root.rstrip("/").split("/"))
        return rows.filter(depth == 2).withColumn("case_id", _folder(F.col("file_path"), 1))
    return rows.filter("case_id IS NOT NULL AND case_id <> '' AND document_type IS NOT NULL AND document_type <> ''")


def run_results(spark: SparkSession, folder: str) -> DataFrame:
    """Run results of one folder; of several files for a case the last by name counts."""
    rows = _objects(spark, folder, S.RUN_RESULT, "*.json", recursive=False)
    return latest_results(rows).select(*S.RUN_RESULT.names)


def latest_results(rows: DataFrame) -> DataFrame:
    """Complete results only, and of several for a case the one of the last file."""
    complete = rows.filter("case_id IS NOT NULL AND extracted_documents IS NOT NULL")
    payload = F.struct(*[c for c in rows.columns if c != "case_id"])
    return complete.groupBy("case_id").agg(F.max_by(payload, F.col("file_path")).alias("row")).select("case_id", "row.*")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Crop or hard-case manifest in JSON lines; an absent path is an empty relation."""
    try:
        return spark.read.schema(S.CROP).json(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], S.CROP)


def _count(col: str) -> Column:
    return F.coalesce(col, F.lit(0)).cast("bigint")


def profiles_from(groups: DataFrame) -> DataFrame:
    """Rows from a map of group summaries, absent members replaced by 0, '' or an empty list."""
    rows = groups.select(F.explode("groups").alias("field_group", "g")).filter("g IS NOT NULL")
    names = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    return rows.select(
        "field_group", _count("g.train_count").alias("train_count"), _count("g.val_count").alias("val_count"),
        F.coalesce(F.try_element_at("g.data_profile.unique_source_counts", F.lit(K.TRAIN)), F.lit(0)).alias("train_source_count"),
        F.coalesce(F.try_element_at("g.data_profile.unique_source_counts", F.lit(K.VAL)), F.lit(0)).alias("val_source_count"),
        F.coalesce("g.data_profile.hard_case_train_ratio", F.lit(0.0)).alias("hard_case_train_ratio"),
        F.coalesce(F.try_element_at("g.data_profile.unique_hard_case_variant_counts", F.lit(K.TRAIN)), F.lit(0)).alias(
            "unique_hard_case_variant_count"
        ),
        F.coalesce("g.training_readiness.status", F.lit("")).alias("training_readiness_status"),
        names("g.training_readiness.blocking_warnings").alias("blocking_warnings"),
        names("g.training_readiness.advisory_warnings").alias("advisory_warnings"),
        F.coalesce("g.data_profile.hard_case_selection_strategy", F.lit("")).alias("hard_case_selection_strategy"),
        F.coalesce("g.data_profile.hard_case_variant_floor_applied", F.lit(False)).alias("hard_case_variant_floor_applied"),
        _count("g.data_profile.filtered_hard_case_train_count").alias("filtered_hard_case_train_count"),
        F.coalesce(
            F.try_element_at(
                F.try_element_at("g.data_profile.counts_by_source_type", F.lit(K.TRAIN)), F.lit("hard_case")
            ), F.lit(0),
        ).alias("train_hard_count"),
    )


def training_profiles(spark: SparkSession, path: str) -> DataFrame:
    return profiles_from(spark.read.schema(S.TRAINING_SUMMARY).option("multiLine", True).json(path))


def metrics_from(report: DataFrame) -> DataFrame:
    """Rows from the map of field metrics of an evaluation report."""
    return report.select(F.explode("field_metrics").alias("field_key", "m")).select(
        "field_key", *[F.coalesce(f"m.{f.name}", F.lit(0).cast(f.dataType)).alias(f.name) for f in S.METRIC.fields]
    )


def field_metrics(spark: SparkSession, path: str) -> DataFrame:
    return metrics_from(spark.read.schema(S.EVAL_REPORT).option("multiLine", True).json(path))


def gap_items(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a written gap report, in the form the worklists take."""
    report = spark.read.schema(S.GAP_REPORT).option("multiLine", True).json(path)
    parts = ("train_gap", "val_gap", "train_source_gap", "val_source_gap")
    return report.select(F.explode("priorities").alias("p")).select(
        "p.field_group", "p.priority_score", "p.recommendations",
        *[F.coalesce(F.try_element_at("p.score_breakdown", F.lit(c)), F.lit(0.0)).alias(c) for c in parts],
        F.col("p.recognizer_profile.training_readiness.status").alias("training_readiness_status"),
        F.col("p.recognizer_profile.training_readiness.blocking_warnings").alias("blocking_warnings"),
    )


def inventory_of(paths: DataFrame, suffixes: tuple[str, ...] = K.DOCUMENT_SUFFIXES) -> DataFrame:
    """Name, group (parent folder) and split (grandparent folder) of the paths with a known suffix."""
    path = F.col("path")
    name = _folder(path, 0)
    suffix = F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))
    parts = F.split(path, "/")
    parent = F.when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(-2)))
    grandparent = F.when(F.size(parts) >= 3, F.try_element_at(parts, F.lit(-3)))
    return paths.filter(suffix.isin(*suffixes)).select(
        *paths.columns, name.alias("filename"), suffix.alias("suffix"), nonempty(parent).alias("document_group"),
        nonempty(grandparent).alias("split"),
    )


def inventory(spark: SparkSession, root: str, suffixes: tuple[str, ...] = K.DOCUMENT_SUFFIXES) -> DataFrame:
    """Supported files below ``root``; only listing columns are read, never the content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(
        _plain(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modified")
    )
    return inventory_of(files, suffixes)
