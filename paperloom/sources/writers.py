"""Sinks.  Every one is a distributed write; nothing that grows with the data is gathered."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.curate import char_dictionary
from paperloom.operators.reports import without_existing


def write_manifest(df: DataFrame, root: str, mode: str = "overwrite", compression: str = "gzip") -> None:
    """JSON lines, foldered by field group and split; both stay inside the rows as well.

    Every row repeats the names of its members, so the files are compressed; Spark reads them like plain ones.
    """
    df.withColumns({"group_folder": F.col("field_group"), "split_folder": F.col("split")}).write.mode(mode).partitionBy(
        "group_folder", "split_folder"
    ).json(root, compression=compression)


def label_lines(df: DataFrame, image_root: str = "") -> DataFrame:
    """``relative image<TAB>text`` lines with their field group and split."""
    prefix = image_root.rstrip("/") + "/" if image_root else ""
    image = F.when(F.col("crop_path").startswith(prefix), F.expr(f"substring(crop_path, {len(prefix) + 1})")).otherwise(
        F.col("crop_path")
    )
    return df.select("field_group", "split", F.concat(image, F.lit("\t"), "text").alias("value"))


def write_label_file(df: DataFrame, root: str, image_root: str = "", mode: str = "overwrite") -> None:
    label_lines(df, image_root).write.mode(mode).partitionBy("field_group", "split").text(root)


def write_dictionary(df: DataFrame, root: str, mode: str = "overwrite") -> None:
    """One character per line and field group, sorted."""
    letters = char_dictionary(df).withColumnRenamed("character", "value")
    letters.repartition("field_group").sortWithinPartitions("field_group", "value").write.mode(mode).partitionBy(
        "field_group"
    ).text(root)


QUEUE_PARTS = ("cases", "documents")


def write_queue(cases: DataFrame, documents: DataFrame, root: str, batch: str) -> None:
    """Append one batch of queued cases and their papers.

    A batch has its own folder and replaces only itself, so a retried batch does not duplicate
    rows.  Readers take the newest batch of each case (:func:`read_queue`).
    """
    for part, rows in zip(QUEUE_PARTS, (cases, documents)):
        rows.write.mode("overwrite").parquet(f"{root}/{part}/batch={batch}")


def _folders(spark: SparkSession, root: str) -> list[str]:
    """Names of a table's batches and compacted tables, those alone whose write has ended."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path) if status.isDirectory()]
    return sorted(n for n in names if files.exists(jvm.org.apache.hadoop.fs.Path(f"{root}/{n}/_SUCCESS")))


def _layout(spark: SparkSession, root: str) -> tuple[str | None, list[str]]:
    """The newest compacted table that both parts have, and the batches after it."""
    found = [set(_folders(spark, f"{root}/{part}")) for part in QUEUE_PARTS]
    whole = sorted(found[0] & found[1])
    compacted = [n.removeprefix("compacted=") for n in whole if n.startswith("compacted=")]
    base = max(compacted, default=None)
    return base, [n.removeprefix("batch=") for n in whole if n.startswith("batch=") and (base is None or n.removeprefix("batch=") > base)]


def _part(spark: SparkSession, root: str, part: str, base: str | None, batches: list[str]) -> DataFrame | None:
    tables = [] if base is None else [spark.read.parquet(f"{root}/{part}/compacted={base}")]
    if batches:
        named = spark.read.option("basePath", f"{root}/{part}").parquet(*[f"{root}/{part}/batch={b}" for b in batches])
        tables.append(named.withColumn("batch", F.lpad(F.col("batch").cast("string"), len(batches[-1]), "0")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables) if tables else None


def read_queue(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(cases, documents) with the newest batch of each case only: the compacted table merged with later batches."""
    base, batches = _layout(spark, root)
    return newest_batch(*(_part(spark, root, part, base, batches) for part in QUEUE_PARTS))


def compact_queue(spark: SparkSession, root: str) -> str | None:
    """Write the newest batch of each case as one table and delete the batches that it replaces.

    Both parts are written before anything goes, and readers take a compacted table only once both are
    whole, so a run that is lost half-way leaves the queue as it was and can be repeated.  Batches that
    come meanwhile have later names and stay.  Gives the name of the last batch inside, None for no batch.
    """
    base, batches = _layout(spark, root)
    if not batches:
        return base
    last = batches[-1]
    for part, rows in zip(QUEUE_PARTS, read_queue(spark, root)):
        rows.write.mode("overwrite").parquet(f"{root}/{part}/compacted={last}")
    jvm = spark._jvm
    for part in QUEUE_PARTS:
        gone = [f"batch={b}" for b in batches] + ([] if base is None else [f"compacted={base}"])
        for name in gone:
            path = jvm.org.apache.hadoop.fs.Path(f"{root}/{part}/{name}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return last


def newest_batch(cases: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the newest batch of each case: a later write of a case replaces the earlier one."""
    newest = cases.groupBy("case_id").agg(F.max("batch").alias("batch"))
    current = cases.join(newest, ["case_id", "batch"], "left_semi")
    return current, documents.join(newest, ["case_id", "batch"], "left_semi")


def report_json(rows: DataFrame, name: str, header: dict[str, object] | None = None) -> DataFrame:
    """A bounded report (one row per field group or field) as one pretty JSON text."""
    fields = [F.array_sort(F.collect_list(F.struct(*rows.columns))).alias(name)]
    fields = [F.lit(v).alias(k) for k, v in (header or {}).items()] + fields
    gathered = rows.agg(*fields)
    return gathered.select(F.to_json(F.struct(*gathered.columns), {"pretty": "true"}).alias("value"))


def write_report(summary: DataFrame, root: str, sections: dict[str, DataFrame] | None = None, mode: str = "overwrite") -> None:
    """``summary`` as one JSON text, and each growing section as JSON lines beside it."""
    summary.coalesce(1).write.mode(mode).text(f"{root}/summary")
    for name, rows in (sections or {}).items():
        rows.write.mode(mode).json(f"{root}/{name}")


def write_scaffolds(new: DataFrame, root: str, overwrite: bool = False) -> None:
    """Append label scaffolds whose (case, type) is not there yet.

    With ``overwrite`` every scaffold is written and :func:`read_scaffolds` prefers the newest.
    """
    spark = new.sparkSession
    try:
        existing = spark.read.parquet(root).select("case_id", "document_type").distinct()
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing) and "UNABLE_TO_INFER_SCHEMA" not in str(missing):
            raise
        existing = spark.createDataFrame([], "case_id string, document_type string")
    rows = without_existing(new, existing, ["case_id", "document_type"], overwrite)
    rows.withColumn("written", F.current_timestamp()).write.mode("append").parquet(root)


def read_scaffolds(spark: SparkSession, root: str) -> DataFrame:
    rows = spark.read.parquet(root)
    payload = F.struct(*[c for c in rows.columns if c not in ("case_id", "document_type")])
    return rows.groupBy("case_id", "document_type").agg(F.max_by(payload, F.col("written")).alias("row")).select(
        "case_id", "document_type", "row.*"
    )
