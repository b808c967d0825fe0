"""Sources and sinks: the row shapes read and written."""

import uuid

from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom import schemas as S
from paperloom.operators import curate as C
from paperloom.operators import reports as R
from paperloom.session import shared_folder
from paperloom.sources import readers, writers
from workload import views as V
from workload.q_reports import _gap_sql, _gaps
from workload.query import Query


def latest_results(spark, folder):
    o = V.table(spark, folder, "orders")
    rows = o.select(
        F.concat(F.lit("case_"), "o_custkey").alias("case_id"), F.when(F.col("o_orderstatus") != "P", F.array("o_orderpriority")).alias("extracted_documents"),
        F.format_string("runs/%012d.json", "o_orderkey").alias("file_path"),
    )
    return readers.latest_results(rows).select("case_id", "file_path", F.col("extracted_documents")[0].alias("first"))


LATEST_SQL = "SELECT 'case_' || o_custkey AS case_id, 'runs/' || lpad(max(o_orderkey)::VARCHAR, 12, '0') || '.json' AS file_path, arg_max(o_orderpriority, o_orderkey) AS first FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey"


def _brands(spark, folder):
    rows = V.table(spark, folder, "lineitem").join(V.table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_suppkey").alias("s"), F.count_distinct("l_returnflag").alias("v"),
        F.round(F.avg("l_discount"), 4).alias("r"), F.count_if(F.col("l_linestatus") == "O").alias("o"),
    )


def training_profiles(spark, folder):
    """A summary object with one member per part brand, some members incomplete."""
    b = _brands(spark, folder)
    odd = F.col("n") % 2 == 1
    profile = F.from_json(F.to_json(F.struct(
        F.create_map(F.lit("train"), F.col("s")).alias("unique_source_counts"), F.when(odd, F.col("r")).alias("hard_case_train_ratio"),
        F.create_map(F.lit("train"), F.col("v")).alias("unique_hard_case_variant_counts"),
    )), S.DATA_PROFILE)
    ready = F.from_json(F.to_json(F.struct(F.when(odd, "ready").alias("status"), F.array(F.lit("no_val_samples")).alias("blocking_warnings"))), S.READINESS)
    member = F.struct(F.col("n").alias("train_count"), F.when(odd, F.col("o")).alias("val_count"), F.lit(None).cast("bigint").alias("character_count"), profile.alias("data_profile"), ready.alias("training_readiness"))
    summary = b.agg(F.map_from_entries(F.collect_list(F.struct("p_brand", member))).alias("groups"))
    rows = readers.profiles_from(summary)
    return rows.select("field_group", "train_count", "val_count", "train_source_count", "val_source_count", "hard_case_train_ratio", "unique_hard_case_variant_count",
                       "training_readiness_status", F.array_join("blocking_warnings", ",").alias("blocking"), F.array_join("advisory_warnings", ",").alias("advisory"), "hard_case_selection_strategy", "hard_case_variant_floor_applied")


PROFILE_SQL = """WITH b AS (SELECT p_brand, count(*) AS n, count(DISTINCT l_suppkey) AS s, count(DISTINCT l_returnflag) AS v, round(avg(l_discount), 4) AS r, count(*) FILTER (l_linestatus = 'O') AS o FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT p_brand AS field_group, n AS train_count, CASE WHEN n % 2 = 1 THEN o ELSE 0 END AS val_count, s AS train_source_count, 0::BIGINT AS val_source_count, CASE WHEN n % 2 = 1 THEN r ELSE 0.0 END::DOUBLE AS hard_case_train_ratio, v AS unique_hard_case_variant_count,
  CASE WHEN n % 2 = 1 THEN 'ready' ELSE '' END AS training_readiness_status, 'no_val_samples' AS blocking, '' AS advisory, '' AS hard_case_selection_strategy, FALSE AS hard_case_variant_floor_applied FROM b"""


def keyed_metrics(spark, folder):
    b = _brands(spark, folder)
    report = b.agg(F.map_from_entries(F.collect_list(F.struct("p_brand", F.struct(
        F.col("n").alias("comparisons"), F.col("o").alias("exact_matches"), F.when(F.col("n") % 2 == 1, F.col("r")).alias("exact_match_rate"),
        F.col("r").alias("average_character_error_rate"), F.lit(None).cast("double").alias("average_word_error_rate"),
    )))).alias("field_metrics"))
    return readers.metrics_from(report)


def inventory(spark, folder):
    p = V.table(spark, folder, "pages")
    suffix = F.get(F.array(*[F.lit(s) for s in (".PNG", ".jpg", ".txt", ".pdf", "", ".Tiff", ".gif", ".bmp")]), (F.col("page_id") % 8).cast("int"))
    return readers.inventory_of(p.select(F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.lit("/page"), suffix).alias("path")))


INVENTORY_SQL = """WITH p AS (SELECT regexp_replace(url, '[?#].*$', '') || '/page' || ['.PNG', '.jpg', '.txt', '.pdf', '', '.Tiff', '.gif', '.bmp'][1 + page_id % 8] AS path, page_id FROM pages),
s AS (SELECT path, string_split(path, '/') AS parts FROM p WHERE page_id % 8 NOT IN (2, 4, 6))
SELECT path, parts[-1] AS filename, lower(regexp_extract(parts[-1], '(\\.[^.]+)$', 1)) AS suffix, nullif(parts[-2], '') AS document_group, nullif(parts[-3], '') AS split FROM s"""


def manifest_round_trip(spark, folder):
    """The crop manifest written as JSON lines by field group and split, and read again."""
    root = f"{shared_folder(spark)}/paperloom-manifest-{uuid.uuid4().hex}"
    writers.write_manifest(V.crops(spark, folder), root)
    rows = readers.manifest(spark, root)
    return rows.select("case_id", "document_type", "field_name", "field_group", "split", "text", "source_path", "crop_path", F.col("quality.accepted").alias("accepted"))


def manifest_folders(spark, folder):
    """Rows by the folders that the manifest sink lays out."""
    root = f"{shared_folder(spark)}/paperloom-manifest-{uuid.uuid4().hex}"
    writers.write_manifest(V.crops(spark, folder), root)
    parts = F.split(F.col("_metadata.file_path"), "/")
    rows = spark.read.text(root, recursiveFileLookup=True).select(F.element_at(parts, -3).alias("group_folder"), F.element_at(parts, -2).alias("split_folder"))
    return rows.groupBy("group_folder", "split_folder").agg(F.count(F.lit(1)).alias("rows"))


def label_lines(spark, folder):
    return writers.label_lines(V.crops(spark, folder).withColumn("crop_path", F.concat(F.lit("out/"), "crop_path")), "out")


def dictionary(spark, folder):
    return C.char_dictionary(V.table(spark, folder, "documents").select(F.col("lang").alias("field_group"), "text"))


def newest_batch(spark, folder):
    o = V.table(spark, folder, "orders")
    cases = o.select(F.concat(F.lit("case_"), "o_custkey").alias("case_id"), F.col("o_orderstatus").alias("status"), (F.col("o_orderkey") % 50).alias("batch"))
    documents = o.select(F.concat(F.lit("case_"), "o_custkey").alias("case_id"), F.col("o_orderpriority").alias("document"), (F.col("o_orderkey") % 50).alias("batch"))
    current, papers = writers.newest_batch(cases, documents)
    return current.select("case_id", "batch", F.col("status").alias("value")).unionByName(papers.select("case_id", "batch", F.col("document").alias("value")))


BATCH_SQL = """WITH b AS (SELECT *, o_orderkey % 50 AS batch FROM orders), k AS (SELECT *, max(batch) OVER (PARTITION BY o_custkey) AS top FROM b)
SELECT 'case_' || o_custkey AS case_id, batch, o_orderstatus AS value FROM k WHERE batch = top UNION ALL SELECT 'case_' || o_custkey, batch, o_orderpriority FROM k WHERE batch = top"""


def report_json(spark, folder):
    gaps = _gaps(spark, folder).select("field_group", "priority_score", "recommendations")
    text = writers.report_json(gaps, "priorities", {"min_base_train_count": K.MIN_TRAIN})
    parsed = F.from_json("value", "min_base_train_count int, priorities array<struct<field_group:string,priority_score:double,recommendations:array<string>>>")
    return text.select(parsed.alias("r")).select("r.min_base_train_count", F.explode("r.priorities").alias("p")).select("min_base_train_count", "p.field_group", "p.priority_score", F.array_join("p.recommendations", ",").alias("recommendations"))


def absent_scaffolds(spark, folder):
    o = V.table(spark, folder, "orders")
    new = o.select(F.col("o_custkey").alias("case_id"), F.col("o_orderpriority").alias("document_type"), "o_orderkey")
    existing = o.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("case_id"), F.col("o_orderpriority").alias("document_type"))
    return R.without_existing(new, existing, ["case_id", "document_type"])


QUERIES = [
    Query("S3_latest_results", latest_results, LATEST_SQL),
    Query("S4_manifest", manifest_round_trip, V.plain(V.with_views(("crops_v",)) + "SELECT case_id, document_type, field_name, field_group, split, text, source_path, crop_path, accepted FROM crops_v")),
    Query("K1_manifest_folders", manifest_folders, V.plain(V.with_views(("crops_v",)) + "SELECT 'group_folder=' || field_group AS group_folder, 'split_folder=' || split AS split_folder, count(*) AS rows FROM crops_v GROUP BY ALL")),
    Query("S5_training_profiles", training_profiles, PROFILE_SQL),
    Query("S5_keyed_metrics", keyed_metrics, PROFILE_SQL.split("\nSELECT")[0] + """ SELECT p_brand AS field_key, n AS comparisons, o AS exact_matches, CASE WHEN n % 2 = 1 THEN r ELSE 0.0 END::DOUBLE AS exact_match_rate,
        r AS average_character_error_rate, 0.0::DOUBLE AS average_word_error_rate FROM b"""),
    Query("S6_inventory", inventory, INVENTORY_SQL),
    Query("K2_label_lines", label_lines, V.plain(V.with_views(("crops_v",)) + "SELECT field_group, split, crop_path || chr(9) || text AS value FROM crops_v")),
    Query("K3_dictionary", dictionary, "SELECT DISTINCT lang AS field_group, c AS character FROM (SELECT lang, unnest(string_split(text, '')) AS c FROM documents) WHERE c <> ''"),
    Query("K4_newest_batch", newest_batch, BATCH_SQL),
    Query("K5_report_json", report_json, _gap_sql("SELECT 12 AS min_base_train_count, field_group, priority_score, recs AS recommendations FROM scored")),
    Query("K6_absent_scaffolds", absent_scaffolds, """SELECT o_custkey AS case_id, o_orderpriority AS document_type, o_orderkey FROM orders o WHERE NOT EXISTS
        (SELECT 1 FROM orders x WHERE x.o_orderstatus = 'F' AND x.o_custkey = o.o_custkey AND x.o_orderpriority = o.o_orderpriority)"""),
]
