"""Gap, coverage and priority reports."""

from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.operators import reports as R
from paperloom.operators import review
from paperloom.plans.training import gap_report
from workload import q_review
from workload import views as V
from workload.q_evaluate import COMPARE, _report
from workload.query import Query


def _v(names, select):
    return V.plain(V.with_views(names) + select)


def counts(spark, folder):
    crops = V.crops(spark, folder).withColumn("document_type", F.when(F.col("field_name") != "tin", F.col("document_type")).otherwise(""))
    rows = R.counts_by(crops, "document_type").withColumnRenamed("rows", "n").withColumn("what", F.lit("rows"))
    sources = R.unique_sources_by(crops, "document_type").withColumnRenamed("sources", "n").withColumn("what", F.lit("sources"))
    return rows.unionByName(sources)


COUNT_SQL = _v(("crops_v",), """SELECT document_type, 'rows' AS what, count(*) AS n FROM (SELECT CASE WHEN field_name = 'tin' THEN 'unknown' ELSE document_type END AS document_type, source_path FROM crops_v) GROUP BY ALL
  UNION ALL SELECT document_type, 'sources', count(DISTINCT source_path) FROM (SELECT CASE WHEN field_name = 'tin' THEN 'unknown' ELSE document_type END AS document_type, source_path FROM crops_v) GROUP BY ALL""")


def accuracy(spark, folder):
    return R.group_accuracy(_report(spark, folder, "b").field_metrics)


ACCURACY_SQL = "SELECT key AS field_group, comparisons, round(rate, 4) AS exact_match_rate, round(cer, 4) AS average_character_error_rate, round(wer, 4) AS average_word_error_rate FROM lev WHERE run = 'b' AND level = 'field_group'"

# a manifest with gaps, made by renaming: no val crops and no apostilles among dates, most of two groups under a third
GAPPY_CHECK = """gappy AS (SELECT * REPLACE (CASE WHEN field_group = 'date' THEN 'train' ELSE split END AS split,
   CASE WHEN field_group = 'date' AND document_type = 'apostille' THEN 'residency_certificate' ELSE document_type END AS document_type,
   CASE WHEN field_group = 'korean_mixed_form' AND (document_type <> 'apostille' OR quantity <> 7 OR contains(text, 'o')) THEN 'english_name_org'
        WHEN field_group = 'numeric_tin_code' AND source_path <> 'src_7.png' AND source_path <> 'src_10.png' THEN 'english_name_org' ELSE field_group END AS field_group) FROM crops_v)"""


def _gappy(spark, folder):
    rows = V.view(spark, folder, "crops_v")
    g, t = F.col("field_group"), F.col("document_type")
    moved = ((g == K.DEFAULT_GROUP) & ((t != K.APOSTILLE) | (F.col("quantity") != 7) | F.col("text").contains("o"))) | (
        (g == K.NUMERIC_GROUP) & ~F.col("source_path").isin("src_7.png", "src_10.png"))
    renamed = rows.select("*", F.when(g == K.DATE_GROUP, "train").otherwise(F.col("split")).alias("new_split"),
                          F.when((g == K.DATE_GROUP) & (t == K.APOSTILLE), K.RESIDENCY).otherwise(t).alias("new_type"),
                          F.when(moved, K.ENGLISH_GROUP).otherwise(g).alias("new_group")).drop("split", "document_type", "field_group")
    renamed = renamed.withColumnsRenamed({"new_split": "split", "new_type": "document_type", "new_group": "field_group"})
    return renamed.withColumn("quality", V._quality())


GAP_BODY = GAPPY_CHECK + """,
ok AS (SELECT * FROM gappy WHERE accepted), ty AS (SELECT DISTINCT document_type FROM ok), gr AS (SELECT DISTINCT field_group FROM gappy),
mt AS (SELECT gr.field_group, sp.split, ty.document_type FROM gr, ty, (VALUES ('train'), ('val')) sp(split) WHERE NOT EXISTS (SELECT 1 FROM ok WHERE ok.field_group = gr.field_group AND ok.split = sp.split AND ok.document_type = ty.document_type)),
b AS (SELECT gr.field_group, (SELECT count(*) FROM ok WHERE field_group = gr.field_group AND split = 'train') AS tc, (SELECT count(*) FROM ok WHERE field_group = gr.field_group AND split = 'val') AS vc,
  (SELECT count(DISTINCT document_type || source_path) FROM ok WHERE field_group = gr.field_group AND split = 'train') AS tsrc, (SELECT count(DISTINCT document_type || source_path) FROM ok WHERE field_group = gr.field_group AND split = 'val') AS vsrc,
  (SELECT count(*) FROM gappy WHERE field_group = gr.field_group AND NOT accepted) AS rej, (SELECT count(*) FROM mt WHERE field_group = gr.field_group AND split = 'train') AS mtr, (SELECT count(*) FROM mt WHERE field_group = gr.field_group AND split = 'val') AS mva FROM gr),
acc AS (SELECT key AS field_group, round(rate, 4) AS rate, round(cer, 4) AS cer, round(wer, 4) AS wer FROM lev WHERE run = 'b' AND level = 'field_group'),
gap AS (SELECT b.*, 3.0 * greatest(0, 12 - tc) AS train_gap, 2.0 * greatest(0, 3 - vc) AS val_gap, 2.5 * greatest(0, 3 - tsrc) AS train_source_gap, 2.0 * greatest(0, 2 - vsrc) AS val_source_gap, mtr + 0.5 * mva AS document_gap, 0.25 * rej AS rejected_gap,
  coalesce((1 - rate) * 10 + cer * 5 + wer * 2, 0) AS accuracy_gap, rate, cer FROM b LEFT JOIN acc USING (field_group)),
scored AS (SELECT *, round((train_gap + val_gap + train_source_gap + val_source_gap + document_gap + rejected_gap + accuracy_gap)::DOUBLE, 4) AS priority_score,
  concat_ws(',', CASE WHEN train_gap > 0 THEN 'collect_base_train_samples' END, CASE WHEN val_gap > 0 THEN 'collect_base_val_samples' END, CASE WHEN mtr > 0 THEN 'expand_train_document_coverage' END,
   CASE WHEN mva > 0 THEN 'expand_val_document_coverage' END, CASE WHEN train_source_gap > 0 THEN 'collect_distinct_train_sources' END, CASE WHEN val_source_gap > 0 THEN 'collect_distinct_val_sources' END,
   CASE WHEN rej > 0 THEN 'review_rejected_field_crops' END, CASE WHEN rate < 0.9 OR cer > 0.05 THEN 'prioritize_low_accuracy_group' END) AS recs FROM gap),
ranked AS (SELECT *, row_number() OVER (ORDER BY priority_score DESC, tc, field_group) AS rank FROM scored)
"""


def _gap_sql(select):
    return V.plain(V.with_views(("people_v", "actual_v", "crops_v", "docs_v", "coverage_v"), COMPARE.strip() + ",\n" + GAP_BODY) + select)


def _gaps(spark, folder):
    return gap_report(_gappy(spark, folder), None, _report(spark, folder, "b").field_metrics)


def missing_types(spark, folder):
    rows = R.missing_types(R.crop_counts(_gappy(spark, folder)))
    return rows.select("field_group", F.array_join("missing_train_types", ",").alias("train"), F.array_join("missing_val_types", ",").alias("val"))


def gap_scores(spark, folder):
    parts = ("train_gap", "val_gap", "train_source_gap", "val_source_gap", "document_gap", "rejected_gap", "accuracy_gap")
    return _gaps(spark, folder).select("field_group", "base_train_count", "base_val_count", "base_train_source_count", "base_val_source_count", "rejected_count", *[F.round(p, 4).alias(p) for p in parts], "priority_score")


def gap_recommendations(spark, folder):
    return _gaps(spark, folder).select("field_group", F.array_join("recommendations", ",").alias("recommendations"))


def gap_ranks(spark, folder):
    return _gaps(spark, folder).select("field_group", F.col("rank").cast("bigint").alias("rank"))


def _stored_gaps(spark, folder):
    """The gap report as read back by the worklists."""
    from paperloom.session import cut_lineage

    return cut_lineage(_gaps(spark, folder))


def rejected_groups(spark, folder):
    groups, _ = R.rejected_report(_gappy(spark, folder), _gaps(spark, folder))
    shown = lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return groups.select("field_group", "priority_score", "rejected_count", shown("counts_by_document_type").alias("types"), shown("quality_flag_counts").alias("flags"), F.col("rank").cast("bigint").alias("rank"))


REJECTED_SQL = """, rj AS (SELECT * FROM gappy WHERE NOT accepted), rg AS (SELECT field_group, count(*) AS rejected_count FROM rj GROUP BY ALL),
tt AS (SELECT field_group, string_agg(document_type || '=' || n, ',' ORDER BY document_type) AS types FROM (SELECT field_group, document_type, count(*) AS n FROM rj GROUP BY ALL) GROUP BY ALL),
ff AS (SELECT field_group, string_agg(flag || '=' || n, ',' ORDER BY flag) AS flags FROM (SELECT field_group, flag, count(*) AS n FROM rj GROUP BY ALL) GROUP BY ALL)
SELECT field_group, priority_score, rejected_count, types, flags, row_number() OVER (ORDER BY priority_score DESC, rejected_count DESC, field_group) AS rank FROM rg JOIN tt USING (field_group) JOIN ff USING (field_group) JOIN scored USING (field_group)"""


def rejected_entries(spark, folder):
    _, entries = R.rejected_report(V.crops(spark, folder))
    return entries.select("field_group", "document_type", "case_id", "field_name", "split", "crop_path", "source_path",
                          F.array_join("quality_flags", ",").alias("flags"), F.array_join("review_actions", ",").alias("actions"))


ENTRY_SQL = _v(("crops_v",), """SELECT field_group, document_type, case_id, field_name, split, crop_path, source_path, flag AS flags, CASE flag WHEN 'dense_edge_content' THEN 'inspect_seal_or_noise_overlap'
  WHEN 'low_contrast' THEN 'check_blank_or_faint_text_crop' ELSE 'review_region_box_size' END AS actions FROM crops_v WHERE NOT accepted""")


def _coverage_inputs(spark, folder):
    c = V.view(spark, folder, "coverage_v")
    files = c.select(F.col("sample_path").alias("path"))
    case = F.concat(F.lit("case_"), F.col("doc_id"))
    reviewed = c.filter("labelled").select(F.col("sample_path").alias("source_path"), case.alias("case_id"), "document_type", F.lit(False).alias("pending"))
    second = c.filter("labelled AND doc_id % 5 = 0").select(F.col("sample_path").alias("source_path"), F.concat(case, F.lit("_b")).alias("case_id"), F.lit(K.APOSTILLE).alias("document_type"), F.lit(False).alias("pending"))
    waiting = c.filter("pending").select(F.col("sample_path").alias("source_path"), case.alias("case_id"), "document_type", F.lit(True).alias("pending"))
    labels = reviewed.unionByName(second).unionByName(waiting)
    fields = F.when(F.col("document_type") == K.APOSTILLE, F.create_map(F.lit("issued_on"), F.lit("x"), F.lit("signed_by"), F.lit("y"))).when(
        F.col("document_type") == K.RESIDENCY, F.create_map(F.lit("tin"), F.lit("1"), F.lit("issue_date"), F.lit("x"))).otherwise(F.create_map(F.lit("remarks"), F.lit("z"), F.lit("tin"), F.lit("1")))
    labels = labels.withColumn("expected_fields", fields)
    expected = c.filter("evaluated").select(case.alias("case_id"))
    samples = c.filter("doc_id % 3 <> 2 OR split IS NULL").select(F.col("sample_path").alias("source"), "document_type", F.concat(F.lit("sample_"), F.col("doc_id")).alias("case_id"), "split")
    return files, labels, expected, samples


def coverage(spark, folder):
    covered = R.coverage(*_coverage_inputs(spark, folder))
    return covered.select("sample_path", "covered_by_labeled", "pending_review", "covered_by_eval", "label_cases", "pending_cases", "eval_cases",
                          F.array_join("document_types", ",").alias("document_types"), "known_to_sample_dataset", "sample_dataset_document_type", "sample_dataset_case_id", "sample_dataset_split")


COVER_BODY = """, cov AS (SELECT *, doc_id % 3 <> 2 OR split IS NULL AS listed FROM coverage_v)"""
COVER_SQL = _v(("coverage_v",), """SELECT sample_path, labelled AS covered_by_labeled, pending AS pending_review, evaluated AS covered_by_eval, CASE WHEN labelled THEN CASE WHEN doc_id % 5 = 0 THEN 2 ELSE 1 END ELSE 0 END::BIGINT AS label_cases,
  pending::INT::BIGINT AS pending_cases, evaluated::INT::BIGINT AS eval_cases, CASE WHEN NOT labelled THEN '' WHEN doc_id % 5 = 0 AND document_type <> 'apostille' THEN 'apostille,' || document_type ELSE document_type END AS document_types,
  doc_id % 3 <> 2 OR split IS NULL AS known_to_sample_dataset, CASE WHEN doc_id % 3 <> 2 OR split IS NULL THEN document_type END AS sample_dataset_document_type,
  CASE WHEN doc_id % 3 <> 2 OR split IS NULL THEN 'sample_' || doc_id END AS sample_dataset_case_id, CASE WHEN doc_id % 3 <> 2 OR split IS NULL THEN split END AS sample_dataset_split FROM coverage_v""")


def coverage_links(spark, folder):
    _, labels, expected, _ = _coverage_inputs(spark, folder)
    return R.coverage_links(labels, expected)


LINK_SQL = _v(("coverage_v",), """SELECT sample_path AS sample_key, CASE WHEN labelled THEN 'label' ELSE 'pending' END AS kind, 'case_' || doc_id AS case_id, document_type FROM coverage_v WHERE labelled OR pending
  UNION ALL SELECT sample_path, 'label', 'case_' || doc_id || '_b', 'apostille' FROM coverage_v WHERE labelled AND doc_id % 5 = 0
  UNION ALL SELECT sample_path, 'eval', 'case_' || doc_id, document_type FROM coverage_v WHERE evaluated""")


def coverage_totals(spark, folder):
    return R.coverage_totals(R.coverage(*_coverage_inputs(spark, folder)))


def labels_without_eval(spark, folder):
    _, labels, expected, _ = _coverage_inputs(spark, folder)
    return R.labels_without_eval(labels, expected)


def type_groups(spark, folder):
    return R.type_groups(_coverage_inputs(spark, folder)[1])


TYPE_GROUPS = """(VALUES ('apostille', 'date'), ('apostille', 'english_name_org'), ('residency_certificate', 'date'), ('residency_certificate', 'numeric_tin_code'), ('withholding_tax_form', 'korean_mixed_form'), ('withholding_tax_form', 'numeric_tin_code')) tg(document_type, field_group)"""


def _blocked(gaps):
    """Readiness of the gap report's groups: the date group has no val samples."""
    stuck = F.col("field_group") == K.DATE_GROUP
    return gaps.withColumns({
        "training_readiness_status": F.when(stuck, "blocked").otherwise("ready"),
        "blocking_warnings": F.when(stuck, F.array(F.lit("no_val_samples"))).otherwise(F.array().cast("array<string>")),
    })


def sample_priority(spark, folder):
    files, labels, expected, samples = _coverage_inputs(spark, folder)
    rows = R.sample_priority(R.coverage(files, labels, expected, samples), _blocked(_stored_gaps(spark, folder)), R.type_groups(labels))
    return R.ranked_samples(rows).select(
        "rank", "sample_path", "case_id", "document_type", "status", F.array_join("matched_field_groups", ",").alias("groups"), F.array_join("blocked_field_groups", ",").alias("blocked"),
        "gap_score", "blocked_boost", "split_gap_boost", "blocking_split_boost", "queue_ready_boost", "priority_score", F.array_join("recommendations", ",").alias("recommendations"),
    )


SAMPLE_SQL = """, open_s AS (SELECT doc_id, sample_path, pending, CASE WHEN doc_id % 3 <> 2 OR split IS NULL THEN document_type END AS dt, CASE WHEN doc_id % 3 <> 2 OR split IS NULL THEN split END AS sp, CASE WHEN doc_id % 3 <> 2 OR split IS NULL THEN 'sample_' || doc_id END AS case_id FROM coverage_v WHERE NOT labelled),
m AS (SELECT o.doc_id, s.field_group, s.priority_score, s.recs, s.field_group = 'date' AS bl, CASE o.sp WHEN 'train' THEN train_gap + train_source_gap WHEN 'val' THEN val_gap + val_source_gap ELSE 0 END AS sg, CASE WHEN o.sp = 'val' AND s.field_group = 'date' THEN 5.0 ELSE 0.0 END AS sb
  FROM open_s o JOIN """ + TYPE_GROUPS + """ ON tg.document_type = o.dt JOIN scored s ON s.field_group = tg.field_group),
a AS (SELECT doc_id, round(sum(priority_score), 4) AS gap_score, 5.0 * count(*) FILTER (bl) AS blocked_boost, round(sum(sg)::DOUBLE, 4) AS split_gap_boost, sum(sb) AS blocking_split_boost, string_agg(field_group, ',' ORDER BY priority_score DESC, field_group) AS groups,
   string_agg(field_group, ',' ORDER BY priority_score DESC, field_group) FILTER (bl) AS blocked, list(string_split(recs, ',') ORDER BY priority_score DESC, field_group) AS rl FROM m GROUP BY doc_id),
r AS (SELECT doc_id, string_agg(x, ',' ORDER BY p) AS merged FROM (SELECT doc_id, x, min(p) AS p FROM (SELECT doc_id, unnest(flatten(rl)) AS x, generate_subscripts(flatten(rl), 1) AS p FROM a) WHERE x <> '' GROUP BY ALL) GROUP BY doc_id),
f AS (SELECT sample_path, case_id, dt AS document_type, CASE WHEN pending THEN 'pending_review' ELSE 'unbootstrapped' END AS status, coalesce(groups, '') AS groups, coalesce(blocked, '') AS blocked, coalesce(gap_score, 0)::DOUBLE AS gap_score, coalesce(blocked_boost, 0)::DOUBLE AS blocked_boost,
   coalesce(split_gap_boost, 0)::DOUBLE AS split_gap_boost, coalesce(blocking_split_boost, 0)::DOUBLE AS blocking_split_boost, CASE WHEN pending THEN 1.0 ELSE 0.0 END::DOUBLE AS queue_ready_boost,
   round((coalesce(gap_score, 0) + coalesce(blocked_boost, 0) + coalesce(split_gap_boost, 0) + coalesce(blocking_split_boost, 0) + CASE WHEN pending THEN 1 ELSE 0 END)::DOUBLE, 4) AS priority_score,
   concat_ws(',', CASE WHEN pending THEN 'review_pending_label' ELSE 'bootstrap_label_scaffold' END, CASE WHEN blocked <> '' THEN 'unblock_recognizer_training' END, merged) AS recommendations FROM open_s LEFT JOIN a USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT row_number() OVER (ORDER BY priority_score DESC, CASE WHEN status = 'pending_review' THEN 0 ELSE 1 END, sample_path) AS rank, * FROM f"""


def _queue(spark, folder):
    docs = V.documents(spark, folder)
    filled = docs.withColumn("fields", F.when(F.col("k") % 4 == 0, F.map_filter("fields", lambda n, _: n.isin("tin", "issue_date", "certificate_number"))).otherwise(F.col("fields")))
    cases = review.review_cases(docs).filter("queued").select("case_id", "status", F.size("findings").alias("finding_count"))
    queued = filled.join(cases.select("case_id"), "case_id", "left_semi")
    labels = docs.filter("k % 9 = 0 AND document_type = 'apostille'").select("case_id", "document_type", (F.col("k") % 2 == 1).alias("pending"))
    return cases, queued, labels


def queue_priority(spark, folder):
    cases, docs, labels = _queue(spark, folder)
    rows = R.queue_priority(cases, docs, _stored_gaps(spark, folder), labels)
    return R.ranked_queue(rows).select("rank", "case_id", "status", "gap_score", "status_boost", "findings_boost", "priority_score", F.array_join("matched_field_groups", ",").alias("groups"), F.array_join("recommendations", ",").alias("recommendations"))


def best_of_queue(spark, folder):
    """The first fifty of the queue: the report's top-k, which ranks nothing else."""
    cases, docs, labels = _queue(spark, folder)
    rows = R.ranked_queue(R.queue_priority(cases, docs, _stored_gaps(spark, folder), labels), 50)
    return rows.select("rank", "case_id", "priority_score")


# the field groups of the papers of a case
QUEUE_BODY = ", qc AS (SELECT case_id, status, finding_count FROM cases WHERE status <> 'pass' OR blurry OR low_confidence AND TRUE), " + """
qd AS (SELECT d.* FROM docs_v d JOIN qc USING (case_id)),
qg AS (SELECT DISTINCT case_id, g FROM (SELECT case_id, unnest(CASE document_type WHEN 'residency_certificate' THEN CASE WHEN k % 4 = 0 THEN ['numeric_tin_code', 'date'] ELSE ['english_name_org', 'numeric_tin_code', 'date'] END
   WHEN 'withholding_tax_form' THEN CASE WHEN k % 4 = 0 THEN ['numeric_tin_code'] ELSE ['english_name_org', 'numeric_tin_code', 'date'] END ELSE CASE WHEN k % 4 = 0 THEN ['numeric_tin_code'] ELSE ['korean_mixed_form', 'english_name_org', 'date', 'numeric_tin_code'] END END) AS g FROM qd)),
qa AS (SELECT case_id, round(sum(priority_score), 4) AS gap_score, string_agg(g, ',' ORDER BY priority_score DESC, g) AS groups, list(string_split(recs, ',') ORDER BY priority_score DESC, g) AS rl FROM qg JOIN scored ON field_group = g GROUP BY case_id),
qr AS (SELECT case_id, string_agg(x, ',' ORDER BY p) AS merged FROM (SELECT case_id, x, min(p) AS p FROM (SELECT case_id, unnest(flatten(rl)) AS x, generate_subscripts(flatten(rl), 1) AS p FROM qa) WHERE x <> '' GROUP BY ALL) GROUP BY case_id),
qf AS (SELECT qc.case_id, status, gap_score, CASE WHEN status = 'reject' THEN 2.0 ELSE 0.0 END::DOUBLE AS status_boost, (least(finding_count, 5) * 0.5)::DOUBLE AS findings_boost,
   round((gap_score + CASE WHEN status = 'reject' THEN 2.0 ELSE 0.0 END + least(finding_count, 5) * 0.5)::DOUBLE, 4) AS priority_score, groups, coalesce(merged, '') AS recommendations
   FROM qc JOIN qa USING (case_id) LEFT JOIN qr USING (case_id) WHERE qc.case_id NOT IN (SELECT case_id FROM qd WHERE k % 9 = 0 AND k % 2 = 0 AND document_type = 'apostille')),
qrank AS (SELECT row_number() OVER (ORDER BY priority_score DESC, case_id) AS rank, * FROM qf)
"""


def _queue_sql(select):
    review_body = q_review.REVIEW.replace("{docs}", "docs_v").replace("{rules}", q_review._all_rows("last_v")).strip()
    return V.plain(V.with_views(("people_v", "actual_v", "crops_v", "docs_v", "coverage_v"), COMPARE.strip() + ",\n" + GAP_BODY.strip() + ",\n" + review_body) + QUEUE_BODY.replace(" AND TRUE", "") + select)


def merged_recommendations(spark, folder):
    """Recommendation lists of the nations' groups, merged per region in order of need."""
    n = V.table(spark, folder, "nation")
    s = V.table(spark, folder, "supplier").groupBy("s_nationkey").agg(F.round(F.sum("s_acctbal"), 2).alias("priority_score"))
    matched = n.join(s, F.col("n_nationkey") == F.col("s_nationkey")).select(
        "n_regionkey", F.col("n_name").alias("field_group"), "priority_score",
        F.array(F.concat(F.lit("visit_"), F.substring("n_name", 1, 1)), F.concat(F.lit("call_"), (F.col("n_nationkey") % 3).cast("string"))).alias("recommendations"),
    )
    rows = R.merge_recommendations(matched, ["n_regionkey"])
    return rows.select("n_regionkey", F.array_join("recommendations", ",").alias("recommendations"))


MERGE_SQL = """WITH s AS (SELECT s_nationkey, round(sum(s_acctbal), 2) AS p FROM supplier GROUP BY ALL),
l AS (SELECT n_regionkey, list(['visit_' || substr(n_name, 1, 1), 'call_' || (n_nationkey % 3)] ORDER BY p DESC, n_name) AS rl FROM nation JOIN s ON n_nationkey = s_nationkey GROUP BY ALL)
SELECT n_regionkey, string_agg(x, ',' ORDER BY p) AS recommendations FROM (SELECT n_regionkey, x, min(p) AS p FROM (SELECT n_regionkey, unnest(flatten(rl)) AS x, generate_subscripts(flatten(rl), 1) AS p FROM l) GROUP BY ALL) GROUP BY n_regionkey"""


def promoted(spark, folder):
    cases, docs, labels = _queue(spark, folder)
    ranking = R.ranked_queue(R.queue_priority(cases, docs, _stored_gaps(spark, folder), labels))
    existing = docs.filter("k % 5 = 0 AND document_type = 'withholding_tax_form'").select("case_id", "document_type").distinct()
    rows = R.promote(cases, docs, existing, ranking, limit=50)
    return rows.select("case_id", "document_type", "source_path", "dataset_split", "promotion_status", "expected_status", "rank", F.col("priority_context.priority_score").alias("priority_score"))


PROMOTE_SQL = """, fresh AS (SELECT * FROM qd WHERE NOT (k % 5 = 0 AND document_type = 'withholding_tax_form')),
top AS (SELECT qc.case_id, status, rank, priority_score FROM qc LEFT JOIN (SELECT case_id, rank, priority_score FROM qrank) USING (case_id) WHERE case_id IN (SELECT case_id FROM fresh) ORDER BY rank NULLS LAST, case_id LIMIT 50)
SELECT case_id, document_type, source_path, 'pending_review' AS dataset_split, 'needs_human_verification' AS promotion_status, status AS expected_status, rank, priority_score FROM fresh JOIN top USING (case_id)"""


def bootstrapped(spark, folder):
    files, labels, expected, samples = _coverage_inputs(spark, folder)
    existing = samples.filter(F.regexp_extract("case_id", r"(\d+)", 1).cast("bigint") % 4 == 0).select("case_id", "document_type")
    rows = R.bootstrap(R.coverage(files, labels, expected, samples), samples, existing)
    return rows.select("case_id", "document_type", "source_path", "dataset_split", "promotion_status", F.size("expected_fields").cast("bigint").alias("fields"), F.array_join("notes", " ").alias("notes"))


QUERIES = [
    Query("G1_counts", counts, COUNT_SQL),
    Query("G2_group_accuracy", accuracy, V.plain(V.with_views(("people_v", "actual_v"), COMPARE.strip()) + ACCURACY_SQL)),
    Query("G3_missing_types", missing_types, _gap_sql("""SELECT field_group, coalesce((SELECT string_agg(document_type, ',' ORDER BY document_type) FROM mt WHERE mt.field_group = gr.field_group AND split = 'train'), '') AS train,
        coalesce((SELECT string_agg(document_type, ',' ORDER BY document_type) FROM mt WHERE mt.field_group = gr.field_group AND split = 'val'), '') AS val FROM gr""")),
    Query("G4_gap_scores", gap_scores, _gap_sql("""SELECT field_group, tc AS base_train_count, vc AS base_val_count, tsrc AS base_train_source_count, vsrc AS base_val_source_count, rej AS rejected_count, train_gap::DOUBLE AS train_gap, val_gap::DOUBLE AS val_gap,
        train_source_gap::DOUBLE AS train_source_gap, val_source_gap::DOUBLE AS val_source_gap, document_gap::DOUBLE AS document_gap, rejected_gap::DOUBLE AS rejected_gap, round(accuracy_gap::DOUBLE, 4) AS accuracy_gap, priority_score FROM scored""")),
    Query("G5_gap_recommendations", gap_recommendations, _gap_sql("SELECT field_group, recs AS recommendations FROM scored")),
    Query("G6_gap_ranks", gap_ranks, _gap_sql("SELECT field_group, rank FROM ranked")),
    Query("G7_rejected_groups", rejected_groups, _gap_sql(REJECTED_SQL)),
    Query("G8_rejected_entries", rejected_entries, ENTRY_SQL),
    Query("G9_coverage", coverage, COVER_SQL),
    Query("G9_coverage_links", coverage_links, LINK_SQL),
    Query("G9_coverage_totals", coverage_totals, _v(("coverage_v",), """SELECT count(*) AS sample_file_count, count(*) FILTER (labelled) AS covered_by_labeled_count, count(*) FILTER (pending) AS covered_by_pending_review_count,
        count(*) FILTER (evaluated) AS covered_by_eval_count, count(*) FILTER (NOT labelled) AS uncovered_count FROM coverage_v""")),
    Query("G10_labels_without_eval", labels_without_eval, _v(("coverage_v",), "SELECT 'case_' || doc_id AS case_id FROM coverage_v WHERE labelled AND NOT evaluated UNION ALL SELECT 'case_' || doc_id || '_b' FROM coverage_v WHERE labelled AND doc_id % 5 = 0")),
    Query("G11_type_groups", type_groups, _v(("coverage_v",), "SELECT DISTINCT tg.document_type, field_group FROM " + TYPE_GROUPS + " JOIN coverage_v c ON c.document_type = tg.document_type AND labelled")),
    Query("G12_sample_priority", sample_priority, _gap_sql(SAMPLE_SQL)),
    Query("G13_queue_priority", queue_priority, _queue_sql("SELECT rank, case_id, status, gap_score, status_boost, findings_boost, priority_score, groups, recommendations FROM qrank")),
    Query("G13_queue_top", best_of_queue, _queue_sql("SELECT rank, case_id, priority_score FROM qrank WHERE rank <= 50")),
    Query("G14_merged_recommendations", merged_recommendations, MERGE_SQL),
    Query("G15_promoted", promoted, _queue_sql(PROMOTE_SQL)),
    Query("G16_bootstrapped", bootstrapped, _v(("coverage_v",), f"""SELECT 'sample_' || doc_id AS case_id, document_type, sample_path AS source_path, 'pending_review' AS dataset_split, 'needs_human_verification' AS promotion_status, 0::BIGINT AS fields,
        '{" ".join(K.SCAFFOLD_NOTES)}' AS notes FROM coverage_v WHERE NOT labelled AND (doc_id % 3 <> 2 OR split IS NULL) AND doc_id % 4 <> 0""")),
]
