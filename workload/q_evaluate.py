"""Evaluation and comparison."""

from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.operators import evaluate as E
from paperloom.plans.eval_report import compare_reports, field_error_report
from workload import views as V
from workload.query import Query

# one comparison row per expected field, both runs; words of a pair become single characters
COMPARE = """
cmp AS (
  SELECT r.run, e.case_id, e.document_type, e.field_name, e.expected, a.actual,
         e.expected IS NOT DISTINCT FROM a.actual AS exact_match,
         CASE WHEN length(e.expected) = 0 THEN CASE WHEN coalesce(a.actual, '') = '' THEN 0.0 ELSE 1.0 END
              ELSE levenshtein(e.expected, coalesce(a.actual, ''))::DOUBLE / length(e.expected) END AS cer,
         string_split(e.expected, ' ') AS ew, string_split(coalesce(a.actual, ''), ' ') AS aw
  FROM expected_v e
  JOIN (SELECT DISTINCT run, case_id FROM actual_v) r USING (case_id)
  LEFT JOIN actual_v a ON a.run = r.run AND a.case_id = e.case_id AND a.document_type = e.document_type AND a.field_name = e.field_name
),
voc AS (SELECT *, list_filter(ew, lambda w: w <> '') AS ext, list_filter(aw, lambda w: w <> '') AS act,
               list_distinct(list_concat(ew, aw)) AS vocabulary FROM cmp),
rated AS (SELECT *, levenshtein(array_to_string(list_transform(ext, lambda w: chr(33 + list_position(vocabulary, w)::INT)), ''),
                                array_to_string(list_transform(act, lambda w: chr(33 + list_position(vocabulary, w)::INT)), ''))::DOUBLE
                    / len(ext) AS wer FROM voc),
met AS (SELECT run, document_type || '.' || field_name AS field_key, document_type, field_name, count(*) AS comparisons,
               count(*) FILTER (exact_match) AS exact_matches, count(*) FILTER (exact_match)::DOUBLE / count(*) AS rate,
               avg(cer) AS cer, avg(wer) AS wer FROM rated GROUP BY ALL),
lev AS (SELECT run, 'field' AS level, field_key AS key, comparisons, exact_matches, rate, cer, wer FROM met
  UNION ALL SELECT run, 'document_type', document_type, sum(comparisons)::BIGINT, sum(exact_matches)::BIGINT,
     sum(exact_matches)::DOUBLE / sum(comparisons), sum(cer * comparisons) / sum(comparisons), sum(wer * comparisons) / sum(comparisons)
     FROM met GROUP BY run, document_type
  UNION ALL SELECT run, 'field_group', CASE field_name WHEN 'tin' THEN 'numeric_tin_code' WHEN 'issue_date' THEN 'date' ELSE 'english_name_org' END,
     sum(comparisons)::BIGINT, sum(exact_matches)::BIGINT, sum(exact_matches)::DOUBLE / sum(comparisons),
     sum(cer * comparisons) / sum(comparisons), sum(wer * comparisons) / sum(comparisons) FROM met GROUP BY ALL
  UNION ALL SELECT run, 'overall', 'overall', sum(comparisons)::BIGINT, sum(exact_matches)::BIGINT,
     sum(exact_matches)::DOUBLE / sum(comparisons), sum(cer * comparisons) / sum(comparisons), sum(wer * comparisons) / sum(comparisons)
     FROM met GROUP BY run),
del AS (SELECT coalesce(b.level, c.level) AS level, coalesce(b.key, c.key) AS key, c.comparisons - b.comparisons AS comparison_delta,
     c.rate - b.rate AS dm, c.cer - b.cer AS dc, c.wer - b.wer AS dw, b.key IS NULL AS is_new, c.key IS NULL AS is_gone
  FROM (SELECT * FROM lev WHERE run = 'b') b FULL JOIN (SELECT * FROM lev WHERE run = 'c') c ON b.level = c.level AND b.key = c.key),
sig AS (SELECT *, CASE WHEN is_new THEN 'added' WHEN is_gone THEN 'removed'
     WHEN (dm > 1e-9 OR dc < -1e-9 OR dw < -1e-9) AND (dm < -1e-9 OR dc > 1e-9 OR dw > 1e-9) THEN 'mixed'
     WHEN dm > 1e-9 OR dc < -1e-9 OR dw < -1e-9 THEN 'improved'
     WHEN dm < -1e-9 OR dc > 1e-9 OR dw > 1e-9 THEN 'regressed' ELSE 'unchanged' END AS status FROM del),
sev AS (SELECT *, status = 'regressed' AND (dm <= -0.05 OR dc >= 0.05 OR dw >= 0.1) AS severe,
     status = 'improved' AND (dm >= 0.05 OR dc <= -0.05 OR dw <= -0.1) AS notable FROM sig),
miss AS (SELECT r.run, p.case_id FROM people_v p CROSS JOIN (VALUES ('b'), ('c')) r(run)
  WHERE NOT EXISTS (SELECT 1 FROM actual_v a WHERE a.run = r.run AND a.case_id = p.case_id))
"""


def _sql(select: str) -> str:
    return V.plain(V.with_views(("people_v", "actual_v"), COMPARE.strip()) + select)


def _report(spark, folder, run):
    return field_error_report(V.expected(spark, folder), V.run_results(spark, folder, run))


def field_comparison(spark, folder):
    cmp = E.compare_fields(V.expected(spark, folder), V.run_results(spark, folder, "b"))
    return cmp.select(
        "case_id", "document_type", "field_name", "expected", "actual", "exact_match",
        F.round("character_error_rate", 6).alias("cer"), F.round("word_error_rate", 6).alias("wer"),
    )


def field_error_report_query(spark, folder):
    m = _report(spark, folder, "b").field_metrics
    return m.select("field_key", "comparisons", "exact_matches", *[F.round(c, 6).alias(c) for c in E.RATES])


def error_rates(spark, folder):
    """Error rates of every line item's part name against the next one in the same order."""
    rows = V.table(spark, folder, "lineitem").join(V.table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    pairs = rows.select(
        "l_orderkey", "l_linenumber", F.col("p_name").alias("expected"),
        F.when(F.col("l_linenumber") % 3 == 0, F.regexp_replace("p_name", "ing", "nig")).when(
            F.col("l_linenumber") % 3 == 1, F.concat(F.col("p_name"), F.lit(" x"))
        ).alias("actual"),
    )
    rated = E.compare_texts(pairs)
    return rated.groupBy("expected", "actual").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.max("character_error_rate"), 6).alias("cer"),
        F.round(F.max("word_error_rate"), 6).alias("wer"), F.count_if("exact_match").alias("exact"),
    )


ERROR_RATES_SQL = """
WITH pairs AS (SELECT p_name AS expected, CASE l_linenumber % 3 WHEN 0 THEN replace(p_name, 'ing', 'nig') WHEN 1 THEN p_name || ' x' END AS actual
  FROM lineitem JOIN part ON l_partkey = p_partkey),
g AS (SELECT expected, actual, count(*) AS rows FROM pairs GROUP BY ALL),
w AS (SELECT *, string_split(expected, ' ') AS e, CASE WHEN actual IS NULL THEN []::VARCHAR[] ELSE string_split(actual, ' ') END AS a FROM g),
v AS (SELECT *, list_distinct(list_concat(e, a)) AS voc FROM w)
SELECT expected, actual, rows, round(levenshtein(expected, coalesce(actual, ''))::DOUBLE / length(expected), 6) AS cer,
  round(levenshtein(array_to_string(list_transform(e, lambda x: chr(33 + list_position(voc, x)::INT)), ''),
        coalesce(array_to_string(list_transform(a, lambda x: chr(33 + list_position(voc, x)::INT)), ''), ''))::DOUBLE / len(e), 6) AS wer,
  CASE WHEN expected IS NOT DISTINCT FROM actual THEN rows ELSE 0 END AS exact
FROM v"""


def missing_cases(spark, folder):
    return E.missing_cases(V.expected(spark, folder), V.run_results(spark, folder, "b"))


def compared_cases(spark, folder):
    urgent = V.table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'").select(
        F.format_string("case_%08d", "o_custkey").alias("case_id")
    )
    report = field_error_report(V.expected(spark, folder), V.run_results(spark, folder, "c"), urgent)
    return report.compared_cases


def metric_rollups(spark, folder):
    m = E.by_level(_report(spark, folder, "c").field_metrics)
    return m.select("level", "key", "comparisons", "exact_matches", *[F.round(c, 6).alias(c) for c in E.RATES])


def _comparison(spark, folder):
    return compare_reports(_report(spark, folder, "b"), _report(spark, folder, "c"))


def metric_deltas(spark, folder):
    d = _comparison(spark, folder).deltas
    return d.select("level", "key", "status", "comparison_delta", *[F.round(f"{c}_delta", 6).alias(f"{c}_delta") for c in E.RATES])


def metric_severity(spark, folder):
    d = _comparison(spark, folder).deltas
    return d.select("level", "key", "status", "severe_regression", "notable_improvement")


def missing_case_diff(spark, folder):
    return _comparison(spark, folder).missing


def promotion_gate(spark, folder):
    p = _comparison(spark, folder).promotion
    return p.select("status", *[F.array_join(c, ",").alias(c) for c in p.columns if c != "status"])


PROMOTION_SQL = """, facts AS (SELECT
  (SELECT count(*) FROM miss WHERE run = 'c' AND case_id NOT IN (SELECT case_id FROM miss WHERE run = 'b')) AS fresh,
  (SELECT count(DISTINCT case_id) FROM rated WHERE run = 'b') AS before, (SELECT count(DISTINCT case_id) FROM rated WHERE run = 'c') AS after,
  (SELECT max(status) FROM sev WHERE level = 'overall') AS overall,
  (SELECT coalesce(list(key ORDER BY key), []) FROM sev WHERE level = 'field' AND severe) AS severe,
  (SELECT coalesce(list(key ORDER BY key), []) FROM sev WHERE level = 'field' AND comparison_delta < 0) AS shrunk,
  (SELECT coalesce(list(key ORDER BY key), []) FROM sev WHERE level = 'field' AND notable) AS notable,
  (SELECT count(*) FROM sev WHERE level = 'field' AND status = 'regressed') AS regressed,
  (SELECT count(*) FROM sev WHERE level = 'field' AND status = 'mixed') AS mixed,
  (SELECT count(*) FROM sev WHERE level = 'field' AND status = 'removed') AS removed),
why AS (SELECT *, list_filter([CASE WHEN fresh > 0 THEN 'new_missing_cases' END,
    CASE WHEN after < before THEN 'candidate_compared_cases_dropped' END, CASE WHEN overall = 'regressed' THEN 'overall_delta_regressed' END],
    lambda x: x IS NOT NULL) AS blocking,
  list_filter([CASE WHEN len(severe) > 0 THEN 'severe_field_regressions' END, CASE WHEN regressed > 0 THEN 'field_regressions' END,
    CASE WHEN mixed > 0 THEN 'mixed_field_deltas' END, CASE WHEN removed > 0 THEN 'removed_fields' END,
    CASE WHEN len(shrunk) > 0 AND after >= before THEN 'reduced_field_coverage' END, CASE WHEN overall = 'mixed' THEN 'overall_delta_mixed' END],
    lambda x: x IS NOT NULL) AS warning FROM facts)
SELECT CASE WHEN len(blocking) > 0 THEN 'reject' WHEN len(warning) > 0 THEN 'review' ELSE 'promote' END AS status,
  coalesce(array_to_string(blocking, ','), '') AS blocking_reasons, coalesce(array_to_string(warning, ','), '') AS warning_reasons,
  coalesce(array_to_string(severe, ','), '') AS severe_regressed_fields,
  coalesce(array_to_string(shrunk, ','), '') AS coverage_regressed_fields, coalesce(array_to_string(notable, ','), '') AS notable_improved_fields FROM why"""


def _profiles(spark, folder, run):
    """Training profiles per part brand, for two runs: counts of line items by split."""
    rows = V.table(spark, folder, "lineitem").join(V.table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    # each run lacks one brand, whose rows count under another, and draws its val rows in its own way
    gone = "Brand#3" if run == "b" else "Brand#5"
    val = F.col("l_suppkey") % 5 == 0 if run == "b" else (F.col("l_suppkey") + F.col("l_linenumber")) % 4 == 0
    group = F.when(F.col("p_brand") == gone, "Brand#1").otherwise(F.col("p_brand"))
    counts = rows.groupBy(group.alias("field_group")).agg(
        F.count_if(~val).alias("train_count"), F.count_if(val).alias("val_count"),
        F.count_distinct(F.when(~val, F.col("l_suppkey"))).alias("train_source_count"),
        F.count_distinct(F.when(val, F.col("l_suppkey"))).alias("val_source_count"),
        F.count_distinct("l_returnflag").alias("unique_hard_case_variant_count"),
        F.round(F.avg(F.when(F.col("l_tax") > 0.04, 1.0).otherwise(0.0)), 4).alias("hard_case_train_ratio"),
    )
    status = F.when(F.col("train_count") % 3 == 0, "blocked").when(F.col("train_count") % 3 == 1, "ready").otherwise("review_required")
    return counts.withColumn("training_readiness_status", status)


def profile_deltas(spark, folder):
    reports = (_report(spark, folder, run) for run in "bc")
    d = compare_reports(*reports, *(_profiles(spark, folder, run) for run in "bc")).profiles
    return d.select("field_group", "status", "train_count_delta", "val_count_delta", "train_source_count_delta", "val_source_count_delta",
                    "unique_hard_case_variant_count_delta", "hard_case_train_ratio_delta", F.col("readiness_rank_delta").cast("bigint").alias("readiness_rank_delta"),
                    "readiness_transition")


PROFILE_SQL = """
WITH base AS (SELECT r.run, CASE WHEN p_brand = CASE run WHEN 'b' THEN 'Brand#3' ELSE 'Brand#5' END THEN 'Brand#1' ELSE p_brand END AS g,
  CASE run WHEN 'b' THEN l_suppkey % 5 = 0 ELSE (l_suppkey + l_linenumber) % 4 = 0 END AS val, l_suppkey, l_returnflag, l_tax FROM lineitem JOIN part ON l_partkey = p_partkey
  CROSS JOIN (VALUES ('b'), ('c')) r(run)),
c AS (SELECT run, g, count(*) FILTER (NOT val) AS t, count(*) FILTER (val) AS v, count(DISTINCT l_suppkey) FILTER (NOT val) AS ts,
  count(DISTINCT l_suppkey) FILTER (val) AS vs, count(DISTINCT l_returnflag) AS u,
  round(avg(CASE WHEN l_tax > 0.04 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS ratio FROM base GROUP BY ALL),
s AS (SELECT *, CASE t % 3 WHEN 0 THEN 'blocked' WHEN 1 THEN 'ready' ELSE 'review_required' END AS st, CASE t % 3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS rk FROM c),
j AS (SELECT coalesce(a.g, b.g) AS field_group, a.g IS NULL AS added, b.g IS NULL AS removed, b.t - a.t AS dt, b.v - a.v AS dv, b.ts - a.ts AS dts,
  b.vs - a.vs AS dvs, b.u - a.u AS du, round(b.ratio - a.ratio, 4) AS dr, (b.rk - a.rk)::BIGINT AS drk, a.st || '->' || b.st AS tr
  FROM (SELECT * FROM s WHERE run = 'b') a FULL JOIN (SELECT * FROM s WHERE run = 'c') b ON a.g = b.g)
SELECT field_group, CASE WHEN added THEN 'added' WHEN removed THEN 'removed'
  WHEN greatest(drk, dt, dv, dts, dvs, du) > 0 AND least(drk, dt, dv, dts, dvs, du) < 0 THEN 'mixed'
  WHEN greatest(drk, dt, dv, dts, dvs, du) > 0 THEN 'improved' WHEN least(drk, dt, dv, dts, dvs, du) < 0 THEN 'regressed' ELSE 'unchanged' END AS status,
  dt AS train_count_delta, dv AS val_count_delta, dts AS train_source_count_delta, dvs AS val_source_count_delta,
  du AS unique_hard_case_variant_count_delta, dr AS hard_case_train_ratio_delta, drk AS readiness_rank_delta, tr AS readiness_transition FROM j"""


def case_evaluation(spark, folder):
    k = F.col("k")
    wanted = V.expected(spark, folder).withColumns({
        "expected_status": F.when(k % 3 == 0, K.REJECT).otherwise(K.PASS),
        "expected_quality_checks": F.create_map(F.lit("seal_present"), F.lit(True)),
        "expected_finding_codes": F.when(k % 2 == 0, F.array(F.lit("required_tin_invalid"), F.lit("required_name_missing"))),
        "expected_cross_check": F.create_map(F.lit("matched"), F.lit(True)),
        "document_type": F.when(k % 50 == 7, K.APOSTILLE).otherwise(F.col("document_type")),
    })
    rows = E.evaluate(wanted, V.run_results(spark, folder, "b"))
    return rows.groupBy("case_id", "document_type", "passed", F.array_join("mismatches", " | ").alias("mismatches")).agg(F.count(F.lit(1)).alias("rows"))


CASE_SQL = """, wanted AS (SELECT case_id, k, t.document_type, CASE WHEN k % 3 = 0 THEN 'reject' ELSE 'pass' END AS st,
   CASE WHEN k % 50 = 7 THEN 'apostille' ELSE t.document_type END AS shown_type FROM people_v CROSS JOIN (VALUES ('residency_certificate'), ('withholding_tax_form')) t(document_type)
   WHERE k % 10 <> 3),
fieldrows AS (SELECT w.case_id, w.document_type, e.field_name, e.expected, CASE WHEN w.shown_type = 'apostille' THEN NULL ELSE a.actual END AS actual,
    CASE e.field_name WHEN 'taxpayer_name' THEN 1 WHEN 'tin' THEN CASE w.document_type WHEN 'residency_certificate' THEN 2 ELSE 1 END WHEN 'issue_date' THEN 3 ELSE 2 END AS p
  FROM wanted w JOIN expected_v e ON e.case_id = w.case_id AND e.document_type = w.document_type
  LEFT JOIN actual_v a ON a.run = 'b' AND a.case_id = e.case_id AND a.document_type = e.document_type AND a.field_name = e.field_name),
fieldbad AS (SELECT case_id, document_type, string_agg('expected field ' || field_name || '=''' || expected || ''', got ' || coalesce('''' || actual || '''', 'None'), ' | ' ORDER BY p) AS m
  FROM fieldrows WHERE actual IS DISTINCT FROM expected GROUP BY ALL),
rows_ AS (SELECT w.case_id, w.shown_type AS document_type, concat_ws(' | ',
   CASE WHEN st <> CASE WHEN k % 4 = 0 OR k % 6 = 0 THEN 'reject' ELSE 'pass' END THEN 'expected status ' || st || ', got ' || CASE WHEN k % 4 = 0 OR k % 6 = 0 THEN 'reject' ELSE 'pass' END END,
   CASE WHEN shown_type = 'apostille' THEN 'missing document type apostille in run result' END, f.m,
   CASE WHEN shown_type = 'apostille' THEN 'expected quality check seal_present=True, got None' WHEN k % 7 = 0 THEN 'expected quality check seal_present=True, got False' END,
   CASE WHEN k % 2 = 0 AND (k % 4 <> 0 OR k % 6 <> 0) THEN 'missing finding codes: ' || concat_ws(', ', CASE WHEN k % 6 <> 0 THEN 'required_name_missing' END, CASE WHEN k % 4 <> 0 THEN 'required_tin_invalid' END) END,
   CASE WHEN k % 8 = 0 THEN 'expected cross_check matched=True, got False' END) AS mismatches
  FROM wanted w LEFT JOIN fieldbad f ON f.case_id = w.case_id AND f.document_type = w.document_type)
SELECT case_id, document_type, mismatches = '' AS passed, mismatches, count(*) AS rows FROM rows_ GROUP BY ALL"""


def _suite(spark, folder):
    orders, lines = V.table(spark, folder, "orders"), V.table(spark, folder, "lineitem")
    expected = V.table(spark, folder, "customer").select(F.col("c_custkey").alias("case_id"))
    labels = orders.select(
        F.col("o_custkey").alias("case_id"),
        F.when(F.col("o_orderstatus") == "O", K.APOSTILLE).when(F.col("o_orderstatus") == "F", K.RESIDENCY).alias("document_type"),
        F.when(F.col("o_orderkey") % 9 == 0, F.lit("synthetic://x")).otherwise(F.concat(F.lit("src_"), F.col("o_orderkey"))).alias("source_path"),
    )
    files = lines.filter("l_quantity > 25").select(F.concat(F.lit("src_"), F.col("l_orderkey")).alias("path"))
    return E.suite_cases(expected, labels, files)


def suite_documents(spark, folder):
    return _suite(spark, folder)[0].groupBy("case_id", "document_type").agg(F.count(F.lit(1)).alias("documents"), F.min("source_path").alias("first_source"))


def suite_missing(spark, folder):
    return _suite(spark, folder)[1]


SUITE_SQL = """WITH usable AS (SELECT o_custkey AS case_id, CASE o_orderstatus WHEN 'O' THEN 'apostille' WHEN 'F' THEN 'residency_certificate' END AS document_type,
  'src_' || o_orderkey AS source_path FROM orders WHERE o_orderkey % 9 <> 0 AND o_orderstatus IN ('O', 'F')
  AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 25)) """

_RATES = "round({0}rate{1}, 6) AS exact_match_rate, round({0}cer{1}, 6) AS average_character_error_rate, round({0}wer{1}, 6) AS average_word_error_rate"
RATES_SQL = _RATES.format("", "")

QUERIES = [
    Query("E1_case_evaluation", case_evaluation, V.plain(V.with_views(("people_v", "actual_v"), COMPARE.strip()) + CASE_SQL)),
    Query("E2_field_comparison", field_comparison, _sql(
        "SELECT case_id, document_type, field_name, expected, actual, exact_match, round(cer, 6) AS cer, round(wer, 6) AS wer FROM rated WHERE run = 'b'")),
    Query("E3_E4_error_rates", error_rates, ERROR_RATES_SQL),
    Query("E5_field_metrics", field_error_report_query, _sql(f"SELECT field_key, comparisons, exact_matches, {RATES_SQL} FROM met WHERE run = 'b'")),
    Query("E6_missing_cases", missing_cases, _sql(
        "SELECT case_id FROM miss WHERE run = 'b' UNION ALL SELECT case_id FROM miss WHERE run = 'b'")),
    Query("E6_compared_cases", compared_cases, _sql(
        "SELECT count(DISTINCT case_id) AS compared_cases FROM rated WHERE run = 'c' AND case_id IN "
        "(SELECT 'case_' || lpad(o_custkey::VARCHAR, 8, '0') FROM orders WHERE o_orderpriority = '1-URGENT')")),
    Query("E7_metric_rollups", metric_rollups, _sql(f"SELECT level, key, comparisons, exact_matches, {RATES_SQL} FROM lev WHERE run = 'c'")),
    Query("E8_metric_deltas", metric_deltas, _sql(
        "SELECT level, key, status, comparison_delta, round(dm, 6) AS exact_match_rate_delta, "
        "round(dc, 6) AS average_character_error_rate_delta, round(dw, 6) AS average_word_error_rate_delta FROM sig")),
    Query("E9_metric_severity", metric_severity, _sql(
        "SELECT level, key, status, severe AS severe_regression, notable AS notable_improvement FROM sev")),
    Query("E10_missing_case_diff", missing_case_diff, _sql(
        "SELECT case_id, 'resolved' AS change FROM (SELECT case_id FROM miss WHERE run = 'b' EXCEPT SELECT case_id FROM miss WHERE run = 'c') "
        "UNION ALL SELECT case_id, 'new' FROM (SELECT case_id FROM miss WHERE run = 'c' EXCEPT SELECT case_id FROM miss WHERE run = 'b')")),
    Query("E11_promotion_gate", promotion_gate, V.plain(V.with_views(("people_v", "actual_v"), COMPARE.strip()) + PROMOTION_SQL)),
    Query("E12_profile_deltas", profile_deltas, PROFILE_SQL),
    Query("E13_suite_documents", suite_documents, SUITE_SQL + "SELECT case_id, document_type, count(*) AS documents, min(source_path) AS first_source FROM usable WHERE case_id IN (SELECT c_custkey FROM customer) GROUP BY ALL"),
    Query("E13_suite_missing", suite_missing, SUITE_SQL + "SELECT c_custkey AS case_id FROM customer WHERE c_custkey NOT IN (SELECT case_id FROM usable)"),
]
