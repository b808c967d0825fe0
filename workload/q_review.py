"""Review rules, cross-check, status, gate, whole review run and the streaming intake."""

import uuid

from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.operators import review as R
from paperloom.plans.review_run import run_review
from paperloom.session import shared_folder, spread
from paperloom.sources.writers import compact_queue, read_queue
from paperloom.streaming.intake import review_stream
from paperloom.streaming.rounds import review_rounds, start_rounds
from workload import views as V
from workload.query import Query

_TIN_OK = "coalesce(regexp_full_match(trim(tin), '\\d{3}-\\d{2}-\\d{4}|\\d{2}-\\d{7}'), FALSE)"


def _gone(c):
    return f"coalesce({c}, '') = ''"


_COUNTRY = "Residency country must be United States of America."
RESIDENCY_RULES = [
    (_gone("taxpayer_name"), "required_name_missing", "Taxpayer name is missing.", "taxpayer_name"),
    (f"NOT {_TIN_OK}", "required_tin_invalid", "TIN format is invalid.", "tin"),
    (_gone("tax_year"), "required_tax_year_missing", "Tax year is missing.", "tax_year"),
    (_gone("issue_date"), "required_issue_date_missing", "Issue date is missing.", "issue_date"),
    ("residency_country IS DISTINCT FROM 'United States of America'", "required_residency_country_invalid", _COUNTRY, "residency_country"),
    ("residency_country_code IS DISTINCT FROM 'US'", "required_residency_country_code_invalid", "Residency country code must be US.", "residency_country_code"),
    ("NOT coalesce(has_certification_text, FALSE)", "required_certification_text_missing", "Certification text is missing.", None),
    ("NOT coalesce(seal_present, FALSE)", "required_certification_seal_missing", "Certification seal was not detected.", "seal_present"),
    ("NOT coalesce(signature_present, FALSE)", "required_signature_missing", "Signature was not detected.", "signature_present"),
]
APOSTILLE_RULES = [
    ("NOT coalesce(has_apostille_heading, FALSE)", "required_apostille_heading_missing", "Apostille heading not found.", None),
    *[(_gone(n), "required_apostille_field_missing", f"Apostille field {n} is missing.", n) for n in K.APOSTILLE_FIELDS],
    ("NOT coalesce(regexp_matches(issued_on, '\\d{1,2}') AND regexp_matches(issued_on, '\\d{4}') AND regexp_matches(issued_on, '(?i)\\b(" + "|".join(K.MONTHS) + ")\\b'), FALSE)",
     "required_apostille_date_invalid", "Apostille date is incomplete or invalid.", "issued_on"),
    ("NOT coalesce(seal_present, FALSE)", "required_seal_missing", "Apostille seal/stamp was not detected.", "seal_present"),
    ("NOT coalesce(signature_present, FALSE)", "required_signature_missing", "Apostille signature was not detected.", "signature_present"),
]
WITHHOLDING_RULES = [
    (f"{_gone('first_name')} OR {_gone('last_name')}", "required_name_missing", "First/last name is missing.", None),
    (_gone("address"), "required_address_missing", "Address is missing.", "address"),
    (f"NOT {_TIN_OK}", "required_tin_invalid", "TIN format is invalid.", "tin"),
    ("coalesce(residency_country, '') NOT IN ('United States of America', 'USA')", "required_residency_country_invalid", _COUNTRY, "residency_country"),
    ("residency_country_code IS DISTINCT FROM 'US'", "required_residency_country_code_invalid", "Residency country code must be US.", "residency_country_code"),
    ("dividend_tax_rate IS DISTINCT FROM '15%'", "required_dividend_rate_invalid", "Dividend tax rate must be 15%.", "dividend_tax_rate"),
    (_gone("signature_date"), "required_signature_date_missing", "Signature date is missing.", "signature_date"),
    ("NOT coalesce(all_no_boxes_checked, FALSE)", "required_no_checkbox_missing", "All 'No' checkboxes must be checked.", "all_no_boxes_checked"),
    ("NOT coalesce(signature_present, FALSE)", "required_signature_missing", "Signature was not detected.", "signature_present"),
]


def _quote(text):
    return "NULL::VARCHAR" if text is None else "'" + text.replace("'", "''") + "'"


def _rule_rows(rules, source, kind, order):
    return " UNION ALL ".join(
        f"SELECT case_id, position, {order * 100 + i} AS ord, {_quote(code)} AS code, {_quote(message)} AS message, {_quote(field)} AS field_name "
        f"FROM {source} WHERE document_type = '{kind}' AND ({test})"
        for i, (test, code, message, field) in enumerate(rules)
    )


def _all_rows(source):
    return " UNION ALL ".join([
        _rule_rows(RESIDENCY_RULES, source, K.RESIDENCY, 1), _rule_rows(APOSTILLE_RULES, source, K.APOSTILLE, 2),
        _rule_rows(WITHHOLDING_RULES, source, K.WITHHOLDING, 3),
    ])


# latest papers, cross-check and findings of a relation shaped like docs_v
REVIEW = """
last_v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY case_id, document_type ORDER BY position DESC) AS rn FROM {docs}) WHERE rn = 1),
pair_v AS (SELECT c.case_id, r.case_id IS NOT NULL AND w.case_id IS NOT NULL AS paired,
    coalesce(r.tin <> '' AND w.tin <> '' AND trim(r.tin) <> trim(w.tin), FALSE) AS bad_tin,
    coalesce(r.residency_country <> '' AND w.residency_country <> '' AND trim(r.residency_country) <> trim(w.residency_country), FALSE) AS bad_country,
    coalesce(r.residency_country_code <> '' AND w.residency_country_code <> '' AND trim(r.residency_country_code) <> trim(w.residency_country_code), FALSE) AS bad_code,
    coalesce(r.taxpayer_name <> '' AND concat_ws(' ', w.first_name, nullif(w.middle_name, ''), w.last_name) <> ''
      AND regexp_replace(lower(r.taxpayer_name), '[^a-z0-9]', '', 'g') <> regexp_replace(lower(concat_ws(' ', w.first_name, nullif(w.middle_name, ''), w.last_name)), '[^a-z0-9]', '', 'g'), FALSE) AS bad_name
  FROM (SELECT DISTINCT case_id FROM {docs}) c LEFT JOIN (SELECT * FROM last_v WHERE document_type = 'residency_certificate') r USING (case_id)
  LEFT JOIN (SELECT * FROM last_v WHERE document_type = 'withholding_tax_form') w USING (case_id)),
crossf AS (SELECT case_id, 401 AS ord, 'required_cross_check_mismatch' AS code, 'Cross-check mismatch for tin.' AS message, 'tin' AS field_name FROM pair_v WHERE paired AND bad_tin
  UNION ALL SELECT case_id, 402, 'required_cross_check_mismatch', 'Cross-check mismatch for residency_country.', 'residency_country' FROM pair_v WHERE paired AND bad_country
  UNION ALL SELECT case_id, 403, 'required_cross_check_mismatch', 'Cross-check mismatch for residency_country_code.', 'residency_country_code' FROM pair_v WHERE paired AND bad_code
  UNION ALL SELECT case_id, 404, 'required_cross_check_mismatch', 'Cross-check mismatch for taxpayer name.', 'taxpayer_name' FROM pair_v WHERE paired AND bad_name),
found AS (SELECT case_id, ord, code, message, field_name FROM ({rules}) UNION ALL SELECT * FROM crossf),
doubt AS (SELECT case_id, bool_or(coalesce(blurry, FALSE)) AS blurry, bool_or(coalesce(low_ocr_confidence, FALSE)) AS low_confidence, count(*) AS document_count FROM {docs} GROUP BY case_id),
cases AS (SELECT p.case_id, p.paired AND NOT (bad_tin OR bad_country OR bad_code OR bad_name) AS matched,
    CASE WHEN NOT paired THEN 'cross-check skipped because one of the documents is missing' WHEN bad_tin OR bad_country OR bad_code OR bad_name THEN 'one or more cross-check fields do not match' END AS reason,
    coalesce(f.n, 0) AS finding_count, coalesce(f.codes, '') AS codes, CASE WHEN coalesce(f.n, 0) > 0 THEN 'reject' ELSE 'pass' END AS status, blurry, low_confidence, document_count
  FROM pair_v p JOIN doubt USING (case_id) LEFT JOIN (SELECT case_id, count(*) AS n, string_agg(code || ':' || coalesce(field_name, ''), ',' ORDER BY ord) AS codes FROM found GROUP BY case_id) f USING (case_id))
"""


def _review(select, docs="docs_v"):
    body = REVIEW.replace("{docs}", docs).replace("{rules}", _all_rows("last_v"))
    return V.plain(V.with_views(("docs_v",), body.strip()) + select)


def _codes(findings):
    return F.array_join(F.transform(findings, lambda f: F.concat(f["code"], F.lit(":"), F.coalesce(f["field_name"], F.lit("")))), ",")


def _one(rule_set):
    def run(spark, folder):
        rows = rule_set(V.documents(spark, folder))
        return rows.groupBy("case_id", "code", "message", "field_name").agg(F.count(F.lit(1)).alias("rows"))

    return run


def _one_sql(rules, kind):
    return V.plain(V.with_views(("docs_v",)) + f"SELECT case_id, code, message, field_name, count(*) AS rows FROM ({_rule_rows(rules, 'docs_v', kind, 1)}) GROUP BY ALL")


def cross_check(spark, folder):
    rows = R.cross_check(V.documents(spark, folder))
    return rows.select("case_id", "matched", "reason", F.array_join(F.transform("findings", lambda f: f["field_name"]), ",").alias("fields"))


def latest_documents(spark, folder):
    docs = V.documents(spark, folder)
    first = R.pick_document(docs, "first").withColumn("which", F.lit("first"))
    last = R.pick_document(docs, "last").withColumn("which", F.lit("last"))
    rows = first.unionByName(last)
    return rows.select("case_id", "document_type", "which", "position", F.try_element_at("fields", F.lit("tax_year")).alias("tax_year"))


def case_status(spark, folder):
    docs = R.pick_document(V.documents(spark, folder))
    ruled = R.document_findings(docs).select("case_id", F.explode("findings").alias("f")).select("case_id", "f.code")
    crossed = R.cross_check(docs).select("case_id", F.explode("findings").alias("f")).select("case_id", "f.code")
    return R.case_status(docs.select("case_id").distinct(), ruled.unionByName(crossed))


def queue_gate(spark, folder):
    docs = V.documents(spark, folder)
    return R.queue_gate(R.review_cases(docs), docs)


def reviewed_cases(spark, folder):
    rows = R.review_cases(V.documents(spark, folder))
    return rows.select("case_id", "status", "matched", "reason", "blurry", "low_confidence", "document_count", "queued", _codes(F.col("findings")).alias("codes"))


def review_run(spark, folder):
    """Pages, regions and rasters to reviewed cases: every recognised text and every raster."""
    text = V.view(spark, folder, "page_text_v")
    pages = text.select(
        "case_id", F.lit(0).alias("position"), "document_type",
        F.concat("case_id", F.lit("/"), "source_path").alias("source_path"), F.lit(1).alias("page_number"), "raw_text",
        F.array(F.struct(F.lit("w").alias("text"), F.when(F.col("k") % 41 == 0, 0.5).otherwise(0.9).alias("confidence"))).alias("words"),
    )
    marked = V.big_rasters(spark, folder)
    known = V.table(spark, folder, "embeddings").count()  # image ids are 0 to known - 1
    papers = text.select(F.concat("case_id", F.lit("/"), "source_path").alias("image_id"), (F.col("k") % known).alias("vec"))
    # the few crops are sent to the papers, which are dealt out first: their file is small, their pixels are not
    rasters = spread(papers).join(marked.withColumnRenamed("image_id", "vec"), "vec").select("image_id", "width", "height", "pixels")
    cases, _ = run_review(pages, None, rasters)
    return cases.select("case_id", "status", "matched", "reason", "blurry", "low_confidence", "document_count", "queued", _codes(F.col("findings")).alias("codes"))


def streaming_intake(spark, folder):
    """The intake plan over the stored events: one session per user and silence of two days."""
    return review_stream(_events(V.table(spark, folder, "events"))).select(
        "case_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), F.date_format("end", "yyyy-MM-dd HH:mm:ss").alias("end"),
        "document_count", "status", "queued", F.size("findings").cast("bigint").alias("finding_count"),
    )


def _events(events):
    """Events as papers: errors are residency papers without a seal, purchases withholding forms."""
    kind = F.when(F.col("event_type") == "error", K.RESIDENCY).when(F.col("event_type") == "purchase", K.WITHHOLDING).otherwise(K.APOSTILLE)
    tin = F.concat(F.lit("123-45-"), F.lpad((F.col("user_id") % 10000).cast("string"), 4, "0"))
    return events.select(
        F.col("user_id").cast("string").alias("case_id"), F.col("ts").cast("timestamp").alias("ts"), kind.alias("document_type"),
        F.col("event_id").alias("position"), F.create_map(F.lit("tin"), tin, F.lit("address"), F.lit("1 Main")).alias("fields"),
        F.struct(*[(F.col("event_type") == "view").alias(n) for n in (
            "has_certification_text", "has_apostille_heading", "seal_present", "signature_present", "all_no_boxes_checked", "blurry", "low_ocr_confidence")]).alias("quality_checks"),
    )


def _rounds(spark, folder, slices=5):
    """The stored events as a stream: files of ``slices`` stretches of time, one micro-batch each."""
    events = V.table(spark, folder, "events")
    root = f"{shared_folder(spark)}/paperloom-stream-{uuid.uuid4().hex}"
    low, high = events.agg(F.min(F.unix_timestamp("ts")), F.max(F.unix_timestamp("ts"))).first()
    width = ((high or 0) - (low or 0)) // slices + 1
    at = F.floor((F.unix_timestamp("ts") - (low or 0)) / width)
    files = _files_per_slice(spark, [r["count"] for r in events.groupBy(at.alias("slice")).count().where("slice IS NOT NULL").collect()], slices)
    for k in range(slices):  # written one after another: the stream takes files in the order of their times
        part = events.where(at == k)
        (part.coalesce(1) if files == 1 else part.repartition(files)).write.parquet(f"{root}/in/slice={k}")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in/slice=*")
    return review_rounds(_events(stream)), root


def _files_per_slice(spark, counts, slices):
    """As many files for every slice as keep the cores busy; one, if a slice is too small to fill each of them.

    A micro-batch takes so many files: were one missing, it would mix two slices, and the watermark drop papers.
    """
    return max(1, min(2 * spark.sparkContext.defaultParallelism, min(counts) // 10_000)) if len(counts) == slices else 1


def review_rounds_of_events(spark, folder):
    """A run of the stream to its end: reviews on completion or when time is up, and counts of late papers."""
    reviewed, root = _rounds(spark, folder)
    columns = ["case_id", "start", "reason_of_review", "document_count", "late_count", "status", "blurry", "matched", F.size("findings").cast("bigint").alias("finding_count")]
    sink = reviewed.select(*columns).writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
    sink.trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    rows = spark.read.parquet(f"{root}/out")
    return rows.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


def stored_queue(spark, folder):
    """Papers in the queue that the stream has stored, after compaction: those of each case's last review."""
    reviewed, root = _rounds(spark, folder)
    start_rounds(reviewed, f"{root}/queue", f"{root}/checkpoint").awaitTermination()
    compact_queue(spark, f"{root}/queue")
    cases, documents = read_queue(spark, f"{root}/queue")
    tin = F.try_element_at("fields", F.lit("tin")).alias("tin")
    papers = documents.select("case_id", "document_type", "position", F.size("findings").cast("bigint").alias("finding_count"), tin)
    return papers.join(cases.select("case_id", "reason_of_review", "document_count", "late_count"), "case_id")


ROUNDS_SQL = """WITH RECURSIVE p AS (SELECT user_id::VARCHAR AS case_id, ts, event_id, event_type, CASE event_type WHEN 'error' THEN 'r' WHEN 'purchase' THEN 'w' ELSE 'a' END AS kind FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
r AS (SELECT case_id, min(ts) AS start FROM p GROUP BY ALL UNION ALL SELECT r.case_id, min(p.ts) FROM r JOIN p ON p.case_id = r.case_id AND p.ts >= r.start + INTERVAL 5 DAY GROUP BY r.case_id, r.start),
m AS (SELECT p.*, r.start FROM p ASOF JOIN r ON p.case_id = r.case_id AND p.ts >= r.start),
f AS (SELECT case_id, start, kind, min((ts, event_id)) AS first FROM m GROUP BY ALL),
k AS (SELECT case_id, start, CASE WHEN count(*) = 3 THEN max(first) END AS done FROM f GROUP BY ALL),
n AS (SELECT m.*, k.done, k.done IS NULL OR (ts, event_id) <= k.done AS counted FROM m JOIN k USING (case_id, start)),
c AS (SELECT case_id, start, any_value(done) IS NOT NULL AS done, count(*) FILTER (counted) AS document_count, count(*) FILTER (NOT counted) AS late,
  coalesce(bool_or(event_type = 'view') FILTER (counted), FALSE) AS blurry, count(*) FILTER (counted AND kind = 'r') > 0 AS r, count(*) FILTER (counted AND kind = 'w') > 0 AS w,
  count(*) FILTER (counted AND kind = 'a') > 0 AS a, arg_max(event_type, (ts, event_id)) FILTER (counted AND kind = 'a') AS last_a,
  arg_max(event_id, (ts, event_id)) FILTER (counted AND kind = 'r') AS at_r, arg_max(event_id, (ts, event_id)) FILTER (counted AND kind = 'w') AS at_w, arg_max(event_id, (ts, event_id)) FILTER (counted AND kind = 'a') AS at_a FROM n GROUP BY ALL),
l AS (SELECT *, lead(start) OVER (PARTITION BY case_id ORDER BY start) IS NOT NULL OR start + INTERVAL 5 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM p) AS closed FROM c),
q AS (SELECT *, CASE WHEN r THEN 8 ELSE 0 END AS n_r, CASE WHEN w THEN 7 ELSE 0 END AS n_w, CASE WHEN a THEN CASE WHEN last_a = 'view' THEN 9 ELSE 12 END ELSE 0 END AS n_a FROM l),
e AS (SELECT *, 'complete' AS reason_of_review, 0::BIGINT AS late_count FROM q WHERE done UNION ALL SELECT *, 'time_up', 0 FROM q WHERE NOT done AND closed UNION ALL SELECT *, 'late', late FROM q WHERE done AND closed AND late > 0)
"""
ROUNDS_ROWS = ROUNDS_SQL + """SELECT case_id, strftime(start, '%Y-%m-%d %H:%M:%S') AS start, reason_of_review, document_count, late_count, 'reject' AS status, blurry, r AND w AS matched, (n_r + n_w + n_a)::BIGINT AS finding_count FROM e"""
ROUNDS_QUEUE = ROUNDS_SQL + """, z AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY start DESC, reason_of_review = 'late' DESC) = 1)
SELECT case_id, document_type, position, finding_count::BIGINT AS finding_count, '123-45-' || lpad(right(case_id, 4), 4, '0') AS tin, reason_of_review, document_count, late_count FROM (
  SELECT *, '{r}' AS document_type, at_r AS position, n_r AS finding_count FROM z WHERE r UNION ALL SELECT *, '{w}', at_w, n_w FROM z WHERE w UNION ALL SELECT *, '{a}', at_a, n_a FROM z WHERE a)""".replace("{r}", K.RESIDENCY).replace("{w}", K.WITHHOLDING).replace("{a}", K.APOSTILLE)

STREAM_SQL = """WITH e AS (SELECT user_id::VARCHAR AS case_id, ts, event_id, event_type, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 2 DAY THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY case_id ORDER BY ts, event_id) AS sid FROM e),
kinded AS (SELECT *, CASE event_type WHEN 'error' THEN 'r' WHEN 'purchase' THEN 'w' ELSE 'a' END AS kind FROM s),
l AS (SELECT case_id, sid, min(ts) AS start, max(ts) + INTERVAL 2 DAY AS "end", count(*) AS document_count, count(*) FILTER (kind = 'r') > 0 AS r, count(*) FILTER (kind = 'w') > 0 AS w,
  count(*) FILTER (kind = 'a') > 0 AS a, arg_max(event_type, (ts, event_id)) FILTER (kind = 'a') AS last_a FROM kinded GROUP BY ALL),
n AS (SELECT *, (CASE WHEN r THEN 8 ELSE 0 END + CASE WHEN w THEN 7 ELSE 0 END + CASE WHEN a THEN CASE WHEN last_a = 'view' THEN 9 ELSE 12 END ELSE 0 END)::BIGINT AS finding_count FROM l)
SELECT case_id, strftime(start, '%Y-%m-%d %H:%M:%S') AS start, strftime("end", '%Y-%m-%d %H:%M:%S') AS "end", document_count, 'reject' AS status, TRUE AS queued, finding_count FROM n"""

_CASE_COLUMNS = "case_id, status, matched, reason, blurry, low_confidence, document_count, status <> 'pass' OR blurry OR low_confidence AS queued, codes"

QUERIES = [
    Query("R1_residency_rules", _one(R.review_residency), _one_sql(RESIDENCY_RULES, K.RESIDENCY)),
    Query("R2_apostille_rules", _one(R.review_apostille), _one_sql(APOSTILLE_RULES, K.APOSTILLE)),
    Query("R3_withholding_rules", _one(R.review_withholding), _one_sql(WITHHOLDING_RULES, K.WITHHOLDING)),
    Query("R4_cross_check", cross_check, _review(
        "SELECT p.case_id, matched, reason, coalesce(fields, '') AS fields FROM cases p LEFT JOIN (SELECT case_id, string_agg(field_name, ',' ORDER BY ord) AS fields FROM crossf GROUP BY case_id) x USING (case_id)")),
    Query("R5_latest_documents", latest_documents, V.plain(V.with_views(("docs_v",)) + """SELECT case_id, document_type, 'first' AS which, min(position) AS position, arg_min(coalesce(tax_year, chr(0)), position) AS tax_year FROM docs_v GROUP BY ALL
        UNION ALL SELECT case_id, document_type, 'last', max(position), arg_max(coalesce(tax_year, chr(0)), position) FROM docs_v GROUP BY ALL""").replace("arg_min(coalesce(tax_year, chr(0)), position)", "nullif(arg_min(coalesce(tax_year, '-'), position), '-')").replace("arg_max(coalesce(tax_year, chr(0)), position)", "nullif(arg_max(coalesce(tax_year, '-'), position), '-')")),
    Query("R6_case_status", case_status, _review("SELECT case_id, status, finding_count FROM cases")),
    Query("R7_queue_gate", queue_gate, _review("SELECT case_id, status FROM cases WHERE status <> 'pass' OR blurry OR low_confidence")),
    Query("R7_reviewed_cases", reviewed_cases, _review(f"SELECT {_CASE_COLUMNS} FROM cases")),
    Query("R8_review_run", review_run),
    Query("W1_streaming_intake", streaming_intake, STREAM_SQL),
    Query("W1_review_rounds", review_rounds_of_events, ROUNDS_ROWS),
    Query("K4_stored_queue", stored_queue, ROUNDS_QUEUE),
]
