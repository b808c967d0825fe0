"""Training-set curation."""

from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.operators import curate as C
from paperloom.plans.training import training_summary
from workload import views as V
from workload.q_extract import LABELS_SQL, _files, _labels, _values
from workload.query import Query

TRAIN_HARD = "split = 'train'"


def _v(names, select):
    return V.plain(V.with_views(names) + select)


def draw(*parts):
    """The drawn number of a row in SQL."""
    return "('0x' || substr(md5(concat_ws('|', " + ", ".join(parts) + ")), 1, 8))::BIGINT"


def crop_manifest(spark, folder):
    eligible = C.eligibility(_labels(spark, folder), _files(spark, folder)).withColumn(
        "split", F.when(F.col("k") % 4 == 0, K.VAL).otherwise(K.TRAIN)
    )
    rows = C.crop_manifest(eligible)
    return rows.select("case_id", "document_type", "template_id", "field_name", "field_group", "text", "split", "source_path", "crop_path",
                       *[F.col(f"box.{e}").cast("bigint").alias(f"box_{e}") for e in ("left", "top", "right", "bottom")])


def invalid_boxes(spark, folder):
    eligible = C.eligibility(_labels(spark, folder), _files(spark, folder)).withColumn("split", F.lit(K.TRAIN))
    return C.invalid_boxes(eligible)


CROP_SQL = LABELS_SQL + f""", o(template_id, name, l, t, r, b) AS (VALUES {_values('ocr')}),
good AS (SELECT *, CASE document_type WHEN 'residency_certificate' THEN 'residency.irs_standard' WHEN 'withholding_tax_form' THEN 'withholding.non_resident_v1' ELSE 'apostille.north_carolina' END AS template_id,
  CASE WHEN k % 4 = 0 THEN 'val' ELSE 'train' END AS split FROM elig WHERE skip_reason IS NULL),
f AS (SELECT good.*, o.name AS field_name, CASE o.name WHEN 'tin' THEN CASE WHEN k % 5 <> 0 THEN prio END WHEN 'issue_date' THEN st WHEN 'address' THEN '12 Main' WHEN 'signed_by' THEN prio END AS text,
  trunc(width * l)::BIGINT AS box_left, trunc(height * o.t)::BIGINT AS box_top, trunc(width * r)::BIGINT AS box_right, trunc(height * b)::BIGINT AS box_bottom FROM good JOIN o USING (template_id)),
g AS (SELECT *, CASE field_name WHEN 'tin' THEN 'numeric_tin_code' WHEN 'issue_date' THEN 'date' ELSE 'english_name_org' END AS field_group FROM f WHERE text IS NOT NULL)
"""


def crop_summary(spark, folder):
    return C.crop_summary(V.crops(spark, folder))


SUMMARY_SQL = _v(("crops_v",), """SELECT 'total' AS section, 'crops' AS key, count(*) AS rows FROM crops_v UNION ALL SELECT 'total', 'unique_sources', count(DISTINCT source_path) FROM crops_v
  UNION ALL SELECT 'verdict', CASE WHEN accepted THEN 'accepted' ELSE 'rejected' END, count(*) FROM crops_v GROUP BY ALL
  UNION ALL SELECT 'field_group', field_group, count(*) FROM crops_v GROUP BY ALL UNION ALL SELECT 'split', split, count(*) FROM crops_v GROUP BY ALL
  UNION ALL SELECT 'document_type', document_type, count(*) FROM crops_v GROUP BY ALL UNION ALL SELECT 'quality_flag', flag, count(*) FROM crops_v WHERE flag IS NOT NULL GROUP BY ALL
  UNION ALL SELECT 'salvage', 'salvaged', count(*) FROM crops_v WHERE accepted AND contains(text, 'ring') GROUP BY ALL""")

VARIANT_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{g}', '{v}')" for g, vs in K.VARIANTS.items() for v in vs) + ") t(field_group, variant)"


def hard_case_plan(spark, folder):
    rows = C.hard_case_plan(V.crops(spark, folder))
    return rows.select("case_id", "field_group", "augmentation_type", "base_crop_path", "crop_path")


PLAN_SQL = _v(("crops_v",), f"""SELECT case_id, field_group, variant AS augmentation_type, crop_path AS base_crop_path,
  'hard_cases/' || field_group || '/' || variant || '/' || replace(crop_path, '.png', '') || '__' || variant || '.png' AS crop_path FROM crops_v JOIN ({VARIANT_SQL}) USING (field_group) WHERE split = 'train'""")


def donors(spark, folder):
    crops = V.crops(spark, folder)
    rows = C.assign_donors(C.hard_case_plan(crops), crops)
    return rows.select("base_crop_path", "augmentation_type", "donor_group", "donor_crop_path")


DONOR_SQL = _v(("crops_v",), f"""SELECT * FROM (WITH tr AS (SELECT field_group, crop_path FROM crops_v WHERE split = 'train'),
num AS (SELECT field_group AS donor_group, crop_path AS donor_crop_path, row_number() OVER (PARTITION BY field_group ORDER BY crop_path) - 1 AS idx FROM tr),
sz AS (SELECT field_group, count(*) AS n FROM tr GROUP BY ALL),
p AS (SELECT tr.field_group, crop_path AS base_crop_path, variant AS augmentation_type, CASE WHEN variant IN ('overlay_patch', 'edge_overlap') THEN (SELECT n FROM sz WHERE field_group = 'korean_mixed_form') END AS a,
   CASE WHEN variant = 'edge_overlap' THEN (SELECT n FROM sz WHERE field_group = 'english_name_org') WHEN variant = 'overlay_patch' THEN 0 END AS b, CASE WHEN variant IN ('overlay_patch', 'edge_overlap') THEN sz.n END AS c
   FROM tr JOIN ({VARIANT_SQL}) v ON v.field_group = tr.field_group JOIN sz ON sz.field_group = tr.field_group),
d AS (SELECT *, {draw("'20260630'", "base_crop_path", "augmentation_type")} % (a + b + c) AS x FROM p),
g AS (SELECT *, CASE WHEN x < a THEN 'korean_mixed_form' WHEN x < a + b THEN 'english_name_org' WHEN x IS NOT NULL THEN field_group END AS dg, CASE WHEN x < a THEN x WHEN x < a + b THEN x - a ELSE x - a - b END AS di FROM d)
SELECT base_crop_path, augmentation_type, dg AS donor_group, donor_crop_path FROM g LEFT JOIN num ON num.donor_group = dg AND num.idx = di)""")


def current_hard_cases(spark, folder):
    rows = C.current_hard_cases(V.crops(spark, folder), V.hard_cases(spark, folder))
    return rows.groupBy("field_group", "augmentation_type", "split").agg(F.count(F.lit(1)).alias("rows"))


def stale_hard_cases(spark, folder):
    return C.stale_hard_cases(V.crops(spark, folder), V.hard_cases(spark, folder))


def hard_case_status(spark, folder):
    crops, hard = V.crops(spark, folder), V.hard_cases(spark, folder)
    return C.hard_case_statuses(crops, hard, {"all": (F.lit(True), False), "train": (F.col("split") == K.TRAIN, True), "none": None})


STATUS_SQL = _v(("crops_v", "hard_v"), f"""SELECT 'all' AS given, 'refreshed' AS status, count(*) AS stale_entry_count, (SELECT count(*) FROM crops_v JOIN ({VARIANT_SQL}) USING (field_group) WHERE split = 'train') AS total_augmented_crops
  FROM hard_v WHERE NOT (split = 'train' AND accepted)
  UNION ALL SELECT 'train', 'current', 0, count(*) FROM hard_v WHERE split = 'train'
  UNION ALL SELECT 'none', 'generated', 0, (SELECT count(*) FROM crops_v JOIN ({VARIANT_SQL}) USING (field_group) WHERE split = 'train')""")

# the base rows of a train set without cap: accepted crops, and hard cases of accepted train crops
TRAIN_BODY = """allrows AS (SELECT case_id, document_type, field_name, field_group, text, source_path, split, crop_path, NULL AS base_crop_path, NULL AS augmentation_type FROM crops_v WHERE accepted
  UNION ALL SELECT case_id, document_type, field_name, field_group, text, source_path, split, crop_path, base_crop_path, augmentation_type FROM hard_v WHERE accepted AND split = 'train'),
trainrows AS (SELECT * FROM allrows WHERE split = 'train'),
cnt AS (SELECT field_group, count(*) FILTER (augmentation_type IS NULL) AS base_count, count(*) FILTER (augmentation_type IS NOT NULL) AS hard_count, count(DISTINCT augmentation_type) AS variant_count FROM trainrows GROUP BY ALL),
cap AS (SELECT *, trunc(base_count * {r}::DOUBLE / (1.0 - {r}))::BIGINT AS allowed FROM cnt),
side AS (SELECT field_group, document_type, count(*) FILTER (augmentation_type IS NULL) AS base, count(*) FILTER (augmentation_type IS NOT NULL) AS available FROM trainrows GROUP BY ALL),
ideal AS (SELECT side.*, allowed, allowed::DOUBLE * base / base_count AS want, least(available, trunc(allowed::DOUBLE * base / base_count)::BIGINT) AS start FROM side JOIN cap USING (field_group) WHERE hard_count > allowed AND allowed > 0),
seats AS (SELECT field_group, document_type, row_number() OVER (PARTITION BY field_group ORDER BY want - start - q DESC, base DESC, document_type) AS turn FROM ideal, LATERAL (SELECT unnest(range(ideal.available - ideal.start)) AS q) g WHERE q < least(available - start, 3 + allowed - (SELECT sum(start) FROM ideal i WHERE i.field_group = ideal.field_group))),
quo AS (SELECT i.field_group, i.document_type, i.base, i.available, i.start + count(s.turn) AS quota FROM ideal i LEFT JOIN seats s ON s.field_group = i.field_group AND s.document_type = i.document_type
   AND s.turn <= i.allowed - (SELECT sum(start) FROM ideal j WHERE j.field_group = i.field_group) GROUP BY i.field_group, i.document_type, i.base, i.available, i.start),
numbered AS (SELECT t.*, row_number() OVER (PARTITION BY field_group, document_type, base_crop_path, augmentation_type ORDER BY field_name, crop_path) AS e,
   dense_rank() OVER (PARTITION BY field_group, document_type ORDER BY base_crop_path) AS i, dense_rank() OVER (PARTITION BY field_group, document_type ORDER BY augmentation_type) AS v FROM trainrows t WHERE augmentation_type IS NOT NULL),
variants AS (SELECT field_group, document_type, max(v) AS n FROM numbered GROUP BY ALL),
round AS (SELECT m.*, row_number() OVER (PARTITION BY field_group, document_type, augmentation_type ORDER BY e, ((v - i) % n + n) % n, i) AS r FROM numbered m JOIN variants USING (field_group, document_type)),
placed AS (SELECT *, row_number() OVER (PARTITION BY field_group, document_type ORDER BY r, augmentation_type) AS place FROM round),
chosen AS (SELECT p.* FROM placed p JOIN quo USING (field_group, document_type) WHERE place <= quota),
ts AS (SELECT field_group, document_type, split, source_path, text, crop_path, augmentation_type FROM allrows WHERE augmentation_type IS NULL
  UNION ALL SELECT field_group, document_type, split, source_path, text, crop_path, augmentation_type FROM chosen
  UNION ALL SELECT field_group, document_type, split, source_path, text, crop_path, augmentation_type FROM trainrows WHERE augmentation_type IS NOT NULL AND field_group IN (SELECT field_group FROM cap WHERE hard_count <= allowed))"""


def _train_sql(select, ratio=0.5):
    return V.plain(V.with_views(("crops_v", "hard_v"), TRAIN_BODY.replace("{r}", str(ratio))) + select)


def _train(spark, folder):
    rows = C.training_set(V.crops(spark, folder), V.hard_cases(spark, folder), ratio=None)
    return rows.filter("split = 'train'")


def hard_case_caps(spark, folder):
    train = _train(spark, folder)
    return C.hard_case_cap(train, 0.3).select("field_group", "base_count", "hard_count", "variant_count", "allowed", "floor_applied", "strategy", "capped")


def document_quotas(spark, folder):
    train = _train(spark, folder)
    return C.quotas(train, C.hard_case_cap(train, 0.3))


def selected_hard_cases(spark, folder):
    columns = ["case_id", "document_type", "field_name", "field_group", "split", "crop_path", "quality"]
    crops, hard = V.crops(spark, folder), V.hard_cases(spark, folder)
    picked = C.selected_hard_cases(crops.select(*columns), hard.select(*columns, "augmentation_type", "base_crop_path"), ratio=0.3)
    return picked.select("field_group", "document_type", "augmentation_type", "base_crop_path", "crop_path")


def training_rows(spark, folder):
    columns = ["case_id", "document_type", "field_name", "field_group", "source_path", "crop_path", "split", "quality"]
    crops, hard = V.crops(spark, folder), V.hard_cases(spark, folder)
    rows = C.training_set(crops.select(*columns), hard.select(*columns, "augmentation_type", "base_crop_path"))
    return rows.groupBy("field_group", "split", "source_type", "document_type").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("source_path").alias("sources"))


def data_profile(spark, folder):
    p = training_summary(V.crops(spark, folder), V.hard_cases(spark, folder))
    return p.select(
        "field_group", "train_count", "val_count", "train_base_count", "train_hard_count", "train_source_count", "val_source_count", "train_variant_count",
        "character_count", "hard_case_train_ratio", "filtered_hard_case_train_count", "filtered_stale_hard_case_count",
        F.array_join(F.transform(F.map_entries("train_by_document_type"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("train_by_document_type"),
        F.array_join(F.transform(F.map_entries("train_by_variant"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("train_by_variant"),
    )


PROFILE_SELECT = """, p AS (SELECT field_group, count(*) FILTER (split = 'train') AS train_count, count(*) FILTER (split = 'val') AS val_count, count(*) FILTER (split = 'train' AND augmentation_type IS NULL) AS train_base_count,
  count(*) FILTER (split = 'train' AND augmentation_type IS NOT NULL) AS train_hard_count, count(DISTINCT source_path) FILTER (split = 'train') AS train_source_count, count(DISTINCT source_path) FILTER (split = 'val') AS val_source_count,
  count(DISTINCT augmentation_type) FILTER (split = 'train') AS train_variant_count FROM ts GROUP BY ALL),
ch AS (SELECT field_group, count(DISTINCT c) AS character_count FROM (SELECT field_group, unnest(string_split(text, '')) AS c FROM (SELECT DISTINCT field_group, text FROM ts)) WHERE c <> '' GROUP BY ALL),
dt AS (SELECT field_group, string_agg(document_type || '=' || n, ',' ORDER BY document_type) AS d FROM (SELECT field_group, document_type, count(*) AS n FROM ts WHERE split = 'train' GROUP BY ALL) GROUP BY ALL),
va AS (SELECT field_group, string_agg(augmentation_type || '=' || n, ',' ORDER BY augmentation_type) AS v FROM (SELECT field_group, augmentation_type, count(*) AS n FROM ts WHERE split = 'train' AND augmentation_type IS NOT NULL GROUP BY ALL) GROUP BY ALL),
st AS (SELECT field_group, count(*) AS stale FROM hard_v WHERE NOT (split = 'train' AND accepted) GROUP BY ALL),
full_p AS (SELECT p.*, character_count, round(train_hard_count::DOUBLE / train_count, 4) AS hard_case_train_ratio, cnt.hard_count - train_hard_count AS filtered_hard_case_train_count, coalesce(stale, 0) AS filtered_stale_hard_case_count, d, v
  FROM p JOIN ch USING (field_group) JOIN dt USING (field_group) JOIN va USING (field_group) JOIN cnt USING (field_group) LEFT JOIN st USING (field_group))"""

WARN_SQL = """, w AS (SELECT *, list_filter([CASE WHEN train_count = 0 THEN 'no_train_samples' WHEN train_count < 20 THEN 'low_train_sample_count' END, CASE WHEN val_count = 0 THEN 'no_val_samples' END,
   CASE WHEN hard_case_train_ratio > 0.5 THEN 'hard_case_dominant_train_split' END, CASE WHEN filtered_hard_case_train_count > 0 THEN 'hard_case_train_capped' END, CASE WHEN filtered_stale_hard_case_count > 0 THEN 'stale_hard_cases_filtered' END,
   CASE WHEN train_hard_count > 0 AND train_variant_count < 2 THEN 'low_hard_case_variant_diversity' END, CASE WHEN val_source_count < 2 THEN 'low_val_source_diversity' END], lambda x: x IS NOT NULL) AS ws FROM full_p)"""


def profile_warnings(spark, folder):
    p = training_summary(V.crops(spark, folder), V.hard_cases(spark, folder), ratio=0.3)
    return p.select("field_group", F.array_join("warnings", ",").alias("warnings"))


def readiness(spark, folder):
    p = training_summary(V.crops(spark, folder), V.hard_cases(spark, folder), ratio=0.3)
    return p.select("field_group", F.col("training_readiness_status").alias("status"), F.array_join("blocking_warnings", ",").alias("blocking"), F.array_join("advisory_warnings", ",").alias("advisory"), "ready_for_execution")


READY_SQL = """, parts AS (SELECT field_group, list_filter(ws, lambda x: starts_with(x, 'no_')) AS b, list_filter(ws, lambda x: NOT starts_with(x, 'no_')) AS a FROM w)
SELECT field_group, CASE WHEN len(b) > 0 THEN 'blocked' WHEN len(a) > 0 THEN 'review_required' ELSE 'ready' END AS status, coalesce(array_to_string(b, ','), '') AS blocking,
  coalesce(array_to_string(a, ','), '') AS advisory, len(b) = 0 AS ready_for_execution FROM parts"""


def augment_plan(spark, folder):
    p = V.table(spark, folder, "orders")
    k = F.col("o_orderkey")
    kind = F.when(k % 4 == 0, K.APOSTILLE).when(k % 4 == 1, K.RESIDENCY).when(k % 4 == 2, K.WITHHOLDING).otherwise("invoice")
    split = F.when(k % 5 == 0, "val").otherwise("train")
    files = p.select(F.concat(F.lit("data/raw/"), split, F.lit("/"), kind, F.lit("/page_"), k, F.lit(".tif")).alias("path"), kind.alias("document_type"), split.alias("split"))
    rows = C.augment_plan(files, copies=3)
    return rows.select("path", "document_type", "source_path", *K.AUGMENTATION_PARAMETERS)


def _augment_sql():
    def pick(name):
        cases = " ".join(
            f"WHEN '{kind}' THEN [{', '.join(str(float(v)) for v in lists[name])}][1 + {draw(repr(str(K.AUGMENTATION_SEED)), 'source_path', 'copy::VARCHAR', repr(name))} % {len(lists[name])}]::DOUBLE"
            for kind, lists in K.AUGMENTATION.items())
        return f"CASE document_type {cases} END AS {name}"

    return f"""WITH f AS (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'apostille' WHEN 1 THEN 'residency_certificate' WHEN 2 THEN 'withholding_tax_form' END AS document_type FROM orders WHERE o_orderkey % 4 <> 3 AND o_orderkey % 5 <> 0),
g AS (SELECT *, 'data/raw/train/' || document_type || '/page_' || k || '.tif' AS source_path, copy FROM f, generate_series(0, 2) c(copy))
SELECT 'augmented/train/' || document_type || '/page_' || k || '__aug_0' || copy || '.jpg' AS path, document_type, source_path, {', '.join(pick(n) for n in K.AUGMENTATION_PARAMETERS)} FROM g"""


def synthetic_dates(spark, folder):
    crops = V.crops(spark, folder)
    named = crops.withColumn("field_name", F.when(F.col("field_group") != "date", F.col("field_name")).when(F.length("text") % 3 == 0, "issue_date").when(F.length("text") % 3 == 1, "issued_on").otherwise("signature_date"))
    merged = C.replace_synthetic(V.hard_cases(spark, folder), C.synthetic_dates(named, copies=2))
    return merged.filter("augmentation_type = 'synthetic_date'").select("field_name", "text", "crop_path", "base_crop_path")


def _dates_sql():
    def d(what, size):
        return draw(repr(str(K.DATE_SEED)), "base_crop_path", "copy::VARCHAR", repr(what)) + f" % {size}"

    months = "[" + ", ".join(f"'{m}'" for m in K.MONTHS) + "]"
    return _v(("crops_v",), f"""SELECT field_name, CASE field_name WHEN 'issued_on' THEN d || CASE WHEN d BETWEEN 10 AND 20 THEN 'TH' WHEN d % 10 = 1 THEN 'ST' WHEN d % 10 = 2 THEN 'ND' WHEN d % 10 = 3 THEN 'RD' ELSE 'TH' END || ' DAY OF ' || upper({months}[m]) || ', ' || y
   WHEN 'signature_date' THEN CASE WHEN s < 60 THEN y || '-' || lpad(m::VARCHAR, 2, '0') || '-' || lpad(d::VARCHAR, 2, '0') WHEN s < 85 THEN y || '.' || lpad(m::VARCHAR, 2, '0') || '.' || lpad(d::VARCHAR, 2, '0')
     ELSE y || '년 ' || lpad(m::VARCHAR, 2, '0') || '월 ' || lpad(d::VARCHAR, 2, '0') || '일' END ELSE {months}[m] || ' ' || d || ', ' || y END AS text,
   'hard_cases/date/synthetic_date/' || replace(base_crop_path, '.png', '') || '__synthetic_date_0' || copy || '.png' AS crop_path, base_crop_path
  FROM (SELECT *, 2014 + {d('year', 16)} AS y, 1 + {d('month', 12)} AS m, 1 + {d('day', 28)} AS d, {d('format', 100)} AS s FROM (
    SELECT crop_path AS base_crop_path, copy, CASE length(text) % 3 WHEN 0 THEN 'issue_date' WHEN 1 THEN 'issued_on' ELSE 'signature_date' END AS field_name FROM crops_v, generate_series(0, 1) c(copy)
    WHERE field_group = 'date' AND split = 'train' AND accepted))""")


def regression_cases(spark, folder):
    rows = C.regression_cases(V.table(spark, folder, "customer").select((F.col("c_custkey") + 1).alias("index")))
    fields = F.array_join(F.transform(F.array_sort(F.map_entries("expected_fields")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    checks = F.array_join(F.array_sort(F.map_keys("expected_quality_checks")), ";")
    return rows.select("case_id", "document_type", "source_path", "dataset_split", "expected_status", fields.alias("fields"), checks.alias("checks"), "synthetic")


REGRESSION_SQL = """WITH n AS (SELECT c_custkey + 1 AS i, lpad((c_custkey + 1)::VARCHAR, greatest(3, length((c_custkey + 1)::VARCHAR))::INT, '0') AS p, substr('ABCDEFGHIJKLMNOPQRST', (c_custkey % 20)::INT + 1, 1) AS m FROM customer),
t AS (SELECT *, (100 + i)::VARCHAR || '-' || (10 + i % 80) || '-' || CASE WHEN 1000 + i < 1000 THEN '0' ELSE '' END || (1000 + i) AS rt, (200 + i)::VARCHAR || '-' || (20 + i % 70) || '-' || (2000 + i) AS wt FROM n),
u AS (SELECT 'residency_regression_' || p AS case_id, 'residency_certificate' AS document_type, 'issue_date=January ' || (1 + i % 28) || ', 2026;residency_country=United States of America;residency_country_code=US;tax_year=20' || (10 + i % 10) || ';taxpayer_name=Sample ' || i || ' User;tin=' || rt AS fields, 'seal_present;signature_present' AS checks FROM t
 UNION ALL SELECT 'withholding_regression_' || p, 'withholding_tax_form', 'address=' || i || ' Main Street Suite ' || i || ' New York NY 10001 United States of America;applicant_name=SAMPLE' || i || ' ' || m || ' USER;dividend_tax_rate=15%;first_name=SAMPLE' || i || ';last_name=USER;middle_name=' || m || ';residency_country=United States of America;residency_country_code=US;signature_date=2026-01-' || lpad((1 + i % 28)::VARCHAR, 2, '0') || ';tin=' || wt, 'all_no_boxes_checked;signature_present' FROM t
 UNION ALL SELECT 'apostille_regression_' || p, 'apostille', 'certificate_number=' || (5000 + i) || ';issued_at=Capital City, Sample State ' || i || ';issued_on=' || (1 + i % 28) || 'TH DAY OF APRIL, 202' || (i % 10) || ';issuing_authority=Secretary of State State of Sample;issuing_country=UNITED STATES OF AMERICA;seal_owner=COUNTY OF SAMPLE, STATE OF SAMPLE;signed_by=NOTARY SAMPLE ' || i || ';signer_capacity=NOTARY PUBLIC', 'seal_present;signature_present' FROM t)
SELECT case_id, document_type, 'synthetic://' || document_type || '/' || case_id AS source_path, 'synthetic_regression' AS dataset_split, 'pass' AS expected_status, fields, checks, TRUE AS synthetic FROM u"""


def synthetic_labels(spark, folder):
    rows = C.synthetic_labels(V.table(spark, folder, "orders").select((F.col("o_orderkey") + 1).alias("index")))
    return rows.select("case_id", "document_type", "expected_status", *[F.col("fields")[n].alias(n) for n in ("first_name", "tin", "address", "dividend_tax_rate")])


def _label_sql():
    def d(what, low, high):
        return f"({draw(repr(str(K.LABEL_SEED)), 'i::VARCHAR', repr(what))} % {high - low + 1} + {low})"

    return f"""SELECT 'synthetic_' || lpad(i::VARCHAR, greatest(3, length(i::VARCHAR))::INT, '0') AS case_id, 'withholding_tax_form' AS document_type, 'pass' AS expected_status, 'Sample' || i AS first_name,
      {d('prefix', 100, 999)} || '-' || {d('middle', 10, 99)} || '-' || {d('suffix', 1000, 9999)} AS tin, i || ' Main Street' AS address, '15%' AS dividend_tax_rate FROM (SELECT o_orderkey + 1 AS i FROM orders)"""


QUERIES = [
    Query("C1_crop_manifest", crop_manifest, CROP_SQL + """SELECT case_id, document_type, template_id, field_name, field_group, text, split, source_path,
      'field_crops/' || split || '/' || field_group || '/' || field_name || '/' || case_id || '__' || field_name || '.png' AS crop_path, box_left, box_top, box_right, box_bottom FROM g WHERE box_left < box_right AND box_top < box_bottom"""),
    Query("C1_invalid_boxes", invalid_boxes, CROP_SQL + "SELECT 'invalid_region_box' AS skip_reason, count(*) AS rows FROM g WHERE NOT (box_left < box_right AND box_top < box_bottom)"),
    Query("C2_crop_summary", crop_summary, SUMMARY_SQL),
    Query("C3_hard_case_plan", hard_case_plan, PLAN_SQL),
    Query("C4_donors", donors, DONOR_SQL),
    Query("C5_current_hard_cases", current_hard_cases, _v(("hard_v",), "SELECT field_group, augmentation_type, split, count(*) AS rows FROM hard_v WHERE split = 'train' AND accepted GROUP BY ALL")),
    Query("C5_stale_hard_cases", stale_hard_cases, _v(("hard_v",), "SELECT field_group, count(*) AS stale FROM hard_v WHERE NOT (split = 'train' AND accepted) GROUP BY ALL")),
    Query("C6_hard_case_status", hard_case_status, STATUS_SQL),
    Query("C7_hard_case_caps", hard_case_caps, _train_sql("SELECT field_group, base_count, hard_count, variant_count, allowed, FALSE AS floor_applied, 'base_document_balance' AS strategy, hard_count > allowed AS capped FROM cap", 0.3)),
    Query("C8_document_quotas", document_quotas, _train_sql("SELECT field_group, document_type, base, available, quota FROM quo", 0.3)),
    Query("C9_selected_hard_cases", selected_hard_cases, _train_sql("SELECT field_group, document_type, augmentation_type, base_crop_path, crop_path FROM chosen", 0.3)),
    Query("C10_training_rows", training_rows, _train_sql("SELECT field_group, split, CASE WHEN augmentation_type IS NULL THEN 'base' ELSE 'hard_case' END AS source_type, document_type, count(*) AS rows, count(DISTINCT source_path) AS sources FROM ts GROUP BY ALL")),
    Query("C11_data_profile", data_profile, _train_sql(PROFILE_SELECT + """SELECT field_group, train_count, val_count, train_base_count, train_hard_count, train_source_count, val_source_count, train_variant_count, character_count, hard_case_train_ratio,
      filtered_hard_case_train_count, filtered_stale_hard_case_count, d AS train_by_document_type, v AS train_by_variant FROM full_p""")),
    Query("C12_warnings", profile_warnings, _train_sql(PROFILE_SELECT + WARN_SQL + "SELECT field_group, coalesce(array_to_string(ws, ','), '') AS warnings FROM w", 0.3)),
    Query("C13_readiness", readiness, _train_sql(PROFILE_SELECT + WARN_SQL + READY_SQL, 0.3)),
    Query("C14_augment_plan", augment_plan, _augment_sql()),
    Query("C15_synthetic_dates", synthetic_dates, _dates_sql()),
    Query("C16_regression_cases", regression_cases, REGRESSION_SQL),
    Query("C17_synthetic_labels", synthetic_labels, _label_sql()),
]
