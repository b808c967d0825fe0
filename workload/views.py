"""Input views over the test tables.

The SQL below runs unchanged on Spark and on the checking engine; ``{table}`` marks a base table.
Views stand for the files of a document review: people hold papers, line items hold crops,
documents hold sample files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.functions.text import literal_array

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

_TEXT = "VARCHAR(400)"


def _t(expr: str) -> str:
    return f"CAST({expr} AS {_TEXT})"


NULL_TEXT = f"CAST(NULL AS {_TEXT})"
NULL_FLAG = "CAST(NULL AS BOOLEAN)"

PEOPLE = f"""
SELECT c_custkey AS k,
       concat('case_', lpad({_t('c_custkey')}, 8, '0')) AS case_id,
       upper(replace(c_name, '#', ' ')) AS full_name,
       translate({_t('c_custkey')}, '0123456789', 'ABCDEFGHIJ') AS code,
       concat(lpad({_t('100 + c_custkey % 900')}, 3, '0'), '-', lpad({_t('10 + c_custkey % 80')}, 2, '0'), '-',
              lpad({_t('1000 + c_custkey % 9000')}, 4, '0')) AS tin,
       concat('January ', {_t('1 + c_custkey % 28')}, ', 2026') AS issue_date,
       concat('sample_data/src_', {_t('c_custkey % 97')}, '.png') AS source_path
FROM {{customer}}"""

EXPECTED = """
SELECT case_id, k, 'residency_certificate' AS document_type, 'taxpayer_name' AS field_name, full_name AS expected FROM people_v
UNION ALL SELECT case_id, k, 'residency_certificate', 'tin', tin FROM people_v
UNION ALL SELECT case_id, k, 'residency_certificate', 'issue_date', issue_date FROM people_v
UNION ALL SELECT case_id, k, 'withholding_tax_form', 'tin', tin FROM people_v
UNION ALL SELECT case_id, k, 'withholding_tax_form', 'applicant_name', full_name FROM people_v"""

ACTUAL = """
SELECT 'b' AS run, case_id, document_type, field_name,
       CASE WHEN k % 5 = 0 THEN replace(expected, '0', 'O') WHEN k % 7 = 0 THEN NULL ELSE expected END AS actual
FROM expected_v WHERE k % 10 <> 3
UNION ALL
SELECT 'c', case_id, document_type, field_name,
       CASE WHEN k % 6 = 0 THEN replace(expected, '1', 'I') WHEN k % 11 = 0 THEN concat(expected, ' X') ELSE expected END
FROM expected_v WHERE k % 15 <> 4"""

# recognised text of the three papers of a person
PAGE_TEXT = f"""
SELECT case_id, k, 'residency_certificate' AS document_type, source_path,
       concat('DEPARTMENT OF THE TREASURY INTERNAL REVENUE SERVICE Date: ', issue_date, ' Taxpayer: SAMPLE Q.', code,
              ' TIN: ', tin, ' Tax Year: 2026 I certify that the above-named taxpayer is a resident of the ',
              'United States of America for purposes of U.S. taxation.') AS raw_text
FROM people_v
UNION ALL
SELECT case_id, k, 'withholding_tax_form', replace(source_path, '.png', '_form.png'),
       concat('국내원천소득 제한세율 적용신청서(비거주자용) (Last Name) ', code, ' (First Name) SAMPLE (Middle Name) Q 주소 1',
              lpad({_t('k % 1000')}, 3, '0'), ' Harbor Street, Unit 12, Portland, OR 97201, United States of America 납세자번호 ',
              tin, CASE WHEN k % 9 = 0 THEN ' ' ELSE ' 거주지국 United States of America 거주지국코드 US' END,
              ' 배당소득 세율 ', CASE WHEN k % 10 = 0 THEN '10' ELSE '15' END, ' % 2026년 0', {_t('1 + k % 9')}, '월 ',
              {_t('1 + k % 28')}, '일 신청인 ', CASE WHEN k % 8 = 0 THEN concat('SAMPLE ', code) ELSE concat('SAMPLE Q. ', code) END,
              ' (서명 또는 인)')
FROM people_v
UNION ALL
SELECT case_id, k, 'apostille', replace(source_path, '.png', '_apostille.jpg'),
       concat('APOSTILLE (Convention de La Haye du 5 octobre 1961) 1. Country: ',
              CASE WHEN k % 6 = 0 THEN 'United  States of_America' ELSE 'UNITED STATES OF AMERICA' END,
              ' 2. This Public Document has been signed by JANE ', code,
              ' 3. acting in the capacity of NOTARY PUBLIC 12 4. bears the seal', CASE WHEN k % 6 = 1 THEN '' ELSE '/stamp' END, ' of COUNTY OF ', code, ' CERTIFIED 5. at ',
              CASE k % 3 WHEN 0 THEN 'Raleigh, North Carolina' WHEN 1 THEN 'Lansing, Michigan' ELSE 'Los Angeles, California' END,
              ' 6. the ', {_t('1 + k % 28')}, 'TH DAY OF APRIL', CASE WHEN k % 4 = 0 THEN '' ELSE ', ' END, '2014 7. by ',
              CASE k % 3 WHEN 0 THEN 'Secretary of State, State of North Carolina' WHEN 1 THEN 'Secretary of StateState of Michigan'
                         ELSE 'Deputy Secretary of State, State of California' END,
              CASE WHEN k % 7 = 0 THEN ' 8. No.' ELSE concat(' 8. No. ', {_t('5000 + k')}) END, ' 9. Seal 10. Signature')
FROM people_v"""

_DOC_TEXTS = ("taxpayer_name", "tin", "tax_year", "issue_date", "residency_country", "residency_country_code", "first_name",
              "last_name", "middle_name", "address", "dividend_tax_rate", "signature_date", "applicant_name",
              "issuing_country", "signed_by", "signer_capacity", "seal_owner", "issued_at", "issued_on", "issuing_authority",
              "certificate_number")
_DOC_FLAGS = ("has_certification_text", "has_apostille_heading", "seal_present", "signature_present", "all_no_boxes_checked",
              "blurry", "low_ocr_confidence")


def _doc(kind: str, position: str, where: str, values: dict[str, str]) -> str:
    texts = ", ".join(f"{values.get(c, NULL_TEXT)} AS {c}" for c in _DOC_TEXTS)
    flags = ", ".join(f"{values.get(c, NULL_FLAG)} AS {c}" for c in _DOC_FLAGS)
    return f"SELECT case_id, k, {position} AS position, '{kind}' AS document_type, source_path, {texts}, {flags} FROM people_v WHERE {where}"


_US = "'United States of America'"
DOCS = "\nUNION ALL\n".join([
    _doc("residency_certificate", "0", "k % 40 <> 1", {
        "taxpayer_name": "CASE WHEN k % 17 = 0 THEN NULL ELSE concat('SAMPLE ', code) END",
        "tin": "CASE WHEN k % 50 = 0 THEN replace(tin, '-', '') ELSE tin END",
        "tax_year": "CASE WHEN k % 19 = 0 THEN '' ELSE '2026' END", "issue_date": "issue_date",
        "residency_country": f"CASE WHEN k % 23 = 0 THEN 'Canada' ELSE {_US} END",
        "residency_country_code": "CASE WHEN k % 23 = 0 THEN 'CA' ELSE 'US' END",
        "has_certification_text": "k % 29 <> 0", "seal_present": "k % 13 <> 0",
        "signature_present": "CASE WHEN k % 31 = 0 THEN NULL ELSE k % 43 <> 0 END", "blurry": "k % 37 = 0",
        "low_ocr_confidence": "CASE WHEN k % 41 = 0 THEN TRUE ELSE NULL END",
    }),
    _doc("residency_certificate", "3", "k % 7 = 0", {
        "taxpayer_name": "concat('Sample ', code)", "tin": "tin", "tax_year": "'2025'", "issue_date": "issue_date",
        "residency_country": _US, "residency_country_code": "'US'", "has_certification_text": "TRUE",
        "seal_present": "TRUE", "signature_present": "TRUE", "blurry": "FALSE",
    }),
    _doc("withholding_tax_form", "1", "k % 3 <> 2", {
        "first_name": "'SAMPLE'", "last_name": "CASE WHEN k % 26 = 0 THEN 'OTHER' WHEN k % 27 = 0 THEN NULL ELSE code END",
        "middle_name": "CASE WHEN k % 2 = 0 THEN '' ELSE NULL END",
        "tin": "CASE WHEN k % 22 = 0 THEN '999-99-9999' ELSE concat(' ', tin, ' ') END",
        "address": "CASE WHEN k % 33 = 0 THEN NULL ELSE concat(code, ' Main Street') END",
        "residency_country": f"CASE WHEN k % 21 = 0 THEN 'USA' ELSE {_US} END", "residency_country_code": "'US'",
        "dividend_tax_rate": "CASE WHEN k % 15 = 0 THEN '10%' ELSE '15%' END",
        "signature_date": "CASE WHEN k % 35 = 0 THEN NULL ELSE '2026-01-05' END", "applicant_name": "concat('SAMPLE ', code)",
        "all_no_boxes_checked": "k % 39 <> 0", "signature_present": "k % 45 <> 0", "blurry": "FALSE",
    }),
    _doc("apostille", "2", "k % 2 = 0", {
        "issuing_country": "'UNITED STATES OF AMERICA'", "signed_by": "CASE WHEN k % 16 = 0 THEN NULL ELSE concat('JANE ', code) END",
        "signer_capacity": "'NOTARY PUBLIC'", "seal_owner": "concat('COUNTY OF ', code)", "issued_at": "'Raleigh'",
        "issued_on": "CASE WHEN k % 12 = 0 THEN '10TH DAY OF APRI, 2014' WHEN k % 14 = 0 THEN 'april 2014' ELSE '10TH DAY OF APRIL, 2014' END",
        "issuing_authority": "'Secretary of State'", "certificate_number": "CASE WHEN k % 18 = 0 THEN '' ELSE '5' END",
        "has_apostille_heading": "k % 46 <> 0", "seal_present": "TRUE", "signature_present": "k % 34 <> 0", "blurry": "FALSE",
    }),
])

CROPS = f"""
SELECT concat('case_', {_t('l_orderkey')}) AS case_id,
       CASE l_returnflag WHEN 'A' THEN 'apostille' WHEN 'N' THEN 'residency_certificate' ELSE 'withholding_tax_form' END AS document_type,
       CASE l_linenumber % 5 WHEN 0 THEN 'tin' WHEN 1 THEN 'taxpayer_name' WHEN 2 THEN 'issue_date' WHEN 3 THEN 'address' ELSE 'remarks' END AS field_name,
       CASE l_linenumber % 5 WHEN 0 THEN 'numeric_tin_code' WHEN 2 THEN 'date' WHEN 1 THEN 'english_name_org' WHEN 3 THEN 'english_name_org'
            ELSE 'korean_mixed_form' END AS field_group,
       p_name AS text,
       concat('src_', {_t('l_suppkey')}, '.png') AS source_path,
       concat('crop_', {_t('l_orderkey')}, '_', {_t('l_linenumber')}, '_', {_t('l_partkey')}, '_', {_t('l_suppkey')}, '_',
              {_t('CAST(l_quantity AS INT)')}, '_', {_t('CAST(round(l_extendedprice * 100) AS BIGINT)')}, '.png') AS crop_path,
       l_discount < 0.09 AS accepted,
       CASE WHEN l_discount < 0.09 THEN NULL WHEN l_tax < 0.03 THEN 'low_contrast' WHEN l_tax < 0.06 THEN 'dense_edge_content' ELSE 'too_narrow' END AS flag,
       CASE WHEN l_suppkey % 5 = 0 THEN 'val' ELSE 'train' END AS split,
       CAST(l_quantity AS INT) AS quantity
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey"""

COVERAGE = f"""
SELECT d.doc_id, concat('sample_data/', d.source, '/', {_t('d.doc_id')}) AS sample_path, d.lang AS lang,
       CASE d.doc_id % 3 WHEN 0 THEN 'apostille' WHEN 1 THEN 'residency_certificate' ELSE 'withholding_tax_form' END AS document_type,
       CASE d.doc_id % 4 WHEN 0 THEN 'train' WHEN 1 THEN 'val' WHEN 2 THEN 'test' ELSE NULL END AS split,
       l.doc_id IS NOT NULL AS labelled, coalesce(l.quality = 1, FALSE) AS evaluated,
       l.doc_id IS NULL AND d.doc_id % 7 = 0 AS pending
FROM {{documents}} d LEFT JOIN {{labels}} l ON d.doc_id = l.doc_id"""

# the hard cases of the crops: every variant of a train crop, some of them left over from old crops
HARD = """
SELECT case_id, document_type, field_name, field_group, text, source_path, split, accepted, flag, crop_path AS base_crop_path,
       variant AS augmentation_type, concat(replace(crop_path, '.png', ''), '__', variant, '.png') AS crop_path
FROM (SELECT *, 'rotate' AS variant FROM crops_v WHERE field_group <> 'korean_mixed_form'
      UNION ALL SELECT *, 'low_res' FROM crops_v
      UNION ALL SELECT *, 'left_clip' FROM crops_v WHERE field_group <> 'date') v
WHERE split = 'train' OR quantity > 45"""

VIEWS = {
    "people_v": (PEOPLE, ()), "expected_v": (EXPECTED, ("people_v",)), "actual_v": (ACTUAL, ("expected_v",)),
    "page_text_v": (PAGE_TEXT, ("people_v",)), "docs_v": (DOCS, ("people_v",)), "crops_v": (CROPS, ()),
    "coverage_v": (COVERAGE, ()), "hard_v": (HARD, ("crops_v",)),
}


def _ordered(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        _ordered(VIEWS[name][1], seen)
        if name not in seen:
            seen.append(name)
    return seen


def with_views(names: tuple[str, ...] | list[str], rest: str = "") -> str:
    """``WITH`` clause defining the views (and what they need), to put before a query."""
    parts = [f"{name} AS ({VIEWS[name][0]})" for name in _ordered(tuple(names), [])]
    return "WITH " + ",\n".join(parts) + (",\n" + rest if rest else "\n")


def plain(sql: str) -> str:
    """SQL for the checking engine, where the tables are registered under their names."""
    for table in TABLES:
        sql = sql.replace("{" + table + "}", table)
    return sql


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    sql = with_views((name,)) + f"SELECT * FROM {name}"
    used = [t for t in TABLES if "{" + t + "}" in sql]
    return spark.sql(sql, **{t: table(spark, folder, t) for t in used})


# --- nested forms, built inside each row --------------------------------------------

def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Extracted papers: field map by type and quality checks."""
    rows = view(spark, folder, "docs_v")
    fields = F.lit(None).cast("map<string,string>")
    for kind, names in ((K.RESIDENCY, K.RESIDENCY_FIELDS), (K.WITHHOLDING, K.WITHHOLDING_FIELDS), (K.APOSTILLE, K.APOSTILLE_FIELDS)):
        fields = F.when(
            F.col("document_type") == kind, F.map_from_arrays(literal_array(names), F.array(*[F.col(n) for n in names]))
        ).otherwise(fields)
    return rows.select(
        "case_id", "k", "position", "document_type", "source_path", fields.alias("fields"),
        F.struct(*_DOC_FLAGS).alias("quality_checks"),
    )


def expected(spark: SparkSession, folder: str) -> DataFrame:
    """Expected cases, one row per case and type, with their field map."""
    people = view(spark, folder, "people_v")
    residency = F.struct(F.lit(K.RESIDENCY).alias("document_type"), F.create_map(
        F.lit("taxpayer_name"), F.col("full_name"), F.lit("tin"), F.col("tin"), F.lit("issue_date"), F.col("issue_date")
    ).alias("expected_fields"))
    withholding = F.struct(F.lit(K.WITHHOLDING).alias("document_type"), F.create_map(
        F.lit("tin"), F.col("tin"), F.lit("applicant_name"), F.col("full_name")
    ).alias("expected_fields"))
    return people.select("case_id", "k", F.explode(F.array(residency, withholding)).alias("e")).select("case_id", "k", "e.*")


def run_results(spark: SparkSession, folder: str, run: str) -> DataFrame:
    """Run results of one of two runs: one row per case, papers nested."""
    people = view(spark, folder, "people_v")
    k = F.col("k")

    def noisy(col):
        if run == "b":
            return F.when(k % 5 == 0, F.replace(col, F.lit("0"), F.lit("O"))).when(k % 7 != 0, col)
        return F.when(k % 6 == 0, F.replace(col, F.lit("1"), F.lit("I"))).when(k % 11 == 0, F.concat(col, F.lit(" X"))).otherwise(col)

    def paper(kind, **fields):
        pairs = [part for name, value in fields.items() for part in (F.lit(name), noisy(value))]
        return F.struct(F.lit(kind).alias("document_type"), F.create_map(*pairs).alias("fields"), F.struct(
            *[(k % (3 + i) != 0).alias(f) for i, f in enumerate(
                ("has_certification_text", "has_irs_heading", "has_apostille_heading", "contains_non_resident_heading",
                 "seal_present", "signature_present", "all_no_boxes_checked", "blurry", "low_ocr_confidence"))]
        ).alias("quality_checks"))

    papers = F.array(
        paper(K.RESIDENCY, taxpayer_name=F.col("full_name"), tin=F.col("tin"), issue_date=F.col("issue_date")),
        paper(K.WITHHOLDING, tin=F.col("tin"), applicant_name=F.col("full_name")),
    )
    codes = F.filter(F.array(
        F.when(k % 4 == 0, "required_tin_invalid"), F.when(k % 6 == 0, "required_name_missing")
    ), lambda c: c.isNotNull())
    review = F.struct(
        F.when(F.size(codes) > 0, "reject").otherwise("pass").alias("status"),
        F.transform(codes, lambda c: F.struct(c.alias("code"))).alias("findings"),
        F.struct((k % 8 != 0).alias("matched"), F.lit(None).cast("string").alias("reason")).alias("cross_check"),
    )
    kept = people.filter((k % 10 != 3) if run == "b" else (k % 15 != 4))
    return kept.select("case_id", papers.alias("extracted_documents"), review.alias("review_result"))


def crops(spark: SparkSession, folder: str) -> DataFrame:
    """Crop manifest rows with their quality record."""
    rows = view(spark, folder, "crops_v")
    return rows.select(
        "case_id", "document_type", "field_name", "field_group", "text", "source_path", "crop_path", "split",
        _quality().alias("quality"),
    )


def _quality():
    return F.struct(
        F.col("accepted").alias("accepted"), F.array_compact(F.array("flag")).alias("quality_flags"),
        (F.col("accepted") & F.col("text").contains("ring")).alias("salvage_applied"),
    )


def hard_cases(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of ``hard_v``, whose variants are fanned out of one scan of the crops."""
    group = F.col("field_group")
    variants = F.array_compact(F.array(F.when(group != K.DEFAULT_GROUP, "rotate"), F.lit("low_res"), F.when(group != K.DATE_GROUP, "left_clip")))
    fanned = view(spark, folder, "crops_v").where("split = 'train' OR quantity > 45").withColumn("augmentation_type", F.explode(variants))
    rows = fanned.withColumnsRenamed({"crop_path": "base_crop_path"}).withColumn("crop_path", F.concat(
        F.replace("base_crop_path", F.lit(".png"), F.lit("")), F.lit("__"), "augmentation_type", F.lit(".png")))
    return rows.select(
        "case_id", "document_type", "field_name", "field_group", "text", "source_path", "crop_path", "split",
        _quality().alias("quality"), "augmentation_type", "base_crop_path",
    )


RASTER_8 = {
    "spark": "transform(embedding, x -> least(255, greatest(0, CAST(floor((CAST(x AS DOUBLE) + 0.15D) * 900D) AS INT))))",
    "check": "list_transform(embedding, lambda x: least(255, greatest(0, CAST(floor((CAST(x AS DOUBLE) + 0.15) * 900) AS INT))))",
}


def rasters(spark: SparkSession, folder: str) -> DataFrame:
    """The 64 values of an embedding as an 8 x 8 grey raster."""
    return table(spark, folder, "embeddings").selectExpr(
        "vec_id AS image_id", "8 AS width", "8 AS height", f"{RASTER_8['spark']} AS pixels"
    )


def big_rasters(spark: SparkSession, folder: str) -> DataFrame:
    """32 x 32 crops: every value four times as wide and high, with dark bars at some edges."""
    value = "CASE WHEN image_id % 4 = 0 AND (i % 32 < 4 OR i < 96 OR i % 32 > 29 OR i >= 1000) THEN 40 " \
            "WHEN image_id % 4 = 1 AND i % 32 < 6 THEN 60 WHEN image_id % 4 = 2 THEN small[i div 128 * 8 + i % 32 div 4] " \
            "WHEN image_id % 8 = 3 THEN 250 " \
            "ELSE least(255, 120 + small[i div 128 * 8 + i % 32 div 4]) END"
    small = rasters(spark, folder).withColumnRenamed("pixels", "small")
    return small.selectExpr("image_id", "32 AS width", "32 AS height", f"transform(sequence(0, 1023), i -> {value}) AS pixels")


RASTERS_CHECK = f"""rasters_v AS (SELECT vec_id AS image_id, 8 AS width, 8 AS height, {RASTER_8['check']} AS pixels FROM embeddings)"""
BIG_RASTERS_CHECK = RASTERS_CHECK + """, big_v AS (SELECT image_id, 32 AS width, 32 AS height,
  list_transform(range(0, 1024), lambda i: CASE WHEN image_id % 4 = 0 AND (i % 32 < 4 OR i < 96 OR i % 32 > 29 OR i >= 1000) THEN 40
     WHEN image_id % 4 = 1 AND i % 32 < 6 THEN 60 WHEN image_id % 4 = 2 THEN pixels[1 + (i // 128) * 8 + (i % 32) // 4]
     WHEN image_id % 8 = 3 THEN 250 ELSE least(255, 120 + pixels[1 + (i // 128) * 8 + (i % 32) // 4]) END) AS pixels FROM rasters_v)"""

