"""Predicates, normalisers, page texts and field extraction."""

from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.functions import normalize as N
from paperloom.functions import predicates as P
from paperloom.functions.text import contains_any, find, first_match
from paperloom.operators import curate as C
from paperloom.operators import extract as X
from paperloom.operators import pages as G
from paperloom.operators import templates as T
from paperloom.session import spread
from workload import views as V
from workload.query import Query


def _v(names, select):
    return V.plain(V.with_views(names) + select)


# --- predicates ------------------------------------------------------------------------

def _labels(spark, folder):
    """Orders as label files: some without a source, some with a URL, some of an unknown type."""
    k = F.col("o_orderkey")
    return V.table(spark, folder, "orders").select(
        F.concat(F.lit("case_"), k).alias("case_id"), k.alias("k"),
        F.when(k % 11 == 0, "invoice").when(k % 3 == 0, K.APOSTILLE).when(k % 3 == 1, K.RESIDENCY).otherwise(K.WITHHOLDING).alias("document_type"),
        F.when(k % 13 == 0, F.lit(None)).when(k % 17 == 0, "").when(k % 19 == 0, F.concat(F.lit("s3://x/"), k)).otherwise(
            F.concat(F.lit("scan/src_"), F.col("o_custkey"), F.lit(".png"))
        ).alias("source_path"),
        F.concat(F.lit("labeled/"), k, F.lit("/label.json")).alias("label_path"),
        F.when(k % 7 != 0, F.create_map(
            F.lit("tin"), F.when(k % 5 != 0, F.col("o_orderpriority")), F.lit("issue_date"), F.col("o_orderstatus"),
            F.lit("address"), F.lit("12 Main"), F.lit("signed_by"), F.col("o_orderpriority"), F.lit("issued_on"), F.lit(""), F.lit("remarks"), F.lit("x"),
        )).alias("expected_fields"),
    )


def _files(spark, folder):
    """Customers as scanned files; some cannot be opened, some are very small."""
    k = F.col("c_custkey")
    return V.table(spark, folder, "customer").filter("c_nationkey <> 3").select(
        F.concat(F.lit("scan/src_"), k, F.lit(".png")).alias("path"),
        F.when(F.col("c_nationkey") != 4, F.when(k % 6 == 0, 20).otherwise((400 + k % 300).cast("int"))).alias("width"),
        F.when(F.col("c_nationkey") != 4, F.when(k % 6 == 0, 15).otherwise((500 + k % 200).cast("int"))).alias("height"),
    )


LABELS_SQL = """WITH lab AS (SELECT 'case_' || o_orderkey AS case_id, o_orderkey AS k,
  CASE WHEN o_orderkey % 11 = 0 THEN 'invoice' WHEN o_orderkey % 3 = 0 THEN 'apostille' WHEN o_orderkey % 3 = 1 THEN 'residency_certificate' ELSE 'withholding_tax_form' END AS document_type,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 19 = 0 THEN 's3://x/' || o_orderkey ELSE 'scan/src_' || o_custkey || '.png' END AS source_path,
  o_orderpriority AS prio, o_orderstatus AS st FROM orders),
fil AS (SELECT 'scan/src_' || c_custkey || '.png' AS path, CASE WHEN c_nationkey <> 4 THEN CASE WHEN c_custkey % 6 = 0 THEN 20 ELSE 400 + c_custkey % 300 END END AS width,
  CASE WHEN c_nationkey <> 4 THEN CASE WHEN c_custkey % 6 = 0 THEN 15 ELSE 500 + c_custkey % 200 END END AS height FROM customer WHERE c_nationkey <> 3),
elig AS (SELECT lab.*, width, height, CASE WHEN source_path IS NULL OR source_path = '' THEN 'missing_source_path' WHEN contains(source_path, '://') THEN 'non_file_source'
  WHEN path IS NULL THEN 'source_missing' WHEN document_type = 'invoice' THEN 'document_type_invalid' WHEN k % 7 = 0 THEN 'missing_expected_fields'
  WHEN width IS NULL THEN 'source_unreadable' END AS skip_reason FROM lab LEFT JOIN fil ON path = source_path)
"""


def eligibility(spark, folder):
    rows = C.eligibility(_labels(spark, folder), _files(spark, folder))
    return rows.select("case_id", "document_type", "skip_reason")


def skip_counts(spark, folder):
    return C.skip_counts(C.eligibility(_labels(spark, folder), _files(spark, folder)))


FIELD_LINES = "SELECT CASE l_linenumber WHEN 1 THEN 'taxpayer_name' WHEN 2 THEN 'tin' WHEN 3 THEN 'issued_on' WHEN 4 THEN 'issuing_country' WHEN 5 THEN 'address' WHEN 6 THEN 'tax_year' ELSE 'remarks' END AS field_name FROM lineitem"


def field_groups(spark, folder):
    rows = spark.sql(FIELD_LINES.replace("lineitem", "{lineitem}"), lineitem=V.table(spark, folder, "lineitem"))
    return rows.withColumn("field_group", P.field_group(F.col("field_name"))).groupBy("field_name", "field_group").agg(F.count(F.lit(1)).alias("rows"))


def accepted_split(spark, folder):
    rows = V.crops(spark, folder)
    rows = rows.withColumn("quality", F.when(F.col("field_name") != "address", F.col("quality")))
    good = P.accepted(rows).select(F.lit("accepted").alias("verdict"), "document_type")
    bad = P.rejected(rows).select(F.lit("rejected").alias("verdict"), "document_type")
    return good.unionByName(bad).groupBy("verdict", "document_type").agg(F.count(F.lit(1)).alias("rows"))


def pending_paths(spark, folder):
    k = F.col("c_custkey")
    path = F.when(k % 4 == 0, F.concat(F.lit("data/labeled/pending_review/tin/case_"), k, F.lit("/label.json"))).when(
        k % 4 == 1, F.concat(F.lit("data/labeled/apostille/pending_review/case_"), k, F.lit("/label.json"))
    ).when(k % 4 == 2, F.concat(F.lit("data/labeled/pending_reviews/case_"), k)).otherwise(F.concat(F.lit("elsewhere/pending_review/case_"), k))
    rows = V.table(spark, folder, "customer").select("c_custkey", path.alias("path"))
    return rows.select("c_custkey", P.is_pending(F.col("path"), "data/labeled").alias("pending"))


def masked(spark, folder):
    people = V.view(spark, folder, "people_v")
    nested = people.select(
        "case_id", F.concat(F.lit("tin "), "tin", F.lit(", ein 12-"), F.lpad(F.col("k").cast("string"), 7, "0"), F.lit(".")).alias("note"),
        F.array(F.struct(F.col("tin").alias("value"), F.col("k").alias("number"))).alias("findings"),
        F.create_map(F.lit("tin"), F.col("tin"), F.lit("id"), F.concat(F.lit("9"), F.col("tin"))).alias("fields"),
    )
    rows = P.mask(nested)
    return rows.select("case_id", "note", F.col("findings")[0]["value"].alias("value"), F.col("findings")[0]["number"].alias("number"),
                       F.col("fields")["tin"].alias("tin"), F.col("fields")["id"].alias("id"))


MASK = "regexp_replace(regexp_replace({0}, '\\b\\d{{3}}-\\d{{2}}-\\d{{4}}\\b', '***-**-****', 'g'), '\\b\\d{{2}}-\\d{{7}}\\b', '**-*******', 'g')"


def composed(spark, folder):
    """Decomposed forms of the page texts' words, composed again."""
    pages = V.table(spark, folder, "pages").select("page_id", F.concat("url", F.lit("/été-"), "html").alias("path"))
    return P.with_nfc(pages, "path", "key").select("page_id", "key")


def tin_check(spark, folder):
    d = V.view(spark, folder, "docs_v")
    return d.select("case_id", "position", P.valid_tin(F.col("tin")).alias("valid"))


def date_check(spark, folder):
    d = V.view(spark, folder, "docs_v")
    text = F.coalesce("issued_on", "issue_date", "signature_date")
    return d.select("case_id", "position", P.plausible_date(text).alias("plausible"))


def marker_flags(spark, folder):
    rows = V.view(spark, folder, "page_text_v")
    sets = {"irs": X.IRS_PHRASES, "certified": X.CERTIFICATION_PHRASES, "resident": X.RESIDENT_PHRASES,
            "apostille": X.APOSTILLE_PHRASES, "non_resident": X.NON_RESIDENT_PHRASES}
    return rows.select("case_id", "document_type", *[contains_any(F.col("raw_text"), p).alias(n) for n, p in sets.items()])


def _any(phrases):
    return "(" + " OR ".join(f"contains(lower(raw_text), '{p}')" for p in phrases) + ")"


# --- pages ----------------------------------------------------------------------------

def flattened_lines(spark, folder):
    lines = V.table(spark, folder, "documents").select("doc_id", F.transform(
        F.split("text", "\n"),
        lambda page: F.transform(F.split(page, r"\."), lambda line: F.struct(
            F.array(F.array(F.lit(0.0), F.lit(1.0))).alias("points"), line.alias("text"), (F.length(line) / 100.0).alias("confidence"))),
    ).alias("pages"))
    return G.flatten_lines(lines).select(
        "doc_id", F.col("page_number").cast("bigint").alias("page_number"), "raw_text", F.size("words").cast("bigint").alias("words"),
        F.round(F.aggregate("words", F.lit(0.0), lambda s, w: s + w["confidence"]), 6).alias("confidence"),
    )


FLAT_SQL = """WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS page, generate_subscripts(string_split(text, chr(10)), 1) AS page_number FROM documents),
w AS (SELECT doc_id, page_number, list_filter(list_transform(string_split(page, '.'), lambda s: {'t': regexp_replace(regexp_replace(s, '^\\s+', ''), '\\s+$', ''), 'c': length(s) / 100.0::DOUBLE}), lambda x: x.t <> '') AS ws FROM p)
SELECT doc_id, page_number::BIGINT AS page_number, coalesce(array_to_string(list_transform(ws, lambda x: x.t), chr(10)), '') AS raw_text, len(ws)::BIGINT AS words,
  round(coalesce(list_sum(list_transform(ws, lambda x: x.c)), 0.0)::DOUBLE, 6) AS confidence FROM w"""


def assembled_text(spark, folder):
    pages = V.table(spark, folder, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_number"), F.col("text").alias("raw_text"))
    return G.document_text(pages, ["doc_id"])


ASSEMBLED_SQL = """WITH t AS (SELECT conv_id AS doc_id, string_agg(text, chr(10) ORDER BY turn) FILTER (text <> '') AS raw FROM conversations GROUP BY conv_id),
s AS (SELECT doc_id, regexp_replace(regexp_replace(coalesce(raw, ''), '^[\\s]+', ''), '[\\s]+$', '') AS text FROM t)
SELECT doc_id, text, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS single_line FROM s"""


def words_in_regions(spark, folder):
    e = V.table(spark, folder, "embeddings")
    at = lambda i: F.abs(F.get("embedding", i)).cast("double") * 100
    words = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.struct(
        F.concat(F.lit(" w"), i, F.lit(" ")).alias("text"), F.lit(0.9).alias("confidence"),
        F.array(F.array(at(i * 4), at(i * 4 + 1)), F.array(at(i * 4 + 2), at(i * 4 + 3))).alias("points")))
    template = F.get(F.array(*[F.lit(t[0]) for t in K.TEMPLATES]), (F.col("vec_id") % 5).cast("int"))
    pages = e.select("vec_id", F.lit(1).alias("page_number"), template.alias("template_id"), words.alias("words"))
    regions = F.broadcast(T.template_regions(spark, "ocr"))
    wide = regions.withColumns({"right": F.col("right") + 0.2, "bottom": F.col("bottom") + 0.2})
    return G.region_text(pages, wide, ["vec_id"])


def _values(kind):
    rows = [r for r in K.TEMPLATE_REGIONS if r[1] == kind]
    return ", ".join(f"('{t}', '{n}', {l}::DOUBLE, {top}::DOUBLE, {r}::DOUBLE, {b}::DOUBLE)" for t, _, n, l, top, r, b, _ in rows)


TEMPLATE_CASE = "CASE {0} % 5 " + " ".join(f"WHEN {i} THEN '{t[0]}'" for i, t in enumerate(K.TEMPLATES)) + " END"
REGION_SQL = f"""WITH rules(template_id, name, l, t, r, b) AS (VALUES {_values('ocr')}),
w AS (SELECT vec_id, {TEMPLATE_CASE.format('vec_id')} AS template_id, i, (abs(embedding[4*i+1]::DOUBLE) * 100 + abs(embedding[4*i+3]::DOUBLE) * 100) / 2 AS x,
   (abs(embedding[4*i+2]::DOUBLE) * 100 + abs(embedding[4*i+4]::DOUBLE) * 100) / 2 AS y FROM embeddings, generate_series(0, 15) g(i)),
s AS (SELECT vec_id, (SELECT max(abs(embedding[2*j+1]::DOUBLE)) * 100 FROM generate_series(0, 31) q(j)) AS pw, (SELECT max(abs(embedding[2*j+2]::DOUBLE)) * 100 FROM generate_series(0, 31) q(j)) AS ph FROM embeddings)
SELECT vec_id, name, string_agg('w' || i, ' ' ORDER BY round(y / ph, 3), x / pw) AS raw_text FROM w JOIN s USING (vec_id) JOIN rules USING (template_id)
WHERE x / pw BETWEEN l AND r + 0.2 AND y / ph BETWEEN t AND b + 0.2 GROUP BY ALL"""


def region_boxes(spark, folder):
    files = _files(spark, folder).filter("width IS NOT NULL").withColumn("k", F.regexp_extract("path", r"_(\d+)", 1).cast("bigint"))
    template = F.get(F.array(*[F.lit(t[0]) for t in K.TEMPLATES]), (F.col("k") % 5).cast("int"))
    images = files.select(F.col("k").alias("image_id"), template.alias("template_id"), "width", "height")
    plain = T.region_boxes(images).withColumn("form", F.lit("cut"))
    clamped = T.region_boxes(images, ("quality", "checkbox"), clamp=True).withColumn("form", F.lit("clamped"))
    rows = plain.unionByName(clamped)
    return rows.select("image_id", "form", "name", *[F.col(f"box.{e}").cast("bigint").alias(f"box_{e}") for e in ("left", "top", "right", "bottom")])


def _mark_values():
    rows = [r for r in K.TEMPLATE_REGIONS if r[1] != "ocr"]
    return ", ".join(f"('{t}', '{k}', '{n}', {l}::DOUBLE, {top}::DOUBLE, {r}::DOUBLE, {b}::DOUBLE, {d}::DOUBLE)" for t, k, n, l, top, r, b, d in rows)


BOX_SQL = LABELS_SQL + f""", im AS (SELECT path, width, height, regexp_extract(path, '_([0-9]+)', 1)::BIGINT AS image_id FROM fil WHERE width IS NOT NULL),
t AS (SELECT image_id, width, height, {TEMPLATE_CASE.format('image_id')} AS template_id FROM im),
o(template_id, name, l, t, r, b) AS (VALUES {_values('ocr')}), q(template_id, kind, name, l, t, r, b, d) AS (VALUES {_mark_values()}),
plain AS (SELECT image_id, 'cut' AS form, name, trunc(width * l)::BIGINT AS box_left, trunc(height * o.t)::BIGINT AS box_top, trunc(width * r)::BIGINT AS box_right, trunc(height * b)::BIGINT AS box_bottom FROM t JOIN o USING (template_id)),
cl AS (SELECT image_id, name, width, height, r, b, greatest(0, least(width - 1, trunc(width * l)::BIGINT)) AS x, greatest(0, least(height - 1, trunc(height * q.t)::BIGINT)) AS y FROM t JOIN q USING (template_id))
SELECT * FROM plain WHERE box_left < box_right AND box_top < box_bottom
UNION ALL SELECT image_id, 'clamped', name, x, y, greatest(x + 1, least(width, trunc(width * r)::BIGINT)), greatest(y + 1, least(height, trunc(height * b)::BIGINT)) FROM cl"""


def template_choice(spark, folder):
    rows = V.view(spark, folder, "page_text_v")
    k = F.col("k")
    path = F.when(k % 5 == 0, F.concat(F.lit("Michigan_"), "source_path")).when(k % 5 == 1, F.concat(F.lit("california_"), "source_path")).otherwise(F.col("source_path"))
    noisy = rows.withColumn("source_path", path).withColumn("text", F.when(k % 4 != 0, F.col("raw_text")))
    return T.classify(noisy).select("case_id", "document_type", "template_id")


TEMPLATE_SQL = """SELECT case_id, document_type, CASE document_type WHEN 'residency_certificate' THEN 'residency.irs_standard' WHEN 'withholding_tax_form' THEN 'withholding.non_resident_v1'
  ELSE CASE WHEN nc >= mi AND nc >= ca THEN 'apostille.north_carolina' WHEN mi >= ca THEN 'apostille.michigan' ELSE 'apostille.california' END END AS template_id
FROM (SELECT *, 2 * contains(p, 'california 주2')::INT + 2 * contains(p, 'north carolina')::INT + 3 * contains(x, 'state of north carolina')::INT + 3 * contains(x, 'raleigh, north carolina')::INT AS nc,
   2 * contains(p, 'michigan')::INT + 3 * contains(x, 'state of michigan')::INT + 3 * contains(x, 'lansing, michigan')::INT AS mi,
   2 * contains(p, 'california')::INT + 3 * contains(x, 'state of california')::INT + 3 * contains(x, 'los angeles, california')::INT AS ca
  FROM (SELECT case_id, document_type, lower(CASE k % 5 WHEN 0 THEN 'Michigan_' || source_path WHEN 1 THEN 'california_' || source_path ELSE source_path END) AS p,
     CASE WHEN k % 4 = 0 THEN '' ELSE lower(raw_text) END AS x FROM page_text_v))"""


# --- extraction -----------------------------------------------------------------------

def _texts(spark, folder, kind):
    rows = V.view(spark, folder, "page_text_v").filter(F.col("document_type") == kind)
    k = F.col("k")
    regions = {
        K.RESIDENCY: F.when(k % 14 == 0, F.create_map(F.lit("taxpayer_name"), F.concat(F.lit("Taxpayer: R. "), F.lit("Region TIN: 1")), F.lit("tax_year"), F.lit(" year 2024 "))),
        K.WITHHOLDING: F.when(k % 14 == 0, F.create_map(F.lit("last_name"), F.lit("REGION"), F.lit("first_name"), F.lit("irst"), F.lit("signature_date"), F.lit("t.\n2026\n01\n12\nOL"))),
        K.APOSTILLE: F.when(k % 14 == 0, F.create_map(F.lit("signer_capacity"), F.lit("| Notary_Public |"), F.lit("certificate_number"), F.lit("NO. A-77"))),
    }[kind]
    pages = rows.select("case_id", "k", "document_type", "source_path", F.col("raw_text").alias("text"), F.col("raw_text").alias("single_line"), regions.alias("regions"))
    return T.classify(pages)


def _named(df, names, *more):
    return df.select("case_id", *[F.try_element_at("fields", F.lit(n)).alias(n) for n in names], *more)


def residency_fields(spark, folder):
    return _named(X.extract_residency(_texts(spark, folder, K.RESIDENCY)), K.RESIDENCY_FIELDS, "has_certification_text", "has_irs_heading")


def withholding_fields(spark, folder):
    return _named(X.extract_withholding(_texts(spark, folder, K.WITHHOLDING)), K.WITHHOLDING_FIELDS, "contains_non_resident_heading")


def apostille_fields(spark, folder):
    return _named(X.extract_apostille(_texts(spark, folder, K.APOSTILLE)), K.APOSTILLE_FIELDS, "has_apostille_heading", F.col("filled_item_count").cast("bigint").alias("filled_item_count"))


def _item(n):
    """Numbered item without lookahead."""
    return (f"coalesce(nullif(trim(regexp_extract(raw_text, '{n}\\.?\\s*(.+?)\\s+{n + 1}\\.?\\s', 1)), ''), "
            f"nullif(trim(regexp_extract(raw_text, '{n}\\.?\\s*(.+)$', 1)), ''), '')")


RESIDENCY_SQL = """, t AS (SELECT * FROM page_text_v WHERE document_type = 'residency_certificate'),
x AS (SELECT case_id, k, CASE WHEN k % 14 = 0 THEN 'R. Region' ELSE 'SAMPLE Q. ' || trim(regexp_extract(raw_text, 'Taxpayer: SAMPLE Q\\.([A-J]+) TIN', 1)) END AS taxpayer_name,
  regexp_extract(raw_text, 'TIN: (\\d{3}-\\d{2}-\\d{4})', 1) AS tin, CASE WHEN k % 14 = 0 THEN '2024' ELSE regexp_extract(raw_text, 'Tax Year: (\\d{4})', 1) END AS tax_year,
  regexp_extract(raw_text, 'Date: ([A-Za-z]+ \\d{1,2}, \\d{4})', 1) AS issue_date FROM t)
SELECT case_id, taxpayer_name, tin, tax_year, issue_date, 'United States of America' AS residency_country, 'US' AS residency_country_code, TRUE AS has_certification_text, TRUE AS has_irs_heading FROM x"""

WITHHOLDING_SQL = """, t AS (SELECT *, regexp_extract(raw_text, 'Last Name\\) ([A-J]+) ', 1) AS code FROM page_text_v WHERE document_type = 'withholding_tax_form')
SELECT case_id, 'SAMPLE' AS first_name, CASE WHEN k % 14 = 0 THEN 'REGION' ELSE code END AS last_name, 'Q' AS middle_name,
  regexp_extract(raw_text, '납세자번호 (\\d{3}-\\d{2}-\\d{4})', 1) AS tin,
  regexp_replace(regexp_extract(raw_text, '(1\\d{3} Harbor Street.*?United States of America)', 1), ',', '', 'g') AS address,
  'United States of America' AS residency_country, 'US' AS residency_country_code, regexp_extract(raw_text, '배당소득 세율 (\\d+) %', 1) || '%' AS dividend_tax_rate,
  CASE WHEN k % 14 = 0 THEN '2026-01-12' ELSE regexp_extract(raw_text, '(\\d{4})년', 1) || '-' || lpad(regexp_extract(raw_text, '년 (\\d+)월', 1), 2, '0') || '-' || lpad(regexp_extract(raw_text, '월 (\\d+)일', 1), 2, '0') END AS signature_date,
  CASE WHEN k % 8 = 0 THEN 'SAMPLE ' || code ELSE 'SAMPLE Q. ' || code END AS applicant_name, TRUE AS contains_non_resident_heading FROM t"""

APOSTILLE_SQL = """, t AS (SELECT *, regexp_extract(raw_text, 'by JANE ([A-J]+) 3', 1) AS code,
  CASE WHEN k % 14 = 0 THEN 'NO. A-77 ' ELSE '' END || """ + _item(8) + """ AS num FROM page_text_v WHERE document_type = 'apostille'),
f AS (SELECT case_id, 'UNITED STATES OF AMERICA' AS issuing_country, 'JANE ' || code AS signed_by,
  CASE WHEN k % 14 = 0 THEN 'Notary Public' ELSE 'NOTARY PUBLIC' END AS signer_capacity,
  CASE WHEN k % 6 <> 4 THEN 'COUNTY OF ' || code END AS seal_owner, regexp_extract(raw_text, '5\\. at (.*?) 6\\.', 1) AS issued_at,
  CASE WHEN k % 3 = 1 THEN NULL ELSE (1 + k % 28) || 'TH DAY OF APRIL, 2014' END AS issued_on,
  CASE k % 3 WHEN 0 THEN 'Secretary of State, State of North Carolina' WHEN 1 THEN 'Secretary of State State of Michigan' ELSE 'Deputy Secretary of State, State of California' END AS issuing_authority,
  coalesce(nullif(regexp_extract(num, '(?:NO\\.?|No\\.?)\\s*([A-Z0-9-]+)', 1, 'i'), ''), nullif(regexp_extract(num, '(\\d+)', 1), '')) AS certificate_number, k FROM t)
SELECT f.* EXCLUDE (k), TRUE AS has_apostille_heading, (7 - (issued_on IS NULL)::INT - (seal_owner IS NULL)::INT + (certificate_number IS NOT NULL)::INT)::BIGINT AS filled_item_count FROM f"""


def first_matches(spark, folder):
    rows = V.view(spark, folder, "page_text_v")
    return rows.select("case_id", "document_type", first_match(F.col("raw_text"), X.WITHHOLDING_TIN).alias("tin"),
                       first_match(F.col("raw_text"), [r"Tax\s*Year\s*[:;]?\s*(\d{4})", r"(\d{4})\s*년", r"NO\.\s*(\d{4})"]).alias("year"))


MATCH_SQL = """SELECT case_id, document_type, nullif(coalesce(nullif(regexp_extract(raw_text, '납세자번호\\s*(\\d{3}-\\d{2}-\\d{4})', 1, 'i'), ''),
  nullif(regexp_extract(raw_text, '(?:Taxpayer Identification Number|TIN)\\s*[:;]?\\s*(\\d{3}-\\d{2}-\\d{4})', 1, 'i'), ''),
  nullif(regexp_extract(raw_text, '\\b(\\d{3}-\\d{2}-\\d{4})\\b', 1), '')), '') AS tin,
  coalesce(nullif(regexp_extract(raw_text, 'Tax\\s*Year\\s*[:;]?\\s*(\\d{4})', 1, 'i'), ''), nullif(regexp_extract(raw_text, '(\\d{4})\\s*년', 1), ''),
   nullif(regexp_extract(raw_text, 'NO\\.\\s*(\\d{4})', 1, 'i'), '')) AS year FROM page_text_v"""


def item_cleaning(spark, folder):
    rows = spread(V.view(spark, folder, "page_text_v").filter(F.col("document_type") == K.APOSTILLE))
    line = F.col("raw_text")
    return rows.select(
        "case_id", N.item_block(line, 8).alias("item_8"), N.item_block(line, 9).alias("item_9"), N.item_block(line, 10).alias("item_10"),
        N.clean_item(find(line, r"5\.(.*)$"), ["by", "the"], commas=True).alias("place"),
        N.norm_capacity(N.clean_item(find(line, r"capacity of(.*?)4\."))).alias("capacity"),
        N.norm_issuing_country(N.clean_item(find(line, r"1\.\s(.*?)2\. "), ["This public document"])).alias("country"),
    )


ITEM_SQL = """, t AS (SELECT * FROM page_text_v WHERE document_type = 'apostille')
SELECT case_id, """ + _item(8) + """ AS item_8, """ + _item(9) + """ AS item_9, """ + _item(10) + """ AS item_10,
  regexp_replace(trim(regexp_replace(regexp_extract(raw_text, '5\\. (.*)$', 1), '(?is)the.*', '')), '\\s*,\\s*', ', ', 'g') AS place,
  'NOTARY PUBLIC' AS capacity, 'UNITED STATES OF AMERICA' AS country FROM t"""


def normalised_names(spark, folder):
    d = V.view(spark, folder, "docs_v")
    name = F.concat(F.lit("  "), F.coalesce("taxpayer_name", "applicant_name", "signed_by", F.lit("J.Q.PUBLIC")), F.lit("  X.Y (JR) ,;"))
    return d.select("case_id", "position", N.norm_name(name).alias("name"), N.canonical_name(name).alias("canonical"))


NAME_SQL = """SELECT case_id, position, trim(regexp_replace(regexp_replace(regexp_replace(n, '\\b([A-Z])\\.([A-Z])', '\\1. \\2', 'g'), '[^A-Za-z0-9 .,''-]', ' ', 'g'), ' +', ' ', 'g')) AS name,
  regexp_replace(lower(n), '[^a-z0-9]', '', 'g') AS canonical FROM (SELECT case_id, position, trim(regexp_replace(coalesce(taxpayer_name, applicant_name, signed_by, 'J. Q.PUBLIC'), '\\s+', ' ', 'g')) || ' X.Y (JR)' AS n FROM docs_v)"""


def normalised_places(spark, folder):
    c = V.table(spark, folder, "customer")
    k = F.col("c_custkey")
    raw = F.when(k % 6 == 0, "  united states  of america ").when(k % 6 == 1, "U nited States 이f America").when(k % 6 == 2, "the usa!").when(
        k % 6 == 3, "").when(k % 6 == 4, "Republic of KR").otherwise(F.col("c_mktsegment"))
    return c.select(
        "c_custkey", N.norm_country(raw).alias("country"), N.norm_country_code(raw).alias("code"),
        N.norm_address(F.concat("c_name", F.lit(",\n12 Main St. Apt*5, "), "c_mktsegment")).alias("address"),
        N.norm_percent(F.concat(F.lit("rate "), (k % 200).cast("string"), F.lit(" %"))).alias("percent"),
        N.norm_percent(F.col("c_mktsegment")).alias("no_percent"),
    )


PLACE_SQL = """WITH r AS (SELECT *, CASE c_custkey % 6 WHEN 0 THEN '  united states  of america ' WHEN 1 THEN 'U nited States 이f America' WHEN 2 THEN 'the usa!' WHEN 3 THEN ''
   WHEN 4 THEN 'Republic of KR' ELSE c_mktsegment END AS raw FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 6 < 3 THEN 'United States of America' ELSE nullif(trim(regexp_replace(raw, '\\s+', ' ', 'g')), '') END AS country,
  CASE WHEN c_custkey % 6 < 3 THEN 'US' ELSE nullif(regexp_extract(upper(raw), '\\b([A-Z]{2})\\b', 1), '') END AS code,
  trim(regexp_replace(regexp_replace(regexp_replace(c_name || ' 12 Main St. Apt*5 ' || c_mktsegment, '[\\n,]+', ' ', 'g'), '[^A-Za-z0-9#.'' -]', ' ', 'g'), '\\s+', ' ', 'g')) AS address,
  regexp_extract((c_custkey % 200)::VARCHAR, '^\\d{1,2}') || '%' AS percent, CAST(NULL AS VARCHAR) AS no_percent FROM r"""


def normalised_dates(spark, folder):
    o = V.table(spark, folder, "orders")
    y, m, d = (F.date_format("o_orderdate", p) for p in ("yyyy", "M", "d"))
    k = F.col("o_orderkey") % 5
    english = F.concat(F.date_format("o_orderdate", "MMMM"), F.lit("  0"), d, F.when(k == 0, "th,").when(k == 1, ".").otherwise(""), F.lit(" "), y, F.when(k == 2, ";").otherwise(""))
    english = F.when(k == 4, F.concat(F.lit(" on "), y, F.lit("."))).otherwise(english)
    iso = F.when(k == 0, F.concat(y, F.lit("년 "), m, F.lit("월 "), d, F.lit("일"))).when(k == 1, F.concat_ws(".", y, m, d)).when(
        k == 2, F.concat_ws(" / ", y, m, d)).when(k == 3, F.concat(F.lit("t. "), y, F.lit("\n"), F.lpad(m, 2, "0"), F.lit(" "), F.lpad(d, 2, "0"))).otherwise("no  date")
    apostille = F.concat(d, F.lit("TH DAY OF "), F.upper(F.date_format("o_orderdate", "MMMM")), F.when(k == 0, "").otherwise(",  "), y, F.lit(" ;"))
    return o.select("o_orderkey", N.norm_english_date(english).alias("english"), N.norm_iso_date(iso).alias("iso"), N.norm_apostille_date(apostille).alias("apostille"))


DATE_SQL = """WITH p AS (SELECT o_orderkey, o_orderkey % 5 AS k, strftime(o_orderdate, '%Y') AS y, month(o_orderdate)::VARCHAR AS m, day(o_orderdate)::VARCHAR AS d, monthname(o_orderdate) AS n FROM orders)
SELECT o_orderkey, CASE WHEN k = 4 THEN 'on ' || y WHEN length(d) = 2 THEN CASE k WHEN 0 THEN n || ' 0' || d || 'th, ' || y WHEN 1 THEN n || ' 0' || d || '. ' || y ELSE n || ' 0' || d || ' ' || y END ELSE n || ' ' || d || ', ' || y END AS english,
  CASE WHEN k = 4 THEN 'no date' ELSE y || '-' || lpad(m, 2, '0') || '-' || lpad(d, 2, '0') END AS iso,
  d || 'TH DAY OF ' || upper(n) || ', ' || y AS apostille FROM p"""


def normalised_authority(spark, folder):
    s = V.table(spark, folder, "supplier")
    k = F.col("s_suppkey")
    raw = F.when(k % 4 == 0, F.concat(F.lit("Deputy Secretary of StateState  of "), "s_name")).when(k % 4 == 1, "  ").when(k % 4 == 2, "").otherwise(F.col("s_name"))
    return s.select("s_suppkey", N.norm_authority(raw).alias("authority"))


_PHRASES = {"irs": X.IRS_PHRASES, "certified": X.CERTIFICATION_PHRASES, "resident": X.RESIDENT_PHRASES, "apostille": X.APOSTILLE_PHRASES, "non_resident": X.NON_RESIDENT_PHRASES}

QUERIES = [
    Query("F1_eligibility", eligibility, LABELS_SQL + "SELECT case_id, document_type, skip_reason FROM elig"),
    Query("F1_skip_counts", skip_counts, LABELS_SQL + "SELECT skip_reason, count(*) AS rows FROM elig WHERE skip_reason IS NOT NULL GROUP BY ALL"),
    Query("F2_field_groups", field_groups, f"""SELECT field_name, CASE WHEN field_name IN ('taxpayer_name', 'address') THEN 'english_name_org' WHEN field_name IN ('tin', 'tax_year') THEN 'numeric_tin_code'
        WHEN field_name = 'issued_on' THEN 'date' ELSE 'korean_mixed_form' END AS field_group, count(*) AS rows FROM ({FIELD_LINES}) GROUP BY ALL"""),
    Query("F3_accepted_rejected", accepted_split, _v(("crops_v",), "SELECT CASE WHEN accepted OR field_name = 'address' THEN 'accepted' ELSE 'rejected' END AS verdict, document_type, count(*) AS rows FROM crops_v GROUP BY ALL")),
    Query("F4_pending_paths", pending_paths, "SELECT c_custkey, c_custkey % 4 = 0 AS pending FROM customer"),
    Query("F5_masked_values", masked, _v(("people_v",), "SELECT case_id, " + MASK.format("'tin ' || tin || ', ein 12-' || lpad(k::VARCHAR, 7, '0') || '.'") + " AS note, '***-**-****' AS value, k AS number, '***-**-****' AS tin, '9' || tin AS id FROM people_v")),
    Query("F6_composed_paths", composed, "SELECT page_id, nfc_normalize(url || '/e' || chr(769) || 'te' || chr(769) || '-' || html) AS key FROM pages"),
    Query("F7_valid_tin", tin_check, _v(("docs_v",), "SELECT case_id, position, coalesce(regexp_full_match(trim(tin), '\\d{3}-\\d{2}-\\d{4}|\\d{2}-\\d{7}'), FALSE) AS valid FROM docs_v")),
    Query("F8_plausible_date", date_check, _v(("docs_v",), "SELECT case_id, position, coalesce(regexp_matches(d, '\\d{1,2}') AND regexp_matches(d, '\\d{4}') AND regexp_matches(d, '(?i)\\b(" + "|".join(K.MONTHS) + ")\\b'), FALSE) AS plausible FROM (SELECT *, coalesce(issued_on, issue_date, signature_date) AS d FROM docs_v)")),
    Query("F9_marker_flags", marker_flags, _v(("page_text_v",), "SELECT case_id, document_type, " + ", ".join(f"{_any(p)} AS {n}" for n, p in _PHRASES.items()) + " FROM page_text_v")),
    Query("X1_flattened_lines", flattened_lines, FLAT_SQL),
    Query("X2_document_text", assembled_text, ASSEMBLED_SQL),
    Query("X3_region_text", words_in_regions, REGION_SQL),
    Query("X4_region_boxes", region_boxes, BOX_SQL),
    Query("X5_template_choice", template_choice, _v(("page_text_v",), TEMPLATE_SQL)),
    Query("X6_first_match", first_matches, _v(("page_text_v",), MATCH_SQL)),
    Query("X7_residency_fields", residency_fields, V.plain(V.with_views(("page_text_v",)).rstrip() + RESIDENCY_SQL)),
    Query("X8_withholding_fields", withholding_fields, V.plain(V.with_views(("page_text_v",)).rstrip() + WITHHOLDING_SQL)),
    Query("X9_apostille_fields", apostille_fields, V.plain(V.with_views(("page_text_v",)).rstrip() + APOSTILLE_SQL)),
    Query("X10_item_cleaning", item_cleaning, V.plain(V.with_views(("page_text_v",)).rstrip() + ITEM_SQL)),
    Query("X11_names", normalised_names, _v(("docs_v",), NAME_SQL)),
    Query("X12_places", normalised_places, PLACE_SQL),
    Query("X13_dates", normalised_dates, DATE_SQL),
    Query("X14_authority", normalised_authority, "SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'Deputy Secretary of State State of ' || s_name WHEN 3 THEN s_name END AS authority FROM supplier"),
]
