"""Normalisers, error rates and the three extractors on single papers."""

import pytest
from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.functions import errors, normalize as N, predicates as P
from paperloom.operators import extract as X, pages as G, templates as T


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("fn,value,wanted", [
    (N.norm_name, " MARIA L.CHEN ,", "MARIA L. CHEN"), (N.norm_name, "  ", None), (N.canonical_name, None, ""),
    (N.norm_country, "nited States 이f America", "United States of America"), (N.norm_country, "the usa", "United States of America"),
    (N.norm_country_code, "O0", None), (N.norm_country_code, "in KR", "IN"), (N.norm_percent, "about 7 %", "7%"),
    (N.norm_english_date, "january 02nd 2026.", "january 2, 2026"), (N.norm_english_date, "soon", "soon"),
    (N.norm_iso_date, "2026년 1월 5일", "2026-01-05"), (N.norm_iso_date, "t.\n2026\n01\n12\nOL", "2026-01-12"),
    (N.norm_iso_date, "2026.13.45", "2026-13-45"), (N.norm_apostille_date, "10TH DAY OF APRIL2014", "10TH DAY OF APRIL, 2014"),
    (N.norm_authority, "Deputy Secretary of StateState of X", "Deputy Secretary of State State of X"),
    (N.norm_capacity, "NOTARY PUBLIC 12", "NOTARY PUBLIC"), (N.norm_issuing_country, "ED STATES OF AMERICA", "UNITED STATES OF AMERICA"),
    (N.clean_item, "__ | ;", None), (lambda c: N.clean_item(c, ["by"], commas=True), "Raleigh ,NC by X", "Raleigh, NC"),
    (P.valid_tin, " 12-3456789\n", True), (P.valid_tin, "123-45-67890", False), (P.plausible_date, "10th of may 2014", True),
    (P.plausible_date, "10 Mayor 2014", False), (P.field_group, "issuing_country", "korean_mixed_form"),
    (P.mask_text, "a 123-45-6789, 12-3456789", "a ***-**-****, **-*******"),
])
def test_value(spark, fn, value, wanted):
    assert one(spark, value, fn) == wanted


@pytest.mark.parametrize("expected,actual,cer,wer", [
    ("ABCD", "ABXD", 0.25, 1.0), ("한국어", "한국", 1 / 3, 1.0), ("", None, 0.0, 0.0), (None, "x", 1.0, 1.0), ("a", "abc", 2.0, 1.0),
    ("UNITED STATES OF X", "UNITED STATE OF", 3 / 18, 0.5), ("a  b", "a b", 0.25, 0.0),
])
def test_error_rates(spark, expected, actual, cer, wer):
    row = spark.createDataFrame([(expected, actual)], "e string, a string").select(
        errors.cer(F.col("e"), F.col("a")).alias("c"), errors.wer(F.col("e"), F.col("a")).alias("w")).first()
    assert row.c == pytest.approx(cer) and row.w == pytest.approx(wer)


def test_word_errors_with_very_many_words(spark):
    words = " ".join(f"w{i}" for i in range(3000))
    row = spark.createDataFrame([(words, words.replace("w7 ", "x "))], "e string, a string").select(
        errors.wer(F.col("e"), F.col("a")).alias("w")).first()
    assert row.w == pytest.approx(1 / 3000)


def extracted(spark, kind, lines, path, regions=None):
    pages = spark.createDataFrame([("c", kind, path, 1, "\n".join(lines))], "case_id string, document_type string, source_path string, page_number int, raw_text string")
    texts = G.document_text(pages, ["case_id", "document_type", "source_path"])
    texts = texts.withColumn("regions", F.lit(None).cast("map<string,string>") if not regions else F.create_map(*[F.lit(x) for kv in regions.items() for x in kv]))
    return X.extract_all(T.classify(texts)).first()


def test_residency_paper_with_items_in_another_order(spark):
    row = extracted(spark, K.RESIDENCY, [
        "page 1 of 1", "INTERNAL REVENUE SERVICE", "Philadelphia office", "Tax Year: 2019", "TIN: 98-7654321",
        "Taxpayer: HOLM, LIV", "Date: November 30, 2019",
        "to whom it may concern: I certify that the above-named entity is a resident of the United States of America for purposes of U.S. taxation.",
    ], "scan_0007.tif")
    assert row.fields["tin"] == "98-7654321" and row.fields["tax_year"] == "2019" and row.fields["issue_date"] == "November 30, 2019"
    assert row.fields["residency_country_code"] == "US" and row.has_irs_heading


def test_residency_paper_without_items(spark):
    row = extracted(spark, K.RESIDENCY, ["an unrelated letter", "Taxpayer:", "Tax Year:"], "scan_0008.tif")
    assert not {"tin", "tax_year", "issue_date"} & {k for k, v in (row.fields or {}).items() if v}
    assert not row.has_certification_text and not row.has_irs_heading


def test_withholding_rates_and_dates_in_any_place(spark):
    f = extracted(spark, K.WITHHOLDING, [
        "제한세율 적용신청서", "납세자번호 31-4159265", "(First Name) LIV (Middle Name) E (Last Name) HOLM", "배당소득 세율 5 %", "2018년 12월 9일",
    ], "w.png").fields
    assert f["tin"] == "31-4159265" and f["dividend_tax_rate"] == "5%" and f["signature_date"] == "2018-12-09"


def test_apostille_items_over_broken_lines(spark):
    row = extracted(spark, K.APOSTILLE, [
        "APOSTILLE", "1. Country:", "UNITED STATES OF AMERICA", "2. has been signed by", "TOVE LIND", "3. acting in the capacity of NOTARY PUBLIC",
        "5. at Salem, Oregon", "6. the 1ST DAY OF JUNE, 2017", "8. No. 4711",
    ], "a.jpg")
    assert row.fields["certificate_number"] == "4711" and row.fields["issued_on"] == "1ST DAY OF JUNE, 2017"
    assert "TOVE LIND" in row.fields["signed_by"] and row.has_apostille_heading


def test_mask_reaches_every_depth(spark):
    df = spark.sql("select named_struct('a', array('123-45-6789', null), 'b', map('k', named_struct('t', '12-3456789 x', 'n', 1))) as r")
    row = P.mask(df).first().r
    assert row.a == ["***-**-****", None] and row.b["k"].t == "**-******* x" and row.b["k"].n == 1


def test_nfc_joins_both_spellings(spark):
    df = spark.createDataFrame([("거주자",), ("거주자",), ("plain",), (None,)], "p string")
    assert sorted(str(r.key) for r in P.with_nfc(df, "p", "key").collect()) == sorted(["거주자", "거주자", "plain", "None"])


def test_one_part_of_papers_is_worked_on_by_many_tasks(spark):
    from pyspark.sql import functions as F

    from paperloom.operators import extract as X

    papers = spark.range(0, 400, 1, 1).select(
        F.concat(F.lit("c"), "id").alias("case_id"), F.lit("apostille").alias("document_type"), F.lit("a.png").alias("source_path"),
        F.lit("apostille.michigan").alias("template_id"), F.lit("7. by x").alias("text"), F.lit("7. by x").alias("single_line"),
        F.lit(None).cast("map<string,string>").alias("regions"))
    rows = X.extract_apostille(papers).select("case_id", F.spark_partition_id().alias("part")).collect()
    assert len({r.case_id for r in rows}) == len(rows) == 400 and len({r.part for r in rows}) > 1


def test_confidences_are_added_in_page_order(spark):
    """Whatever the partitions, the mean has the bits of one sum over the words in order, and ties of the threshold follow it."""
    from paperloom.operators import raster as Q

    pages = [[0.6 + (3 + (i * j) % 4) / 30 for j in range(1, 10)] for i in range(12)]
    total = 0.0
    for c in (c for page in pages for c in page):
        total += c
    rows = [("d", i, [(c,) for c in page] + [(None,)]) for i, page in enumerate(pages)] + [("d", 99, None), ("e", 0, [(None,)]), ("f", 0, None)]
    frame = spark.createDataFrame(rows, "doc_id string, page_number int, words array<struct<confidence:double>>")
    for parts in (1, 5, 13):
        got = {r.doc_id: r for r in Q.avg_confidence(frame.repartition(parts), ["doc_id"], order="page_number").collect()}
        assert got["d"].average_ocr_confidence == total / 108 and got["e"].average_ocr_confidence is None and got["f"].low_ocr_confidence is None
