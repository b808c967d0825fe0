"""From recognised pages to reviewed cases in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.operators.extract import extract_all
from paperloom.operators.pages import document_text, region_map
from paperloom.operators.raster import confidence_sums, page_checks, with_confidence, with_page_checks
from paperloom.operators.review import review_cases
from paperloom.operators.templates import classify

KEYS = ["case_id", "position", "document_type", "source_path"]


def extract_documents(
    pages: DataFrame, regions: DataFrame | None = None, rasters: DataFrame | None = None,
    blur_threshold: float = K.BLUR_THRESHOLD, confidence_threshold: float = K.CONFIDENCE_THRESHOLD,
) -> DataFrame:
    """One row per paper: fields and quality checks.

    ``pages``: the keys, ``page_number``, ``raw_text``, ``words``.  ``regions``: ``source_path``,
    ``name``, ``raw_text``.  ``rasters``: ``image_id`` (the source path), ``width``, ``height``,
    ``pixels``.  Papers without a raster keep unknown marks, as a PDF does.
    """
    texts = with_confidence(document_text(pages, KEYS, *confidence_sums()), confidence_threshold)
    if regions is not None:
        texts = texts.join(region_map(regions, ["source_path"]), "source_path", "left")
    else:
        texts = texts.withColumn("regions", F.lit(None).cast("map<string,string>"))
    papers = classify(texts)
    if rasters is not None:
        # pixels are measured where they lie; a small row of each page joins the papers
        seen = page_checks(rasters).withColumnRenamed("image_id", "source_path")
        papers = with_page_checks(papers.join(seen, "source_path", "left")).withColumn("blurry", F.col("blur_score") < blur_threshold)
    else:
        papers = papers.withColumns({
            name: F.lit(None).cast(kind)
            for name, kind in (
                ("width", "int"), ("height", "int"), ("blur_score", "double"), ("blurry", "boolean"),
                ("seal_present", "boolean"), ("signature_present", "boolean"), ("all_no_boxes_checked", "boolean"),
                ("checked_no_box_count", "int"),
            )
        })
    fields = extract_all(papers)
    suffix = F.lower(F.regexp_extract("source_path", r"[^/.](\.[^./]+)$", 1))
    checks = F.struct(
        "has_certification_text", "has_irs_heading", "has_apostille_heading", "filled_item_count",
        "contains_non_resident_heading", "seal_present", "signature_present", "all_no_boxes_checked", "checked_no_box_count",
        F.col("template_id").alias("detected_template_id"), suffix.alias("file_type"), "width", "height", "blur_score",
        "blurry", "average_ocr_confidence", "low_ocr_confidence",
    )
    return fields.select(*KEYS, "template_id", "fields", checks.alias("quality_checks"))


def run_review(
    pages: DataFrame, regions: DataFrame | None = None, rasters: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(cases, documents): the review of every case and the papers behind it.

    Shuffles: one by paper to assemble texts, one by source for rasters, one by case for the review.
    """
    documents = extract_documents(pages, regions, rasters)
    return review_cases(documents), documents


def run_results(cases: DataFrame, documents: DataFrame) -> DataFrame:
    """Nested run results, for exchange with tools that expect one object per case.

    Gathers the papers of a case into one value, so use it for filed cases of ordinary size.
    """
    nested = documents.groupBy("case_id").agg(F.array_sort(F.collect_list(
        F.struct("position", "source_path", "document_type", "template_id", F.to_json("fields").alias("fields"), "quality_checks")
    )).alias("papers"))
    extracted = F.transform("papers", lambda p: F.struct(
        p["document_type"].alias("document_type"), p["source_path"].alias("source_path"), p["template_id"].alias("template_id"),
        F.from_json(p["fields"], "map<string,string>").alias("fields"), p["quality_checks"].alias("quality_checks"),
        F.array().cast("array<string>").alias("parser_warnings"),
    ))
    review = F.struct("status", "findings", F.struct("matched", "reason").alias("cross_check"))
    return cases.join(nested, "case_id").select(
        "case_id", extracted.alias("extracted_documents"), review.alias("review_result"),
        F.lit(None).cast("string").alias("queued_review_path"),
    )
