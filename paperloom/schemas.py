"""Explicit schemas of every source.  Nothing is inferred: field maps must stay maps."""

from pyspark.sql import types as T

STRINGS = T.MapType(T.StringType(), T.StringType())
FLAGS = T.MapType(T.StringType(), T.BooleanType())
NAMES = T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TEXT, FLAG, INT, LONG, REAL = T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType(), T.DoubleType()

WORD = _struct(text=TEXT, confidence=REAL, points=T.ArrayType(T.ArrayType(REAL)))
PAGE = _struct(doc_id=TEXT, page_number=INT, raw_text=TEXT, words=T.ArrayType(WORD))
FINDING = _struct(code=TEXT, message=TEXT, field_name=TEXT)
BOX = _struct(left=INT, top=INT, right=INT, bottom=INT)

QUALITY_CHECKS = _struct(
    has_certification_text=FLAG, has_irs_heading=FLAG, has_apostille_heading=FLAG, filled_item_count=INT,
    contains_non_resident_heading=FLAG, seal_present=FLAG, signature_present=FLAG, all_no_boxes_checked=FLAG,
    checked_no_box_count=INT, detected_template_id=TEXT, file_type=TEXT, width=INT, height=INT,
    blur_score=REAL, blurry=FLAG, average_ocr_confidence=REAL, low_ocr_confidence=FLAG,
)
DOCUMENT = _struct(
    document_type=TEXT, source_path=TEXT, template_id=TEXT, fields=STRINGS, quality_checks=QUALITY_CHECKS,
    parser_warnings=NAMES,
)
CROSS_CHECK = _struct(matched=FLAG, reason=TEXT)
REVIEW = _struct(status=TEXT, findings=T.ArrayType(FINDING), cross_check=CROSS_CHECK)
RUN_RESULT = _struct(
    case_id=TEXT, extracted_documents=T.ArrayType(DOCUMENT), review_result=REVIEW, queued_review_path=TEXT,
)

EXPECTED = _struct(
    case_id=TEXT, document_type=TEXT, expected_status=TEXT, expected_fields=STRINGS,
    expected_quality_checks=FLAGS, expected_finding_codes=NAMES, expected_cross_check=FLAGS,
    synthetic=FLAG, notes=NAMES,
)
PRIORITY_CONTEXT = _struct(
    priority_score=REAL, status=TEXT, matched_field_groups=NAMES, recommendations=NAMES,
    score_breakdown=T.MapType(TEXT, REAL),
)
LABEL = _struct(
    case_id=TEXT, document_type=TEXT, source_path=TEXT, dataset_split=TEXT, expected_status=TEXT,
    expected_fields=STRINGS, expected_quality_checks=FLAGS, expected_finding_codes=NAMES, notes=NAMES,
    synthetic=FLAG, promotion_status=TEXT, source_findings=T.ArrayType(FINDING), priority_context=PRIORITY_CONTEXT,
)

QUALITY = _struct(
    width=INT, height=INT, aspect_ratio=REAL, dark_ratio=REAL, contrast=REAL, foreground_bbox_ratio=REAL,
    foreground_bbox=BOX, touched_edges=NAMES, edge_dark_ratios=T.MapType(TEXT, REAL), quality_flags=NAMES,
    accepted=FLAG, salvage_applied=FLAG, original_quality_flags=NAMES, salvage_strategy=TEXT, trim_pixels=BOX,
    synthetic=FLAG,
)
CROP = _struct(
    case_id=TEXT, document_type=TEXT, template_id=TEXT, field_name=TEXT, field_group=TEXT, text=TEXT, split=TEXT,
    source_path=TEXT, label_path=TEXT, crop_path=TEXT, box=BOX, original_box=BOX, quality=QUALITY,
    augmentation_type=TEXT, base_crop_path=TEXT,
)

METRIC = _struct(
    comparisons=LONG, exact_matches=LONG, exact_match_rate=REAL, average_character_error_rate=REAL,
    average_word_error_rate=REAL,
)
EVAL_REPORT = _struct(compared_cases=LONG, missing_cases=NAMES, field_metrics=T.MapType(TEXT, METRIC))
COUNTS = T.MapType(TEXT, LONG)
DATA_PROFILE = _struct(
    unique_source_counts=COUNTS, hard_case_train_ratio=REAL, filtered_hard_case_train_count=LONG,
    filtered_stale_hard_case_count=LONG, unique_hard_case_variant_counts=COUNTS,
    counts_by_source_type=T.MapType(TEXT, COUNTS), hard_case_selection_strategy=TEXT,
    hard_case_variant_floor_applied=FLAG, warnings=NAMES,
)
READINESS = _struct(
    status=TEXT, ready_for_execution=FLAG, blocking_warnings=NAMES, advisory_warnings=NAMES,
)
GROUP_SUMMARY = _struct(
    train_count=LONG, val_count=LONG, character_count=LONG, data_profile=DATA_PROFILE, training_readiness=READINESS,
)
TRAINING_SUMMARY = _struct(groups=T.MapType(TEXT, GROUP_SUMMARY))
GAP_ITEM = _struct(
    field_group=TEXT, priority_score=REAL, base_train_count=LONG, base_val_count=LONG, rejected_count=LONG,
    recommendations=NAMES, score_breakdown=T.MapType(TEXT, REAL),
    recognizer_profile=_struct(training_readiness=READINESS),
)
GAP_REPORT = _struct(priorities=T.ArrayType(GAP_ITEM))
