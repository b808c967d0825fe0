"""Fixed values shared by all operators.

Everything in this file is a fixed value of the domain (names, codes, weights,
thresholds, region boxes).  There is no logic here.
"""

# --- document types and review states (fixed values) ------------------------
RESIDENCY = "residency_certificate"
APOSTILLE = "apostille"
WITHHOLDING = "withholding_tax_form"
DOCUMENT_TYPES = (RESIDENCY, APOSTILLE, WITHHOLDING)

PASS, REJECT, NEEDS_REVIEW = "pass", "reject", "needs_review"
TRAIN, VAL = "train", "val"
PENDING_REVIEW = "pending_review"
UNKNOWN = "unknown"

# --- field names per document type (fixed values) ---------------------------
RESIDENCY_FIELDS = (
    "taxpayer_name", "tin", "tax_year", "issue_date", "residency_country", "residency_country_code",
)
WITHHOLDING_FIELDS = (
    "first_name", "last_name", "middle_name", "tin", "address", "residency_country",
    "residency_country_code", "dividend_tax_rate", "signature_date", "applicant_name",
)
APOSTILLE_FIELDS = (
    "issuing_country", "signed_by", "signer_capacity", "seal_owner", "issued_at", "issued_on",
    "issuing_authority", "certificate_number",
)
FIELD_NAMES = tuple(dict.fromkeys(RESIDENCY_FIELDS + WITHHOLDING_FIELDS + APOSTILLE_FIELDS))

# --- field groups (fixed values); every other field name is DEFAULT_GROUP ----
ENGLISH_GROUP, NUMERIC_GROUP, DATE_GROUP = "english_name_org", "numeric_tin_code", "date"
DEFAULT_GROUP = "korean_mixed_form"
GROUP_FIELDS = {
    ENGLISH_GROUP: (
        "taxpayer_name", "first_name", "middle_name", "last_name", "applicant_name", "signed_by",
        "signer_capacity", "seal_owner", "issued_at", "issuing_authority", "residency_country", "address",
    ),
    NUMERIC_GROUP: ("tin", "residency_country_code", "certificate_number", "tax_year", "dividend_tax_rate"),
    DATE_GROUP: ("issue_date", "signature_date", "issued_on"),
}

# --- template profiles (fixed values) ---------------------------------------
# (template id, document type, file name markers, text markers), in declared order
TEMPLATES = (
    ("residency.irs_standard", RESIDENCY, ("거주자증명서", "treasury", "irs"),
     ("internal revenue service", "department of the treasury")),
    ("withholding.non_resident_v1", WITHHOLDING, ("국내원천소득", "제한세율"),
     ("국내원천소득 제한세율 적용신청서", "비거주자용")),
    ("apostille.north_carolina", APOSTILLE, ("california 주2", "north carolina"),
     ("state of north carolina", "raleigh, north carolina")),
    ("apostille.michigan", APOSTILLE, ("michigan",), ("state of michigan", "lansing, michigan")),
    ("apostille.california", APOSTILLE, ("california",), ("state of california", "los angeles, california")),
)
FILE_MARKER_SCORE, TEXT_MARKER_SCORE = 2, 3

# (template id, kind, name, left, top, right, bottom, least dark ratio); fixed values
DARK_BELOW = 200
TEMPLATE_REGIONS = (
    ("residency.irs_standard", "quality", "seal_present", 0.02, 0.02, 0.17, 0.17, 0.06),
    ("residency.irs_standard", "quality", "signature_present", 0.51, 0.80, 0.71, 0.88, 0.02),
    ("residency.irs_standard", "ocr", "taxpayer_name", 0.10, 0.25, 0.34, 0.31, None),
    ("residency.irs_standard", "ocr", "tin", 0.10, 0.27, 0.28, 0.33, None),
    ("residency.irs_standard", "ocr", "tax_year", 0.10, 0.30, 0.23, 0.36, None),
    ("residency.irs_standard", "ocr", "issue_date", 0.60, 0.22, 0.90, 0.28, None),
    ("withholding.non_resident_v1", "quality", "signature_present", 0.73, 0.77, 0.95, 0.84, 0.02),
    ("withholding.non_resident_v1", "checkbox", "all_no_boxes_checked", 0.92, 0.49, 0.96, 0.52, 0.02),
    ("withholding.non_resident_v1", "checkbox", "all_no_boxes_checked", 0.92, 0.52, 0.96, 0.55, 0.02),
    ("withholding.non_resident_v1", "checkbox", "all_no_boxes_checked", 0.92, 0.55, 0.96, 0.58, 0.02),
    ("withholding.non_resident_v1", "checkbox", "all_no_boxes_checked", 0.92, 0.58, 0.96, 0.61, 0.02),
    ("withholding.non_resident_v1", "checkbox", "all_no_boxes_checked", 0.92, 0.61, 0.96, 0.64, 0.02),
    ("withholding.non_resident_v1", "checkbox", "all_no_boxes_checked", 0.92, 0.64, 0.96, 0.67, 0.02),
    ("withholding.non_resident_v1", "checkbox", "all_no_boxes_checked", 0.92, 0.67, 0.96, 0.70, 0.02),
    ("withholding.non_resident_v1", "ocr", "last_name", 0.14, 0.16, 0.30, 0.20, None),
    ("withholding.non_resident_v1", "ocr", "first_name", 0.40, 0.16, 0.54, 0.20, None),
    ("withholding.non_resident_v1", "ocr", "middle_name", 0.68, 0.16, 0.76, 0.20, None),
    ("withholding.non_resident_v1", "ocr", "address", 0.16, 0.21, 0.86, 0.25, None),
    ("withholding.non_resident_v1", "ocr", "tin", 0.14, 0.27, 0.31, 0.33, None),
    ("withholding.non_resident_v1", "ocr", "residency_country", 0.56, 0.27, 0.83, 0.33, None),
    ("withholding.non_resident_v1", "ocr", "residency_country_code", 0.86, 0.27, 0.98, 0.33, None),
    ("withholding.non_resident_v1", "ocr", "dividend_tax_rate", 0.72, 0.39, 0.90, 0.45, None),
    ("withholding.non_resident_v1", "ocr", "signature_date", 0.70, 0.74, 0.96, 0.81, None),
    ("withholding.non_resident_v1", "ocr", "applicant_name", 0.40, 0.79, 0.72, 0.85, None),
    ("apostille.california", "quality", "seal_present", 0.06, 0.74, 0.36, 0.97, 0.08),
    ("apostille.california", "quality", "signature_present", 0.49, 0.78, 0.87, 0.93, 0.015),
    ("apostille.california", "ocr", "issuing_country", 0.16, 0.34, 0.44, 0.40, None),
    ("apostille.california", "ocr", "signed_by", 0.12, 0.43, 0.40, 0.49, None),
    ("apostille.california", "ocr", "signer_capacity", 0.12, 0.50, 0.68, 0.57, None),
    ("apostille.california", "ocr", "seal_owner", 0.12, 0.57, 0.62, 0.63, None),
    ("apostille.california", "ocr", "issued_at", 0.12, 0.66, 0.42, 0.72, None),
    ("apostille.california", "ocr", "issued_on", 0.12, 0.72, 0.36, 0.78, None),
    ("apostille.california", "ocr", "issuing_authority", 0.12, 0.77, 0.72, 0.83, None),
    ("apostille.california", "ocr", "certificate_number", 0.12, 0.83, 0.28, 0.88, None),
    ("apostille.michigan", "quality", "seal_present", 0.06, 0.74, 0.38, 0.98, 0.08),
    ("apostille.michigan", "quality", "signature_present", 0.55, 0.74, 0.90, 0.86, 0.02),
    ("apostille.michigan", "ocr", "issuing_country", 0.34, 0.30, 0.80, 0.38, None),
    ("apostille.michigan", "ocr", "signed_by", 0.34, 0.37, 0.82, 0.46, None),
    ("apostille.michigan", "ocr", "signer_capacity", 0.43, 0.44, 0.72, 0.50, None),
    ("apostille.michigan", "ocr", "seal_owner", 0.42, 0.49, 0.79, 0.55, None),
    ("apostille.michigan", "ocr", "issued_at", 0.30, 0.57, 0.56, 0.62, None),
    ("apostille.michigan", "ocr", "issued_on", 0.40, 0.61, 0.66, 0.67, None),
    ("apostille.michigan", "ocr", "issuing_authority", 0.26, 0.68, 0.86, 0.74, None),
    ("apostille.michigan", "ocr", "certificate_number", 0.24, 0.73, 0.48, 0.81, None),
    ("apostille.north_carolina", "quality", "seal_present", 0.08, 0.68, 0.34, 0.96, 0.08),
    ("apostille.north_carolina", "quality", "signature_present", 0.56, 0.70, 0.92, 0.92, 0.018),
    ("apostille.north_carolina", "ocr", "issuing_country", 0.34, 0.31, 0.68, 0.36, None),
    ("apostille.north_carolina", "ocr", "signed_by", 0.44, 0.38, 0.66, 0.43, None),
    ("apostille.north_carolina", "ocr", "signer_capacity", 0.43, 0.44, 0.72, 0.50, None),
    ("apostille.north_carolina", "ocr", "seal_owner", 0.42, 0.49, 0.79, 0.55, None),
    ("apostille.north_carolina", "ocr", "issued_at", 0.30, 0.57, 0.56, 0.62, None),
    ("apostille.north_carolina", "ocr", "issued_on", 0.40, 0.61, 0.66, 0.67, None),
    ("apostille.north_carolina", "ocr", "issuing_authority", 0.26, 0.68, 0.86, 0.74, None),
    ("apostille.north_carolina", "ocr", "certificate_number", 0.24, 0.73, 0.48, 0.81, None),
)

# --- files (fixed values) ----------------------------------------------------
DOCUMENT_SUFFIXES = (".png", ".jpg", ".jpeg", ".pdf", ".tif", ".tiff", ".bmp")
IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg", ".tif", ".tiff", ".bmp")

# --- review thresholds (fixed values) ----------------------------------------
BLUR_THRESHOLD = 100.0
CONFIDENCE_THRESHOLD = 0.75

# --- crop quality thresholds (fixed values) ----------------------------------
MIN_WIDTH, MIN_HEIGHT = 24, 16
MIN_DARK_RATIO, MIN_CONTRAST = 0.01, 8.0
MAX_FOREGROUND_RATIO, FILLED_DARK_RATIO = 0.85, 0.35
DENSE_EDGE_RATIO, DENSE_EDGE_COUNT = 0.45, 3
MAX_TRIM_RATIO, TRIM_PASSES = 0.18, 3

# --- sample targets and their weights, for the split objective and the gap score (fixed values)
MIN_TRAIN, MIN_VAL, MIN_TRAIN_SOURCES, MIN_VAL_SOURCES = 12, 3, 3, 2
TRAIN_WEIGHT, VAL_WEIGHT, TRAIN_SOURCE_WEIGHT, VAL_SOURCE_WEIGHT = 3.0, 2.0, 2.5, 2.0
EXACT_SPLIT_SOURCES = 14

# --- hard case variants (fixed values) ----------------------------------------
VARIANTS = {
    ENGLISH_GROUP: ("left_clip", "rotate", "low_res", "overlay_patch"),
    NUMERIC_GROUP: ("left_clip", "rotate", "low_res", "edge_overlap"),
    DATE_GROUP: ("rotate", "low_res"),
    DEFAULT_GROUP: ("left_clip", "low_res", "overlay_patch"),
}
DEFAULT_VARIANTS = ("low_res",)
SYNTHETIC_DATE = "synthetic_date"
DATE_FIELDS = ("issue_date", "issued_on", "signature_date")
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September",
          "October", "November", "December")
BALANCED_STRATEGY = "base_document_balance"
FLOOR_STRATEGY = "base_document_balance_with_scarce_full_variant_floor"

# --- comparison and gate thresholds (fixed values) ----------------------------
TOLERANCE = 1e-9
SEVERE_MATCH, SEVERE_CER, SEVERE_WER = 0.05, 0.05, 0.1
READINESS_RANK = {"blocked": 0, "review_required": 1, "ready": 2}

# --- augmentation parameter lists per document type (fixed values) -------------
AUGMENTATION_PARAMETERS = ("rotation", "brightness", "contrast", "blur_radius", "resize_scale",
                           "crop_ratio", "noise_stddev", "jpeg_quality")
AUGMENTATION = {
    RESIDENCY: {
        "rotation": (-3.0, -1.5, 1.5, 3.0), "brightness": (0.92, 1.08), "contrast": (0.95, 1.05),
        "blur_radius": (0.4, 0.9), "jpeg_quality": (72.0, 86.0), "resize_scale": (0.92, 1.0),
        "crop_ratio": (0.0, 0.02), "noise_stddev": (2.0, 4.0),
    },
    APOSTILLE: {
        "rotation": (-2.0, -1.0, 1.0, 2.0), "brightness": (0.94, 1.06), "contrast": (0.96, 1.04),
        "blur_radius": (0.2, 0.8), "jpeg_quality": (74.0, 88.0), "resize_scale": (0.95, 1.0),
        "crop_ratio": (0.0, 0.015), "noise_stddev": (1.5, 3.0),
    },
    WITHHOLDING: {
        "rotation": (-1.0, 1.0), "brightness": (0.97, 1.03), "contrast": (0.98, 1.02),
        "blur_radius": (0.2, 0.5), "jpeg_quality": (82.0, 90.0), "resize_scale": (0.96, 1.0),
        "crop_ratio": (0.0, 0.01), "noise_stddev": (1.0, 2.0),
    },
}
AUGMENTATION_SEED, AUGMENTATION_COPIES = 20260629, 6
HARD_CASE_SEED, DATE_SEED, LABEL_SEED = 20260630, 20260701, 20260629

# --- texts written into label scaffolds (fixed values) --------------------------
SCAFFOLD_STATUS = "needs_human_verification"
SCAFFOLD_NOTES = (
    "Bootstrapped from sample_data coverage report.",
    "Human label review is required before this case enters the reviewed dataset.",
)
