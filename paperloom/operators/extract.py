"""Field extraction: expressions over one row per document.

Input rows carry ``document_type``, ``source_path``, ``template_id``, ``text``, ``single_line`` and
``regions`` (a map from region name to text).  Output adds ``fields`` (map from field name to text or
null) and the text flags.  Each stage is a projection, so Catalyst keeps every pattern evaluated once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.functions.normalize import (
    UNITED_STATES, clean_item, item_block, norm_address, norm_apostille_date, norm_authority, norm_capacity,
    norm_country, norm_country_code, norm_english_date, norm_iso_date, norm_issuing_country, norm_name, norm_percent,
)
from paperloom.functions.text import (
    ANY_CASE, contains_any, find, first_match, join_present, literal_array, nonempty, squash, strip, strip_chars, tokens,
)
from paperloom.session import spread

# --- patterns and phrases (fixed values) -------------------------------------
SSN, EIN = r"(\d{3}-\d{2}-\d{4})", r"(\d{2}-\d{7})"
RESIDENCY_TIN = (rf"\bTIN\s*[:;]?\s*{SSN}", rf"\bTIN\s*[:;]?\s*{EIN}", rf"\b{SSN}\b", rf"\b{EIN}\b")
WITHHOLDING_TIN = (
    rf"납세자번호\s*{SSN}",
    rf"(?:Taxpayer Identification Number|TIN)\s*[:;]?\s*{SSN}",
    rf"(?:Taxpayer Identification Number|TIN)\s*[:;]?\s*{EIN}",
    rf"\b{SSN}\b", rf"\b{EIN}\b",
)
DIVIDEND_RATE = (
    r"배당소득\s*세율\s*(\d{1,2}\s*%)", r"배당소득\s*세율\s*(\d{1,2})(?=\s*(?:양도소득|%))",
    r"Dividend(?:\s+Income)?\s+Tax\s+Rate\s*(\d{1,2}\s*%)", r"(15\s*%)", r"\b(15)\b",
)
US_WORDS = "(?:United States of America|USA)"
RESIDENT_PHRASES = (
    "resident of the united states of america", "united states of america for purposes of u.s. taxation",
)
CERTIFICATION_PHRASES = (
    "resident of the united states of america for purposes of u.s. taxation", "certification", "i certify that",
)
IRS_PHRASES = ("department of the treasury", "internal revenue service")
NON_RESIDENT_PHRASES = ("국내원천소득 제한세율 적용신청서", "비거주자용")
APOSTILLE_PHRASES = ("apostille", "hague convention", "convention de la haye")
LABEL_FRAGMENTS = ("last", "ast", "first", "irst", "middle", "iddle", "name")

PLACE = r"5\.\s*at\s+([A-Za-z ,]+?)(?=\s+6\.|$)"
DAY_OF = r"(\d{1,2}(?:ST|ND|RD|TH)?\s+DAY\s+OF\s+[A-Z]+[,]?\s*\d{4})"
# (authority, date, seal) patterns per template
STATE_PATTERNS = {
    "apostille.north_carolina": (
        r"by\s+(Secretary of State.*?North Carolina)", DAY_OF,
        r"seal(?:/stamp)?\s+of[_\s]*([A-Z ,]+?)(?=\s+CERTIFIED|\s+5\.|$)",
    ),
    "apostille.michigan": (
        r"7\.\s*by\s+(Secretary of State.*?Michigan)", r"(\d{1,2}(?:ST|ND|RD|TH)?\s+OF\s+[A-Z]+[,]?\s*\d{4})",
        r"bears the seal of[:\s]*(.+?)(?=\s+CERTIFIED|\s+5\.|$)",
    ),
    "apostille.california": (
        r"7\.\s*by\s+(Deputy Secretary of State.*?California)", DAY_OF,
        r"bears the seal/stamp of[:\s]*(.+?)(?=\s+CERTIFIED|\s+5\.|$)",
    ),
}
GENERIC_PATTERNS = (
    r"by\s+(.+?)(?=\s+8\.|$)", r"(\d{1,2}(?:ST|ND|RD|TH)?.+?\d{4})", r"bears the seal(?:/stamp)? of[:\s]*(.+)",
)


def _region(name: str) -> Column:
    return nonempty(strip(F.try_element_at("regions", F.lit(name))))


def _fields(names: tuple[str, ...]) -> Column:
    return F.map_from_arrays(literal_array(names), F.array(*[F.col(n) for n in names]))


TEXTS = ("text", "single_line", "regions")


def _staged(docs: DataFrame, kind: str) -> DataFrame:
    """The row as ``doc`` and its texts, null for papers of another type: their patterns cost nothing."""
    mine = F.col("document_type") == kind
    return docs.select(F.struct(*docs.columns).alias("doc"), *[F.when(mine, F.col(c)).alias(c) for c in TEXTS])


def _finish(staged: DataFrame, kind: str, names: tuple[str, ...], flags: list[str]) -> DataFrame:
    mine = F.col("doc.document_type") == kind
    return staged.select(
        "doc.*", F.when(mine, _fields(names)).alias(f"fields_{kind}"), *[F.when(mine, F.col(f)).alias(f) for f in flags]
    )


def _residency(docs: DataFrame) -> DataFrame:
    text, line = F.col("text"), F.col("single_line")

    def cleaned(value: Column) -> Column:
        value = F.regexp_replace(value, ANY_CASE + r"Taxpayer\s*:?", " ")
        value = F.regexp_replace(value, ANY_CASE + r"TIN\s*:?.*$", " ")
        return nonempty(squash(F.regexp_replace(value, "[^A-Za-z .'-]", " ")))

    name = F.coalesce(
        cleaned(_region("taxpayer_name")),
        cleaned(find(text, r"Taxpayer\s*[:;]?\s*([^\n]+)")),
        cleaned(find(line, r"Taxpayer\s*[:;]?\s*(.+?)\s+(?:TIN|Tax Year|Date)\b")),
    )
    staged = _staged(docs, K.RESIDENCY).select(
        "doc",
        name.alias("taxpayer_name"),
        first_match(squash(join_present(" ", _region("tin"), line)), RESIDENCY_TIN).alias("tin"),
        F.coalesce(find(_region("tax_year"), r"(\d{4})"), find(line, r"Tax\s*Year\s*[:;]?\s*(\d{4})")).alias("tax_year"),
        F.coalesce(
            _region("issue_date"), find(line, r"Date\s*[:;]?\s*([A-Za-z]+\s+\d{1,2}[,.]?\s*\d{4})")
        ).alias("issue_date"),
        contains_any(line, RESIDENT_PHRASES).alias("resident"),
        contains_any(line, CERTIFICATION_PHRASES).alias("has_certification_text"),
        contains_any(line, IRS_PHRASES).alias("has_irs_heading"),
    ).withColumns({
        "taxpayer_name": norm_name(F.col("taxpayer_name")), "issue_date": norm_english_date(F.col("issue_date")),
        "residency_country": F.when(F.col("resident"), F.lit(UNITED_STATES)),
        "residency_country_code": F.when(F.col("resident"), F.lit("US")),
    })
    return _finish(staged, K.RESIDENCY, K.RESIDENCY_FIELDS, ["has_certification_text", "has_irs_heading"])


def _clean_person(value: Column) -> Column:
    value = F.regexp_replace(value, ANY_CASE + r"\b(?:Last|First|Middle|Name)\b", " ")
    return nonempty(squash(F.regexp_replace(value, "[^A-Za-z .'-]", " ")))


def _compact_person(words: Column) -> Column:
    """A region that reads as one name, or a short name plus noise; null when it caught a label."""
    label = F.exists(words, lambda w: F.lower(strip_chars(w, ".")).isin(*LABEL_FRAGMENTS))
    short = F.forall(words, lambda w: F.length(w) <= 10)
    usable = (F.size(words) == 1) | ((F.size(words) == 2) & short)
    return F.when(usable & ~label, F.get(words, F.lit(0)))


def _withholding(docs: DataFrame) -> DataFrame:
    line = F.col("single_line")
    located = _staged(docs, K.WITHHOLDING).select(
        "doc",
        F.coalesce(
            _clean_person(_region("applicant_name")),
            find(line, r"신청인\s+([A-Za-z][A-Za-z .'-]+?)\s+\(?서명"),
            find(line, r"신청인\s+([A-Za-z][A-Za-z .'-]+)"),
        ).alias("applicant_name"),
        *[tokens(_clean_person(_region(n))).alias(f"{n}_words") for n in ("last_name", "first_name", "middle_name")],
        first_match(line, [r"Last Name\)?\s*([A-Z]{2,})\b", r"Last Name\)?\s*([A-Za-z][A-Za-z .'-]+?)\s+\(?First Name\)?"]).alias(
            "last_found"
        ),
        first_match(line, [r"First Name\)?\s*([A-Z]{2,})\b", r"First Name\)?\s*([A-Za-z][A-Za-z .'-]+?)\s+\(?Middle Name\)?"]).alias(
            "first_found"
        ),
        find(line, r"Middle Name\)?\s*([A-Z])\b").alias("middle_found"),
        first_match(squash(join_present(" ", _region("tin"), line)), WITHHOLDING_TIN).alias("tin"),
        F.coalesce(
            find(line, rf"(1\d{{3,4}}\s+[A-Za-z0-9 ,.'#-]+?{US_WORDS})"),
            _region("address"),
            find(line, rf"주소(?:\s*\([^)]+\))?\s*([0-9A-Za-z ,.'#-]+?{US_WORDS})"),
        ).alias("address"),
        F.coalesce(
            _region("residency_country"),
            first_match(line, [rf"거주지국\s*({US_WORDS})", rf"Country\s*[:;]?\s*({US_WORDS})"]),
        ).alias("residency_country"),
        _region("residency_country_code").alias("code_region"),
        first_match(line, [r"거주지국코드\s*([A-Z]{2})", r"Country Code\s*[:;]?\s*([A-Z]{2})"]).alias("code_found"),
        first_match(squash(join_present(" ", _region("dividend_tax_rate"), line)), DIVIDEND_RATE).alias("dividend_tax_rate"),
        F.coalesce(
            _region("signature_date"),
            first_match(line, [r"(\d{4}\s*년\s*\d{1,2}\s*월\s*\d{1,2}\s*일)", r"(\d{4}[./-]\d{1,2}[./-]\d{1,2})"]),
        ).alias("signature_date"),
        contains_any(line, NON_RESIDENT_PHRASES).alias("contains_non_resident_heading"),
    )
    named = located.withColumns({
        "applicant_name": norm_name(F.col("applicant_name")), "address": norm_address(F.col("address")),
        "dividend_tax_rate": norm_percent(F.col("dividend_tax_rate")), "signature_date": norm_iso_date(F.col("signature_date")),
    }).withColumns({
        "all_words": F.transform(tokens(F.col("applicant_name")), lambda w: strip_chars(w, ".")),
        "residency_country": F.coalesce("residency_country", "address"),
    }).withColumns({
        "words": F.filter("all_words", lambda w: w != ""), "residency_country": norm_country(F.col("residency_country")),
    }).withColumn("code_found", F.coalesce("code_found", "residency_country", "address"))
    words, count = F.col("words"), F.size("words")
    initial = nonempty(F.upper(F.substring(F.get(words, F.lit(1)), 1, 1)))
    settled = named.withColumns({
        "last_name": norm_name(F.coalesce(
            _compact_person(F.col("last_name_words")), F.when(count >= 2, F.try_element_at(words, F.lit(-1))), F.col("last_found")
        )),
        "first_name": norm_name(F.coalesce(
            _compact_person(F.col("first_name_words")), F.when(count >= 2, F.get(words, F.lit(0))), F.col("first_found")
        )),
        "middle_name": norm_name(F.coalesce(
            _compact_person(F.col("middle_name_words")), F.when(count >= 3, initial), F.col("middle_found")
        )),
        "residency_country_code": F.coalesce(norm_country_code(F.col("code_region")), norm_country_code(F.col("code_found"))),
    })
    everyone = F.col("all_words")
    short = (F.size(tokens(F.col("middle_name"))) == 1) & (F.length("middle_name") <= 4)
    same_person = (
        F.col("first_name").isNotNull() & F.col("last_name").isNotNull() & (F.size(everyone) >= 3)
        & (F.lower(F.get(everyone, F.lit(0))) == F.lower("first_name"))
        & (F.lower(F.try_element_at(everyone, F.lit(-1))) == F.lower("last_name"))
    )
    middle = F.when(~short & same_person, F.upper(F.substring(F.get(everyone, F.lit(1)), 1, 1))).when(
        F.col("middle_name").isNull() & same_person, F.upper(F.substring(F.get(everyone, F.lit(1)), 1, 1))
    ).otherwise(F.col("middle_name"))
    return _finish(settled.withColumn("middle_name", middle), K.WITHHOLDING, K.WITHHOLDING_FIELDS, ["contains_non_resident_heading"])


def _state_find(position: int) -> Column:
    """Pick the pattern set by template, then search; unknown templates use the generic set."""
    found = find(F.col("single_line"), GENERIC_PATTERNS[position])
    for template, patterns in STATE_PATTERNS.items():
        found = F.when(F.col("doc.template_id") == template, find(F.col("single_line"), patterns[position])).otherwise(found)
    return found


def _apostille(docs: DataFrame) -> DataFrame:
    line = F.col("single_line")
    located = _staged(docs, K.APOSTILLE).select(
        "doc",
        F.coalesce(find(line, r"Country[:\s]+(.+?)(?=\s+2\.|$)"), _region("issuing_country")).alias("issuing_country"),
        F.coalesce(find(line, r"has been signed by[:\s]*(.+?)(?=\s+3\.|$)"), _region("signed_by")).alias("signed_by"),
        F.coalesce(
            _region("signer_capacity"),
            find(line, r"acting in the capacity of\s+(.+?)(?=\s+4\.|\s+bears the seal|$)"),
        ).alias("signer_capacity"),
        F.coalesce(_state_find(2), _region("seal_owner")).alias("seal_owner"),
        F.coalesce(find(line, PLACE), _region("issued_at")).alias("issued_at"),
        F.coalesce(_state_find(1), _region("issued_on")).alias("issued_on"),
        F.coalesce(_state_find(0), _region("issuing_authority")).alias("issuing_authority"),
        squash(join_present(" ", _region("certificate_number"), item_block(line, 8))).alias("number_source"),
        contains_any(line, APOSTILLE_PHRASES).alias("has_apostille_heading"),
    )
    cleaned = located.select(
        "doc", "has_apostille_heading",
        clean_item(F.col("issuing_country"), ["This public document"]).alias("issuing_country"),
        clean_item(F.col("signed_by"), ["acting in the capacity"]).alias("signed_by"),
        norm_capacity(clean_item(F.col("signer_capacity"), ["bears the seal"])).alias("signer_capacity"),
        clean_item(F.col("seal_owner"), ["CERTIFIED"]).alias("seal_owner"),
        clean_item(F.col("issued_at"), ["the", "by"], commas=True).alias("issued_at"),
        norm_apostille_date(clean_item(F.col("issued_on"), ["by"])).alias("issued_on"),
        norm_authority(clean_item(F.col("issuing_authority"), ["8.", "9.", "10."])).alias("issuing_authority"),
        clean_item(first_match(F.col("number_source"), [r"(?:NO\.?|No\.?)\s*([A-Z0-9-]+)", r"(\d+)"])).alias(
            "certificate_number"
        ),
    )
    cleaned = cleaned.withColumn("issuing_country", norm_issuing_country(F.col("issuing_country")))
    filled = F.size(F.array_compact(F.array(*K.APOSTILLE_FIELDS))).alias("filled_item_count")
    return _finish(cleaned.select("*", filled), K.APOSTILLE, K.APOSTILLE_FIELDS, ["has_apostille_heading", "filled_item_count"])


EXTRACTORS = {K.RESIDENCY: _residency, K.APOSTILLE: _apostille, K.WITHHOLDING: _withholding}


def _only(docs: DataFrame, kind: str) -> DataFrame:
    rows = EXTRACTORS[kind](spread(docs.filter(F.col("document_type") == kind)))
    return rows.withColumnRenamed(f"fields_{kind}", "fields").drop(*TEXTS)


def extract_residency(docs: DataFrame) -> DataFrame:
    return _only(docs, K.RESIDENCY)


def extract_withholding(docs: DataFrame) -> DataFrame:
    return _only(docs, K.WITHHOLDING)


def extract_apostille(docs: DataFrame) -> DataFrame:
    return _only(docs, K.APOSTILLE)


def extract_all(docs: DataFrame) -> DataFrame:
    """All three types in one pass over the papers; flags of other types are null."""
    docs = spread(docs)
    for extract in EXTRACTORS.values():
        docs = extract(docs)
    per_type = [f"fields_{kind}" for kind in EXTRACTORS]
    return docs.withColumn("fields", F.coalesce(*per_type)).drop(*per_type, *TEXTS)
