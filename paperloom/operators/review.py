"""Review rules, cross-document check, case status and queue gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.functions.normalize import UNITED_STATES, canonical_name
from paperloom.functions.predicates import plausible_date, valid_tin
from paperloom.functions.text import join_present, nonempty, strip
from paperloom.session import spread

NO_PARTNER = "cross-check skipped because one of the documents is missing"
NOT_EQUAL = "one or more cross-check fields do not match"


def _value(name: str) -> Column:
    return nonempty(F.try_element_at("fields", F.lit(name)))


def _missing(name: str) -> Column:
    return _value(name).isNull()


def _differs(name: str, *allowed: str) -> Column:
    return ~F.coalesce(_value(name).isin(*allowed), F.lit(False))


def _not_true(name: str) -> Column:
    """A mark must be exactly true: unknown counts as absent."""
    return ~F.coalesce(F.col(f"quality_checks.{name}"), F.lit(False))


def _sql_text(value: str | None) -> str:
    return "CAST(NULL AS STRING)" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def finding(code: str, message: str, field: str | None = None) -> Column:
    return F.expr(
        f"named_struct('code', {_sql_text(code)}, 'message', {_sql_text(message)}, 'field_name', {_sql_text(field)})"
    )


def _collect(*rules: tuple[Column, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(broken, found) for broken, found in rules]))


def residency_findings() -> Column:
    country = "Residency country must be United States of America."
    return _collect(
        (_missing("taxpayer_name"), finding("required_name_missing", "Taxpayer name is missing.", "taxpayer_name")),
        (~valid_tin(_value("tin")), finding("required_tin_invalid", "TIN format is invalid.", "tin")),
        (_missing("tax_year"), finding("required_tax_year_missing", "Tax year is missing.", "tax_year")),
        (_missing("issue_date"), finding("required_issue_date_missing", "Issue date is missing.", "issue_date")),
        (_differs("residency_country", UNITED_STATES),
         finding("required_residency_country_invalid", country, "residency_country")),
        (_differs("residency_country_code", "US"),
         finding("required_residency_country_code_invalid", "Residency country code must be US.", "residency_country_code")),
        (_not_true("has_certification_text"),
         finding("required_certification_text_missing", "Certification text is missing.")),
        (_not_true("seal_present"),
         finding("required_certification_seal_missing", "Certification seal was not detected.", "seal_present")),
        (_not_true("signature_present"),
         finding("required_signature_missing", "Signature was not detected.", "signature_present")),
    )


def apostille_findings() -> Column:
    return _collect(
        (_not_true("has_apostille_heading"), finding("required_apostille_heading_missing", "Apostille heading not found.")),
        *[
            (_missing(name), finding("required_apostille_field_missing", f"Apostille field {name} is missing.", name))
            for name in K.APOSTILLE_FIELDS
        ],
        (~plausible_date(_value("issued_on")),
         finding("required_apostille_date_invalid", "Apostille date is incomplete or invalid.", "issued_on")),
        (_not_true("seal_present"), finding("required_seal_missing", "Apostille seal/stamp was not detected.", "seal_present")),
        (_not_true("signature_present"),
         finding("required_signature_missing", "Apostille signature was not detected.", "signature_present")),
    )


def withholding_findings() -> Column:
    country = "Residency country must be United States of America."
    return _collect(
        (_missing("first_name") | _missing("last_name"), finding("required_name_missing", "First/last name is missing.")),
        (_missing("address"), finding("required_address_missing", "Address is missing.", "address")),
        (~valid_tin(_value("tin")), finding("required_tin_invalid", "TIN format is invalid.", "tin")),
        (_differs("residency_country", UNITED_STATES, "USA"),
         finding("required_residency_country_invalid", country, "residency_country")),
        (_differs("residency_country_code", "US"),
         finding("required_residency_country_code_invalid", "Residency country code must be US.", "residency_country_code")),
        (_differs("dividend_tax_rate", "15%"),
         finding("required_dividend_rate_invalid", "Dividend tax rate must be 15%.", "dividend_tax_rate")),
        (_missing("signature_date"),
         finding("required_signature_date_missing", "Signature date is missing.", "signature_date")),
        (_not_true("all_no_boxes_checked"),
         finding("required_no_checkbox_missing", "All 'No' checkboxes must be checked.", "all_no_boxes_checked")),
        (_not_true("signature_present"),
         finding("required_signature_missing", "Signature was not detected.", "signature_present")),
    )


RULES = {
    K.RESIDENCY: residency_findings, K.APOSTILLE: apostille_findings, K.WITHHOLDING: withholding_findings,
}


def document_findings(docs: DataFrame) -> DataFrame:
    """Add the ordered ``findings`` array of each document by the rule set of its type."""
    found = F.lit(None).cast("array<struct<code:string,message:string,field_name:string>>")
    for kind, rules in RULES.items():
        found = F.when(F.col("document_type") == kind, rules()).otherwise(found)
    return docs.withColumn("findings", found)


def _review_one(docs: DataFrame, kind: str) -> DataFrame:
    rows = docs.filter(F.col("document_type") == kind).withColumn("findings", RULES[kind]())
    # the outer form: an inner explode makes Spark test the array first, that is run the rules twice
    exploded = rows.select("case_id", F.posexplode_outer("findings").alias("pos", "finding")).filter("finding IS NOT NULL")
    return exploded.select("case_id", "pos", "finding.*")


def review_residency(docs: DataFrame) -> DataFrame:
    return _review_one(docs, K.RESIDENCY)


def review_apostille(docs: DataFrame) -> DataFrame:
    return _review_one(docs, K.APOSTILLE)


def review_withholding(docs: DataFrame) -> DataFrame:
    return _review_one(docs, K.WITHHOLDING)


def pick_document(docs: DataFrame, which: str = "last") -> DataFrame:
    """One document per case and type: review looks at the last, evaluation at the first.

    ``max_by``/``min_by`` merge on the map side, so a case with very many papers is no hot spot.
    """
    pick = F.max_by if which == "last" else F.min_by
    payload = F.struct(*[c for c in docs.columns if c not in ("case_id", "document_type")])
    return docs.groupBy("case_id", "document_type").agg(pick(payload, F.col("position")).alias("picked")).select(
        "case_id", "document_type", "picked.*"
    )


CROSS_FIELDS = ("tin", "residency_country", "residency_country_code")


def _cross_findings(left: Column, right: Column) -> Column:
    """Findings of comparing two field maps; a null map stands for a missing paper."""
    def of(side: Column, name: str) -> Column:
        return nonempty(F.try_element_at(side, F.lit(name)))

    rules = [
        (
            F.coalesce(strip(of(left, name)) != strip(of(right, name)), F.lit(False)),
            finding("required_cross_check_mismatch", f"Cross-check mismatch for {name}.", name),
        )
        for name in CROSS_FIELDS
    ]
    person = nonempty(strip(join_present(" ", *[of(right, n) for n in ("first_name", "middle_name", "last_name")])))
    taxpayer = of(left, "taxpayer_name")
    rules.append((
        taxpayer.isNotNull() & person.isNotNull() & (canonical_name(taxpayer) != canonical_name(person)),
        finding("required_cross_check_mismatch", "Cross-check mismatch for taxpayer name.", "taxpayer_name"),
    ))
    both = left.isNotNull() & right.isNotNull()
    nothing = F.array().cast("array<struct<code:string,message:string,field_name:string>>")
    return F.when(both, _collect(*rules)).otherwise(nothing)


def cross_check(docs: DataFrame) -> DataFrame:
    """Compare the latest residency and withholding papers of each case: one shuffle by case."""
    latest = lambda kind: F.max_by("fields", F.when(F.col("document_type") == kind, F.col("position")))
    sides = docs.groupBy("case_id").agg(latest(K.RESIDENCY).alias("left"), latest(K.WITHHOLDING).alias("right"))
    checked = sides.withColumn("findings", _cross_findings(F.col("left"), F.col("right")))
    both = F.col("left").isNotNull() & F.col("right").isNotNull()
    return checked.select(
        "case_id",
        (both & (F.size("findings") == 0)).alias("matched"),
        F.when(~both, F.lit(NO_PARTNER)).when(F.size("findings") > 0, F.lit(NOT_EQUAL)).alias("reason"),
        "findings",
    )


def status_of(findings: Column) -> Column:
    severe = F.exists(findings, lambda f: f["code"].startswith("required_"))
    return F.when(severe, K.REJECT).when(F.size(findings) == 0, K.PASS).otherwise(K.NEEDS_REVIEW)


def case_status(cases: DataFrame, findings: DataFrame) -> DataFrame:
    """Status of every case from a table of finding rows; a case without rows passes.

    Findings are reduced to two numbers per case before the join.
    """
    counted = findings.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("findings"), F.count_if(F.col("code").startswith("required_")).alias("severe")
    )
    joined = cases.select("case_id").join(counted, "case_id", "left")
    status = F.when(F.coalesce("severe", F.lit(0)) > 0, K.REJECT).when(
        F.coalesce("findings", F.lit(0)) == 0, K.PASS
    ).otherwise(K.NEEDS_REVIEW)
    return joined.select("case_id", status.alias("status"), F.coalesce("findings", F.lit(0)).alias("finding_count"))


def review_cases(docs: DataFrame) -> DataFrame:
    """Everything about a case in one shuffle: latest papers, findings, cross-check, status, gate.

    Rules run before the shuffle, so only fields, findings and two flags of a paper travel, and
    partial aggregation keeps one paper per case and type on each map task.
    """
    ruled = document_findings(docs if docs.isStreaming else spread(docs)).select(
        "case_id", "document_type", "position", "fields", "findings",
        F.coalesce("quality_checks.blurry", F.lit(False)).alias("blurry"),
        F.coalesce("quality_checks.low_ocr_confidence", F.lit(False)).alias("low_confidence"),
    )
    latest = lambda kind: F.max_by(
        F.struct("fields", "findings"), F.when(F.col("document_type") == kind, F.col("position"))
    )
    cases = ruled.groupBy("case_id").agg(
        *[latest(kind).alias(kind) for kind in K.DOCUMENT_TYPES],
        F.bool_or("blurry").alias("blurry"), F.bool_or("low_confidence").alias("low_confidence"),
        F.count(F.lit(1)).alias("document_count"),
    )
    return finish_cases(cases)


def finish_cases(cases: DataFrame) -> DataFrame:
    """From the latest papers per type to the review result; shared by batch and stream."""
    nothing = F.array().cast("array<struct<code:string,message:string,field_name:string>>")
    kept = [c for c in cases.columns if c not in K.DOCUMENT_TYPES]
    cross = _cross_findings(F.col(f"{K.RESIDENCY}.fields"), F.col(f"{K.WITHHOLDING}.fields"))
    crossed = cases.withColumn("cross_findings", cross)
    found = F.concat(
        *[F.coalesce(F.col(f"{kind}.findings"), nothing) for kind in K.DOCUMENT_TYPES], F.col("cross_findings")
    )
    both = F.col(K.RESIDENCY).isNotNull() & F.col(K.WITHHOLDING).isNotNull()
    results = crossed.select(
        *kept, found.alias("findings"), (both & (F.size("cross_findings") == 0)).alias("matched"),
        F.when(~both, F.lit(NO_PARTNER)).when(F.size("cross_findings") > 0, F.lit(NOT_EQUAL)).alias("reason"),
    ).withColumn("status", status_of(F.col("findings")))
    return results.withColumn("queued", (F.col("status") != K.PASS) | F.col("blurry") | F.col("low_confidence"))


def queue_gate(cases: DataFrame, docs: DataFrame) -> DataFrame:
    """Cases that need a person: not passed, or any paper blurry or read with low confidence."""
    flagged = docs.groupBy("case_id").agg(
        F.bool_or(F.coalesce("quality_checks.blurry", F.lit(False))
                  | F.coalesce("quality_checks.low_ocr_confidence", F.lit(False))).alias("doubtful")
    )
    return cases.join(flagged, "case_id", "left").filter(
        (F.col("status") != K.PASS) | F.coalesce("doubtful", F.lit(False))
    ).select("case_id", "status")
