"""Accuracy of run results against expected cases, and comparison of two evaluations.

``expected``: one row per expected case and document type (``expected_fields`` map).
``run_results``: one row per case with its ``extracted_documents`` array and ``review_result``.
The two meet in one join by ``case_id``; all comparing is done inside the joined row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.functions.errors import cer, wer
from paperloom.functions.predicates import field_group
from paperloom.functions.text import present

RATES = ("exact_match_rate", "average_character_error_rate", "average_word_error_rate")
QUALITY_FLAGS = (
    "has_certification_text", "has_irs_heading", "has_apostille_heading", "contains_non_resident_heading",
    "seal_present", "signature_present", "all_no_boxes_checked", "blurry", "low_ocr_confidence",
)


def _first_document(documents: Column, document_type: Column) -> Column:
    """First paper of the wanted type; null when there is none."""
    return F.get(F.filter(documents, lambda d: d["document_type"] == document_type), F.lit(0))


def _with_target(expected: DataFrame, run_results: DataFrame, how: str) -> DataFrame:
    actual = run_results.select("case_id", "extracted_documents", "review_result", F.lit(True).alias("ran"))
    return expected.join(actual, "case_id", how).withColumn(
        "target", _first_document(F.col("extracted_documents"), F.col("document_type"))
    )


# --- field comparison ---------------------------------------------------------

def _complete(expected: DataFrame, case_ids: DataFrame | None) -> DataFrame:
    rows = expected.filter("case_id IS NOT NULL AND document_type IS NOT NULL")
    return rows if case_ids is None else rows.join(case_ids.select("case_id"), "case_id", "left_semi")


def compare_fields(expected: DataFrame, run_results: DataFrame, case_ids: DataFrame | None = None) -> DataFrame:
    """One row per expected field of every case that ran."""
    wanted = _complete(expected, case_ids).select("case_id", "document_type", "expected_fields")
    # only field maps travel through the join
    actual = run_results.select(
        "case_id",
        F.transform(
            "extracted_documents", lambda d: F.struct(d["document_type"].alias("document_type"), d["fields"].alias("fields"))
        ).alias("documents"),
    )
    joined = wanted.join(actual, "case_id").select(
        "case_id", "document_type",
        _first_document(F.col("documents"), F.col("document_type"))["fields"].alias("actual_fields"),
        F.explode("expected_fields").alias("field_name", "expected"),
    ).withColumn("actual", F.try_element_at("actual_fields", F.col("field_name")))
    return compare_texts(joined.drop("actual_fields"))


def compare_texts(pairs: DataFrame) -> DataFrame:
    """Add exact match and error rates to rows holding ``expected`` and ``actual``.

    The match is on the raw values, so an expected '' against a missing value is no match
    though its error rate is zero.
    """
    expected, actual = F.col("expected"), F.col("actual")
    return pairs.withColumns({
        "exact_match": expected.eqNullSafe(actual),
        "character_error_rate": cer(expected, actual),
        "word_error_rate": wer(expected, actual),
    })


def field_metrics(comparisons: DataFrame) -> DataFrame:
    """Counts and mean rates per document type and field."""
    return comparisons.groupBy("document_type", "field_name").agg(
        F.count(F.lit(1)).alias("comparisons"),
        F.count_if("exact_match").alias("exact_matches"),
        F.avg("character_error_rate").alias("average_character_error_rate"),
        F.avg("word_error_rate").alias("average_word_error_rate"),
    ).select(
        F.concat_ws(".", "document_type", "field_name").alias("field_key"), "comparisons", "exact_matches",
        (F.col("exact_matches") / F.col("comparisons")).alias("exact_match_rate"),
        "average_character_error_rate", "average_word_error_rate",
    )


def missing_cases(expected: DataFrame, run_results: DataFrame, case_ids: DataFrame | None = None) -> DataFrame:
    """Expected cases without a run result, one row per expected row."""
    return _complete(expected, case_ids).select("case_id").join(run_results.select("case_id"), "case_id", "left_anti")


def compared_cases(comparisons: DataFrame) -> DataFrame:
    return comparisons.agg(F.count_distinct("case_id").alias("compared_cases"))


# --- roll-ups -------------------------------------------------------------------

def _weighted(rate: str) -> Column:
    total = F.sum("comparisons")
    return F.when(total > 0, F.sum(F.col(rate) * F.col("comparisons")) / total).otherwise(0.0).alias(rate)


def rollup(metrics: DataFrame) -> DataFrame:
    """Roll field metrics up to document type, field group and overall in one pass.

    Output ``level`` is ``document_type``, ``field_group`` or ``overall`` and ``key`` its value.
    Grouping sets expand the field metrics, which are few, not the comparisons.
    """
    name = F.substring_index("field_key", ".", 1)
    field = F.when(F.col("field_key").contains("."), F.expr("substring(field_key, instr(field_key, '.') + 1)"))
    keyed = metrics.withColumn("type_key", name).withColumn(
        "group_key", field_group(F.coalesce(F.nullif(field, F.lit("")), F.col("field_key")))
    )
    total = F.sum("comparisons")
    rolled = keyed.groupingSets([["type_key"], ["group_key"], []], "type_key", "group_key").agg(
        F.grouping_id("type_key", "group_key").alias("grouping"),
        F.coalesce(total, F.lit(0)).alias("comparisons"),
        F.coalesce(F.sum("exact_matches"), F.lit(0)).alias("exact_matches"),
        F.when(total > 0, F.sum("exact_matches") / total).otherwise(0.0).alias("exact_match_rate"),
        _weighted("average_character_error_rate"), _weighted("average_word_error_rate"),
    )
    level = F.when(F.col("grouping") == 1, "document_type").when(F.col("grouping") == 2, "field_group").otherwise("overall")
    key = F.when(F.col("grouping") == 1, F.col("type_key")).when(F.col("grouping") == 2, F.col("group_key")).otherwise("overall")
    return rolled.select(level.alias("level"), key.alias("key"), "comparisons", "exact_matches", *RATES)


def by_level(metrics: DataFrame) -> DataFrame:
    """Field metrics and their three roll-ups as one table of (level, key)."""
    fields = metrics.select(
        F.lit("field").alias("level"), F.col("field_key").alias("key"), "comparisons", "exact_matches", *RATES
    )
    return fields.unionByName(rollup(metrics))


# --- comparison of two evaluations ----------------------------------------------

def _signals(deltas: list[tuple[Column, int]], tolerance: float = 0.0) -> Column:
    """improved / regressed / mixed / unchanged from signed differences (sign: +1 more is better)."""
    good, bad = F.lit(False), F.lit(False)
    for delta, sign in deltas:
        good = good | (delta * sign > tolerance)
        bad = bad | (delta * sign < -tolerance)
    return F.when(good & bad, "mixed").when(good, "improved").when(bad, "regressed").otherwise("unchanged")


def compare_metrics(baseline: DataFrame, candidate: DataFrame, keys: tuple[str, ...] = ("level", "key")) -> DataFrame:
    """Match the metrics of two evaluations and classify the change of each key."""
    values = ["comparisons", "exact_matches", *RATES]
    left = baseline.select(*keys, *[F.col(v).alias(f"baseline_{v}") for v in values])
    right = candidate.select(*keys, *[F.col(v).alias(f"candidate_{v}") for v in values])
    joined = left.join(right, list(keys), "full_outer")
    delta = lambda v: F.col(f"candidate_{v}") - F.col(f"baseline_{v}")
    classified = joined.select(
        "*", delta("comparisons").alias("comparison_delta"), *[delta(r).alias(f"{r}_delta") for r in RATES]
    )
    changed = _signals(
        [(F.col(f"{RATES[0]}_delta"), 1), (F.col(f"{RATES[1]}_delta"), -1), (F.col(f"{RATES[2]}_delta"), -1)], K.TOLERANCE
    )
    status = F.when(F.col("baseline_comparisons").isNull(), "added").when(
        F.col("candidate_comparisons").isNull(), "removed"
    ).otherwise(changed)
    return classified.withColumn("status", status)


def severity(deltas: DataFrame) -> DataFrame:
    """Flag severe regressions and notable improvements."""
    match, characters, words = (F.coalesce(f"{r}_delta", F.lit(0.0)) for r in RATES)
    worse = (match <= -K.SEVERE_MATCH) | (characters >= K.SEVERE_CER) | (words >= K.SEVERE_WER)
    better = (match >= K.SEVERE_MATCH) | (characters <= -K.SEVERE_CER) | (words <= -K.SEVERE_WER)
    return deltas.withColumns({
        "severe_regression": (F.col("status") == "regressed") & worse,
        "notable_improvement": (F.col("status") == "improved") & better,
    })


def missing_diff(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """Cases missing in only one of two reports: ``resolved`` or ``new``."""
    old, new = baseline.select("case_id"), candidate.select("case_id")
    return old.subtract(new).select("case_id", F.lit("resolved").alias("change")).unionByName(
        new.subtract(old).select("case_id", F.lit("new").alias("change"))
    )


def promotion(
    deltas: DataFrame, baseline_cases: DataFrame, candidate_cases: DataFrame, missing: DataFrame
) -> DataFrame:
    """Promotion verdict in one row.

    ``deltas`` as of :func:`compare_metrics` over all levels, the two case tables one
    ``compared_cases`` row each, ``missing`` as of :func:`missing_diff`.  The facts are stacked and
    aggregated once, so no side has to be paired with another.
    """
    field = severity(deltas).select(
        "level", "key", "status", "severe_regression", "notable_improvement",
        (F.col("comparison_delta") < 0).alias("shrunk"),
    )
    facts = (
        field.unionByName(baseline_cases.select(F.col("compared_cases").alias("before")), allowMissingColumns=True)
        .unionByName(candidate_cases.select(F.col("compared_cases").alias("after")), allowMissingColumns=True)
        .unionByName(
            missing.filter("change = 'new'").agg(F.count(F.lit(1)).alias("new_missing")), allowMissingColumns=True
        )
    )
    on_field = F.col("level") == "field"
    overall = F.col("level") == "overall"
    keys = lambda test: F.array_sort(F.collect_set(F.when(on_field & test, F.col("key"))))
    # field keys are a closed set, so the three lists stay short
    row = facts.agg(
        F.coalesce(F.max("before"), F.lit(0)).alias("before"), F.coalesce(F.max("after"), F.lit(0)).alias("after"),
        F.coalesce(F.max("new_missing"), F.lit(0)).alias("new_missing"),
        F.max(F.when(overall, F.col("status"))).alias("overall"),
        *[F.count_if(on_field & (F.col("status") == s)).alias(s) for s in ("regressed", "mixed", "removed")],
        keys(F.col("severe_regression")).alias("severe_regressed_fields"),
        keys(F.col("shrunk")).alias("coverage_regressed_fields"),
        keys(F.col("notable_improvement")).alias("notable_improved_fields"),
    )
    dropped = F.col("after") < F.col("before")
    is_overall = lambda s: F.coalesce(F.col("overall") == s, F.lit(False))
    reasons = row.withColumns({
        "blocking_reasons": present(
            (F.col("new_missing") > 0, "new_missing_cases"),
            (dropped, "candidate_compared_cases_dropped"),
            (is_overall("regressed"), "overall_delta_regressed"),
        ),
        "warning_reasons": present(
            (F.size("severe_regressed_fields") > 0, "severe_field_regressions"),
            (F.col("regressed") > 0, "field_regressions"),
            (F.col("mixed") > 0, "mixed_field_deltas"),
            (F.col("removed") > 0, "removed_fields"),
            ((F.size("coverage_regressed_fields") > 0) & ~dropped, "reduced_field_coverage"),
            (is_overall("mixed"), "overall_delta_mixed"),
        ),
    })
    status = F.when(F.size("blocking_reasons") > 0, K.REJECT).when(F.size("warning_reasons") > 0, "review").otherwise("promote")
    return reasons.select(
        status.alias("status"), "blocking_reasons", "warning_reasons", "severe_regressed_fields",
        "coverage_regressed_fields", "notable_improved_fields",
    )


PROFILE_COUNTS = (
    "train_count", "val_count", "train_source_count", "val_source_count", "unique_hard_case_variant_count",
)


def readiness_rank(status: Column) -> Column:
    rank = F.lit(-1)
    for name, value in K.READINESS_RANK.items():
        rank = F.when(status == name, value).otherwise(rank)
    return rank


def compare_profiles(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """Change of the training profile of each field group between two summaries."""
    values = [*PROFILE_COUNTS, "hard_case_train_ratio", "training_readiness_status"]
    left = baseline.select("field_group", *[F.col(v).alias(f"baseline_{v}") for v in values])
    right = candidate.select("field_group", *[F.col(v).alias(f"candidate_{v}") for v in values])
    delta = lambda v: F.col(f"candidate_{v}") - F.col(f"baseline_{v}")
    before, after = F.col("baseline_training_readiness_status"), F.col("candidate_training_readiness_status")
    joined = left.join(right, "field_group", "full_outer").select(
        "*",
        *[delta(v).alias(f"{v}_delta") for v in PROFILE_COUNTS],
        F.round(delta("hard_case_train_ratio"), 4).alias("hard_case_train_ratio_delta"),
        F.when(before.isNotNull() & after.isNotNull(), readiness_rank(after) - readiness_rank(before)).alias(
            "readiness_rank_delta"
        ),
        F.concat(before, F.lit("->"), after).alias("readiness_transition"),
    )
    changed = _signals([(F.col("readiness_rank_delta"), 1), *[(F.col(f"{v}_delta"), 1) for v in PROFILE_COUNTS]])
    status = F.when(F.col("baseline_train_count").isNull(), "added").when(
        F.col("candidate_train_count").isNull(), "removed"
    ).otherwise(changed)
    return joined.withColumn("status", status)


# --- case evaluation -------------------------------------------------------------

def _shown(value: Column) -> Column:
    """A text as it appears in mismatch messages: quoted, or None."""
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    double = value.contains("'") & ~value.contains('"')
    quoted = F.when(double, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )
    return F.coalesce(quoted, F.lit("None"))


def _shown_flag(value: Column) -> Column:
    return F.when(value, "True").when(~value, "False").otherwise("None")


def _unequal(expected: Column, actual_of, label: str, shown) -> Column:
    """Messages for the entries of an expected map that differ from the actual value."""
    entries = F.coalesce(F.map_entries(expected), F.array())

    def message(entry: Column) -> Column:
        actual = actual_of(entry["key"])
        text = F.concat(
            F.lit(f"expected {label} "), entry["key"], F.lit("="), shown(entry["value"]), F.lit(", got "), shown(actual)
        )
        return F.when(~actual.eqNullSafe(entry["value"]), text)

    return F.array_compact(F.transform(entries, message))


def evaluate(expected: DataFrame, run_results: DataFrame) -> DataFrame:
    """Check every expected case that ran; keep the text of each mismatch in a fixed order."""
    joined = _with_target(expected, run_results, "inner").withColumn(
        "flags",
        F.map_from_arrays(
            F.array(*[F.lit(f) for f in QUALITY_FLAGS]), F.array(*[F.col(f"target.quality_checks.{f}") for f in QUALITY_FLAGS])
        ),
    )
    status = F.col("review_result.status")
    wrong_status = F.coalesce(F.col("expected_status") != status, F.lit(False))
    no_document = F.col("document_type").isNotNull() & F.col("target").isNull()
    codes = F.transform(F.coalesce("review_result.findings", F.array()), lambda f: f["code"])
    absent = F.array_sort(F.array_except(F.coalesce("expected_finding_codes", F.array().cast("array<string>")), codes))
    crossed = lambda key: F.when(key == "matched", F.col("review_result.cross_check.matched"))
    mismatches = F.concat(
        F.array_compact(F.array(
            F.when(wrong_status, F.concat(F.lit("expected status "), "expected_status", F.lit(", got "), status)),
            F.when(no_document, F.concat(F.lit("missing document type "), "document_type", F.lit(" in run result"))),
        )),
        _unequal(F.col("expected_fields"), lambda k: F.try_element_at("target.fields", k), "field", _shown),
        _unequal(F.col("expected_quality_checks"), lambda k: F.try_element_at("flags", k), "quality check", _shown_flag),
        F.array_compact(F.array(
            F.when(F.size(absent) > 0, F.concat(F.lit("missing finding codes: "), F.array_join(absent, ", ")))
        )),
        _unequal(F.col("expected_cross_check"), crossed, "cross_check", _shown_flag),
    )
    return joined.select("case_id", "document_type", mismatches.alias("mismatches")).withColumn(
        "passed", F.size("mismatches") == 0
    )


# --- evaluation suite --------------------------------------------------------------

def suite_cases(expected: DataFrame, labels: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents per case, missing cases).

    A case runs with every label of the same case id whose source file exists.  Documents come as
    rows with their position by type, not as one list per case.
    """
    usable = labels.filter(
        F.col("source_path").isNotNull() & F.col("document_type").isNotNull() & ~F.col("source_path").contains("://")
    ).select("case_id", "document_type", "source_path")
    available = usable.join(files.select(F.col("path").alias("source_path")), "source_path", "left_semi")
    wanted = expected.select("case_id").distinct()
    documents = available.join(wanted, "case_id", "left_semi")
    return documents, wanted.join(available.select("case_id"), "case_id", "left_anti")
