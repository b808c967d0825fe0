"""Evaluation of run results and the comparison of two evaluations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from paperloom.operators import evaluate as E


@dataclass(frozen=True)
class FieldErrorReport:
    comparisons: DataFrame
    field_metrics: DataFrame
    missing_cases: DataFrame
    compared_cases: DataFrame


def field_error_report(expected: DataFrame, run_results: DataFrame, case_ids: DataFrame | None = None) -> FieldErrorReport:
    comparisons = E.compare_fields(expected, run_results, case_ids)
    return FieldErrorReport(
        comparisons, E.field_metrics(comparisons), E.missing_cases(expected, run_results, case_ids), E.compared_cases(comparisons)
    )


@dataclass(frozen=True)
class ReportComparison:
    deltas: DataFrame
    missing: DataFrame
    promotion: DataFrame
    profiles: DataFrame | None = None


def compare_reports(
    baseline: FieldErrorReport, candidate: FieldErrorReport,
    baseline_profiles: DataFrame | None = None, candidate_profiles: DataFrame | None = None,
) -> ReportComparison:
    """Field, type, group and overall deltas, changed missing cases, the promotion verdict and, where both
    runs' training profiles are given, the change of each field group's profile.
    """
    profiles = None
    if baseline_profiles is not None and candidate_profiles is not None:
        profiles = E.compare_profiles(baseline_profiles, candidate_profiles)
    deltas = E.compare_metrics(E.by_level(baseline.field_metrics), E.by_level(candidate.field_metrics))
    missing = E.missing_diff(baseline.missing_cases, candidate.missing_cases)
    return ReportComparison(
        E.severity(deltas), missing, E.promotion(deltas, baseline.compared_cases, candidate.compared_cases, missing), profiles
    )
