"""From a crop manifest to training readiness and the data gap report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from paperloom.operators import curate as C
from paperloom.operators import reports as R
from paperloom.session import cut_lineage


def training_summary(
    manifest: DataFrame, hard: DataFrame | None = None, include_rejected: bool = False, ratio: float | None = 0.5
) -> DataFrame:
    """Profile, warnings and readiness per field group."""
    # only what the reports read is shuffled and written, each row's source already found
    given = lambda df: df.withColumn("source_path", C.source_of(df.columns))
    columns = ["field_group", "split", "document_type", "source_type", "augmentation_type", "source_path", "text"]
    rows, caps, stale = C.training_set_and_stale(given(manifest), None if hard is None else given(hard), include_rejected, ratio, columns)
    # three reports read the set: write it once
    rows = cut_lineage(rows)
    return C.readiness(C.warnings(C.data_profile(rows, caps, stale)))


def gap_report(manifest: DataFrame, profiles: DataFrame | None = None, metrics: DataFrame | None = None) -> DataFrame:
    """Ranked field groups with score parts and recommendations."""
    accuracy = None if metrics is None else R.group_accuracy(metrics)
    return R.rank_gaps(R.gap_recommendations(R.gap_scores(manifest, profiles, accuracy)))
