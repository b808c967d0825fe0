"""Wall time of the headline queries: one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores.  Every query runs once
to warm up on the smallest tables and once measured, its rows written to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paperloom.session import build_session  # noqa: E402
from workload.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "S3_latest_results", "F1_eligibility", "F5_masked_values", "K3_dictionary", "X2_document_text", "X7_residency_fields",
    "X8_withholding_fields", "X9_apostille_fields", "Q1_blur", "Q4_crop_quality", "Q7_salvage", "R7_reviewed_cases", "R8_review_run",
    "E2_field_comparison", "E5_field_metrics", "E8_metric_deltas", "E11_promotion_gate", "E1_case_evaluation", "D1_hash_split",
    "D2_repaired_split", "D5_leakage", "C2_crop_summary", "C3_hard_case_plan", "C4_donors", "C9_selected_hard_cases",
    "C11_data_profile", "G4_gap_scores", "G8_rejected_entries", "G9_coverage", "G12_sample_priority", "G13_queue_priority",
    "W1_streaming_intake",
)


def seconds(spark, query, folder: str) -> float:
    start = time.perf_counter()
    query.run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    spark = build_session(
        f"local[{cpus}]", app="bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = [q for q in QUERIES if q.name in HEADLINE and (len(sys.argv) < 2 or q.name in sys.argv[1:])]
    times = {}
    for query in chosen:
        if os.path.isdir(small):
            seconds(spark, query, small)
        times[query.name] = round(seconds(spark, query, folder), 3)
        print(query.name, times[query.name], file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline query wall time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
