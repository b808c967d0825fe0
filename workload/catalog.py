"""All queries, by section."""

from workload import q_curate, q_evaluate, q_extract, q_raster, q_reports, q_review, q_sources, q_splits

QUERIES = [
    query
    for section in (q_sources, q_extract, q_raster, q_review, q_evaluate, q_splits, q_curate, q_reports)
    for query in section.QUERIES
]
