"""Sources on hand-made files and round trips of the sinks."""

import json

import pytest
from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.operators import reports as R
from paperloom.plans.training import gap_report
from paperloom.sources import readers, writers


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False), encoding="utf-8")


def test_labels(spark, tmp_path):
    root = tmp_path / "labeled"
    put(root / "apostille" / "a 1+é" / "label.json", {"document_type": "apostille", "source_path": "x.png", "expected_fields": {"tin": "1", "odd": None}})
    put(root / "pending_review" / "apostille" / "b" / "label.json", {"case_id": "named", "document_type": "apostille"})
    put(root / "apostille" / "b" / "other.json", {"case_id": "ignored"})
    rows = {r.case_id: r for r in readers.labels(spark, str(root)).collect()}
    assert set(rows) == {"a 1+é", "named"}
    assert rows["named"].pending and not rows["a 1+é"].pending and not rows["a 1+é"].has_case_id
    assert rows["a 1+é"].expected_fields == {"tin": "1", "odd": None}
    assert R.labels_without_eval(readers.labels(spark, str(root)), spark.createDataFrame([], "case_id string")).count() == 1


def test_expected_cases(spark, tmp_path):
    put(tmp_path / "c1" / "expected.json", {"case_id": "x1", "document_type": "apostille", "expected_fields": {}})
    put(tmp_path / "c2" / "expected.json", {"case_id": "x2"})
    put(tmp_path / "deep" / "c3" / "expected.json", {"case_id": "x3", "document_type": "apostille"})
    assert {r.case_id for r in readers.expected_cases(spark, str(tmp_path)).collect()} == {"x1", "x3"}
    assert {r.case_id for r in readers.expected_cases(spark, str(tmp_path), id_from="folder").collect()} == {"c1", "c2"}


def test_run_results_keep_the_last_file(spark, tmp_path):
    paper = {"document_type": "apostille", "source_path": "x", "fields": {"tin": "1"}}
    put(tmp_path / "a.json", {"case_id": "c", "extracted_documents": [], "review_result": {"status": "pass"}})
    put(tmp_path / "b.json", {"case_id": "c", "extracted_documents": [paper], "review_result": {"status": "reject"}})
    put(tmp_path / "d.json", {"case_id": "no documents"})
    put(tmp_path / "sub" / "e.json", {"case_id": "deeper", "extracted_documents": []})
    rows = readers.run_results(spark, str(tmp_path)).collect()
    assert [(r.case_id, r.review_result.status, len(r.extracted_documents)) for r in rows] == [("c", "reject", 1)]


CROPS = [
    {"case_id": f"c{i}", "document_type": "apostille", "field_name": "issued_on", "field_group": "date", "text": f"날{i}", "split": "train" if i else "val",
     "source_path": f"s{i}.png", "crop_path": f"out/c{i}.png", "quality": {"accepted": i != 2, "quality_flags": [] if i != 2 else ["too_narrow"]}}
    for i in range(4)
]


def test_manifest(spark, tmp_path):
    put(tmp_path / "manifest.jsonl", "\n\n".join(json.dumps(c, ensure_ascii=False) for c in CROPS) + "\n")
    rows = readers.manifest(spark, str(tmp_path / "manifest.jsonl"))
    assert rows.count() == 4
    assert readers.manifest(spark, str(tmp_path / "absent.jsonl")).count() == 0
    writers.write_manifest(rows, str(tmp_path / "out"))
    assert (tmp_path / "out" / "group_folder=date" / "split_folder=val").is_dir()
    back = spark.read.schema(rows.schema).option("recursiveFileLookup", True).json(str(tmp_path / "out"))
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    writers.write_label_file(rows, str(tmp_path / "labels"), "out")
    assert {r.value for r in spark.read.text(str(tmp_path / "labels")).collect()} == {f"c{i}.png\t날{i}" for i in range(4)}
    writers.write_dictionary(rows, str(tmp_path / "dict"))
    assert [r.value for r in spark.read.text(str(tmp_path / "dict")).collect()] == sorted("날0123")


def test_inventory(spark, tmp_path):
    for name in ("train/apostille/a b.PNG", "train/apostille/c.txt", "val/tin/d.Pdf", "e.jpeg"):
        put(tmp_path / name, "x")
    rows = {r.filename: r for r in readers.inventory(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a b.PNG", "d.Pdf", "e.jpeg"}
    assert (rows["a b.PNG"].document_group, rows["a b.PNG"].split, rows["d.Pdf"].suffix) == ("apostille", "train", ".pdf")


def test_keyed_reports(spark, tmp_path):
    put(tmp_path / "summary.json", {"groups": {"date": {"train_count": 5, "data_profile": {"unique_source_counts": {"train": 2}}, "training_readiness": {"status": "blocked"}}, "tin": {}}})
    rows = {r.field_group: r for r in readers.training_profiles(spark, str(tmp_path / "summary.json")).collect()}
    assert (rows["date"].train_count, rows["date"].train_source_count, rows["date"].val_count, rows["date"].training_readiness_status) == (5, 2, 0, "blocked")
    assert rows["tin"].blocking_warnings == [] and rows["tin"].hard_case_train_ratio == 0.0
    put(tmp_path / "report.json", {"compared_cases": 1, "field_metrics": {"apostille.tin": {"comparisons": 2, "exact_match_rate": 0.5}}})
    row = readers.field_metrics(spark, str(tmp_path / "report.json")).first()
    assert (row.field_key, row.comparisons, row.exact_match_rate, row.average_word_error_rate) == ("apostille.tin", 2, 0.5, 0.0)


def test_report_round_trip(spark, tmp_path):
    put(tmp_path / "m.jsonl", "\n".join(json.dumps(c) for c in CROPS))
    gaps = gap_report(readers.manifest(spark, str(tmp_path / "m.jsonl")))
    writers.write_report(writers.report_json(gaps.select("field_group", "priority_score", "recommendations"), "priorities"), str(tmp_path / "report"))
    item = readers.gap_items(spark, str(tmp_path / "report" / "summary")).first()
    # 2 accepted train crops of 12, 1 val crop of 3, 2 of 3 and 1 of 2 sources, one rejected crop
    assert item.priority_score == 10 * 3 + 2 * 2 + 1 * 2.5 + 1 * 2 + 0.25
    assert item.recommendations[0] == "collect_base_train_samples" and item.recommendations[-1] == "review_rejected_field_crops"


def test_scaffolds_are_created_once(spark, tmp_path):
    root = str(tmp_path / "scaffolds")
    first = spark.createDataFrame([("a", "apostille", "one"), ("b", "apostille", "one")], "case_id string, document_type string, note string")
    second = spark.createDataFrame([("b", "apostille", "two"), ("c", "apostille", "two")], "case_id string, document_type string, note string")
    writers.write_scaffolds(first, root)
    writers.write_scaffolds(second, root)
    assert {(r.case_id, r.note) for r in writers.read_scaffolds(spark, root).collect()} == {("a", "one"), ("b", "one"), ("c", "two")}
    writers.write_scaffolds(second, root, overwrite=True)
    assert {(r.case_id, r.note) for r in writers.read_scaffolds(spark, root).collect()} == {("a", "one"), ("b", "two"), ("c", "two")}


def test_queue_batches_replace_each_other(spark, tmp_path):
    root = str(tmp_path / "queue")
    case = lambda status: spark.createDataFrame([("a", status)], "case_id string, status string")
    paper = spark.createDataFrame([("a", "p")], "case_id string, source_path string")
    for batch, status in (("001", "reject"), ("002", "pass"), ("002", "needs_review")):
        writers.write_queue(case(status), paper, root, batch)
    cases, papers = writers.read_queue(spark, root)
    assert [r.status for r in cases.collect()] == ["needs_review"] and papers.count() == 1


def gaps_of(spark, rows):
    return spark.createDataFrame(rows, "field_group string, priority_score double, train_gap double, train_source_gap double, val_gap double, val_source_gap double, training_readiness_status string, blocking_warnings array<string>, recommendations array<string>")


def test_queue_score(spark):
    gaps = gaps_of(spark, [("date", 37.5, 0.0, 0.0, 0.0, 0.0, None, None, ["r1"]), ("english_name_org", 25.5, 0.0, 0.0, 0.0, 0.0, None, None, ["r2", "r1"])])
    cases = spark.createDataFrame([("q1", "reject", 1), ("q2", "needs_review", 0), ("q3", "reject", 9), ("empty", "reject", 1)], "case_id string, status string, finding_count int")
    docs = spark.createDataFrame([
        ("q1", K.WITHHOLDING, {"signature_date": "x", "first_name": "A"}), ("q2", K.APOSTILLE, {"signed_by": "B"}), ("q3", K.APOSTILLE, {"signed_by": "C"}),
    ], "case_id string, document_type string, fields map<string,string>")
    labels = spark.createDataFrame([("q3", K.APOSTILLE, False)], "case_id string, document_type string, pending boolean")
    rows = sorted(R.ranked_queue(R.queue_priority(cases, docs, gaps, labels)).collect(), key=lambda r: r["rank"])
    assert [(r["rank"], r.case_id, r.priority_score) for r in rows] == [(1, "q1", 65.5), (2, "q2", 26.5)]
    assert (rows[0].gap_score, rows[0].status_boost, rows[0].findings_boost) == (63.0, 2.0, 0.5)
    assert rows[0].matched_field_groups == ["date", "english_name_org"] and rows[0].recommendations == ["r1", "r2"]


def test_sample_score(spark):
    stuck = ["no_val_samples"]
    gaps = gaps_of(spark, [
        ("date", 32.5, 21.0, 0.0, 6.0, 4.0, "blocked", stuck, ["val"]), ("numeric_tin_code", 21.25, 6.0, 2.5, 6.0, 4.0, "blocked", stuck, ["sources"]),
        ("english_name_org", 3.0, 0.0, 0.0, 0.0, 2.0, "review_required", None, ["coverage"]),
    ])
    covered = spark.createDataFrame([
        ("p1", False, True, K.RESIDENCY, "k1", "val"), ("p2", False, True, K.APOSTILLE, "k2", "train"), ("p3", True, False, K.APOSTILLE, "k3", "train"), ("p4", False, False, None, None, None),
    ], "sample_path string, covered_by_labeled boolean, pending_review boolean, sample_dataset_document_type string, sample_dataset_case_id string, sample_dataset_split string")
    groups = spark.createDataFrame([(K.RESIDENCY, "date"), (K.RESIDENCY, "numeric_tin_code"), (K.APOSTILLE, "english_name_org"), (K.APOSTILLE, "other")], "document_type string, field_group string")
    rows = sorted(R.ranked_samples(R.sample_priority(covered, gaps, groups)).collect(), key=lambda r: r["rank"])
    assert [r.sample_path for r in rows] == ["p1", "p2", "p4"]
    first = rows[0]
    assert (first.gap_score, first.blocked_boost, first.split_gap_boost, first.blocking_split_boost, first.queue_ready_boost) == (53.75, 10.0, 20.0, 10.0, 1.0)
    assert first.priority_score == 94.75 and first.recommendations == ["review_pending_label", "unblock_recognizer_training", "val", "sources"]
    assert rows[2].recommendations == ["bootstrap_label_scaffold"] and rows[2].priority_score == 0.0


def test_review_actions(spark):
    df = spark.createDataFrame([(["too_short", "dense_edge_content"],), ([],), (None,)], "f array<string>")
    assert [r.a for r in df.select(R.review_actions(F.col("f")).alias("a")).collect()] == [
        ["inspect_seal_or_noise_overlap", "review_region_box_size"], ["review_crop_quality"], ["review_crop_quality"]]


def test_scratch_needs_a_shared_folder_off_local_mode():
    from types import SimpleNamespace

    from paperloom.session import shared_folder

    def session(master, named=None):
        context = SimpleNamespace(master=master, getConf=lambda: {}, getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: named))

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_folder(session(master))
        assert shared_folder(session(master, "hdfs://scratch/")) == "hdfs://scratch"


def test_lineage_tables_can_be_deleted(spark):
    import glob

    from paperloom.session import cut_lineage, discard, discard_all, shared_folder

    folder = shared_folder(spark).removeprefix("file:")
    kept, gone = cut_lineage(spark.range(3).toDF("a")), cut_lineage(spark.range(4).toDF("a"))
    discard(gone)
    assert kept.count() == 3 and not glob.glob(gone.written_path.removeprefix("file:"))
    discard_all(spark)
    assert not glob.glob(f"{folder}/paperloom-*")


def test_manifest_files_are_small(spark, tmp_path):
    """A manifest's files take less than half of its rows as plain JSON and read back whole."""
    from paperloom.sources import readers, writers

    rows = spark.range(2000).selectExpr(
        "concat('case_', id) AS case_id", "'apostille' AS document_type", "'tin' AS field_name", "if(id % 2 = 0, 'date', 'numeric_tin_code') AS field_group",
        "'train' AS split", "concat('text ', id) AS text", "concat('src_', id % 9, '.png') AS source_path", "concat('crop_', id, '.png') AS crop_path")
    writers.write_manifest(rows, str(tmp_path / "m"))
    size = sum(f.stat().st_size for f in (tmp_path / "m").rglob("part-*"))
    plain = sum(len(r.j) + 1 for r in rows.selectExpr("to_json(struct(*)) AS j").collect())
    back = readers.manifest(spark, str(tmp_path / "m"))
    assert 2 * size < plain and back.select(*rows.columns).exceptAll(rows).isEmpty() and back.count() == 2000


def test_pages_of_mixed_shapes_are_measured_like_single_ones():
    import numpy as np
    import pandas as pd

    from paperloom.functions import pixels as P

    random = np.random.default_rng(7)
    shapes = [((32, 32), (7, 5), (64, 40))[i % 3] for i in range(60)]
    pixels = [None if i % 9 == 0 else random.integers(0, 256, w * h) for i, (w, h) in enumerate(shapes)]
    boxes = [np.array([0, 0, w // 2, h // 2, 1, 1, w - i % 2, h]) for i, (w, h) in enumerate(shapes)]
    found = P.page_measures.func(pd.Series(pixels), pd.Series([w for w, _ in shapes]), pd.Series([h for _, h in shapes]), pd.Series(boxes))
    for p, (w, h), b, score, ratios in zip(pixels, shapes, boxes, found["blur_score"], found["ratios"]):
        if p is None:
            assert pd.isna(score) and ratios is None
        else:
            grid = P._grid(p, w, h)
            assert score == P._wrapped_laplacian(grid) and ratios == P._dark_ratios(grid, b)
            assert P._page_measures(grid[None], b) == [(score, ratios)]
