import pytest
from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.operators import review as R
from paperloom.streaming.intake import review_stream, start_queue
from paperloom.sources.writers import read_queue, write_queue
from workload.q_review import _events
from workload.views import table

DOC = "case_id string, document_type string, position int, fields map<string,string>, quality_checks struct<has_certification_text:boolean,has_apostille_heading:boolean,seal_present:boolean,signature_present:boolean,all_no_boxes_checked:boolean,blurry:boolean,low_ocr_confidence:boolean>"
GOOD = {"taxpayer_name": "Ann Lee", "tin": "123-45-6789", "tax_year": "2026", "issue_date": "May 1, 2026", "residency_country": "United States of America", "residency_country_code": "US"}
FORM = {"first_name": "ANN", "last_name": "LEE", "tin": " 123-45-6789 ", "address": "1 A", "residency_country": "United States of America", "residency_country_code": "US", "dividend_tax_rate": "15%", "signature_date": "2026-05-01"}
YES = (True, True, True, True, True, False, None)


def cases(spark, *docs):
    return {r.case_id: r for r in R.review_cases(spark.createDataFrame(list(docs), DOC)).collect()}


def test_matching_papers_pass(spark):
    row = cases(spark, ("a", K.RESIDENCY, 0, GOOD, YES), ("a", K.WITHHOLDING, 1, FORM, YES))["a"]
    assert (row.status, row.matched, row.reason, row.queued) == ("pass", True, None, False)


def test_missing_values_reject_in_rule_order(spark):
    form = {**FORM, "address": None, "dividend_tax_rate": "10%", "signature_date": ""}
    row = cases(spark, ("a", K.WITHHOLDING, 0, form, (None, None, None, False, False, None, None)))["a"]
    assert [f.code for f in row.findings] == [
        "required_address_missing", "required_dividend_rate_invalid", "required_signature_date_missing", "required_no_checkbox_missing", "required_signature_missing"]
    assert row.status == "reject" and row.reason == R.NO_PARTNER


def test_names_are_compared_without_case_and_marks(spark):
    other = {**FORM, "last_name": "L'EE"}
    wrong = {**FORM, "last_name": "PARK", "tin": "12-3456789"}
    rows = cases(spark, ("a", K.RESIDENCY, 0, GOOD, YES), ("a", K.WITHHOLDING, 1, other, YES), ("b", K.RESIDENCY, 0, GOOD, YES), ("b", K.WITHHOLDING, 1, wrong, YES))
    assert rows["a"].matched
    assert [f.field_name for f in rows["b"].findings] == ["tin", "taxpayer_name"]


def test_last_paper_counts_but_any_blur_queues(spark):
    old = (True, True, True, True, True, True, None)
    row = cases(spark, ("a", K.RESIDENCY, 0, {}, old), ("a", K.RESIDENCY, 5, GOOD, YES))["a"]
    assert row.status == "pass" and row.blurry and row.queued


def test_status_of_soft_findings(spark):
    found = spark.createDataFrame([("a", "note"), ("b", "required_x")], "case_id string, code string")
    rows = {r.case_id: r.status for r in R.case_status(spark.createDataFrame([("a",), ("b",), ("c",)], "case_id string"), found).collect()}
    assert rows == {"a": "needs_review", "b": "reject", "c": "pass"}


@pytest.fixture(scope="module")
def streamed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stream")
    events = table(spark, "/root/testdata/sf0.001", "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.orderBy("ts").coalesce(1).write.parquet(str(root / "in"))
    # a far later event pushes the watermark past every session
    closing = events.limit(1).withColumns({"ts": F.expr("timestamp'2030-01-01'"), "user_id": F.lit(-1).cast("bigint")})
    closing.coalesce(1).write.mode("append").parquet(str(root / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(root / "in"))
    start_queue(review_stream(_events(stream)), str(root / "queue"), str(root / "checkpoint")).awaitTermination()
    return events, str(root / "queue")


def test_stream_gives_the_batch_result(spark, streamed):
    events, queue = streamed
    batch = review_stream(_events(events)).filter("queued")
    wanted = {(r.case_id, str(r.start), str(r.end), r.document_count, r.status, len(r.findings)) for r in batch.collect()}
    rows = spark.read.parquet(f"{queue}/cases").filter("case_id <> '-1'").collect()
    assert {(r.case_id, str(r.start), str(r.end), r.document_count, r.status, len(r.findings)) for r in rows} == wanted


def test_queue_keeps_the_newest_batch_per_case(spark, streamed):
    current, _ = read_queue(spark, streamed[1])
    assert current.groupBy("case_id").agg(F.count_distinct("batch").alias("n")).filter("n > 1").count() == 0


def test_a_review_run_takes_marks_from_the_raster_side(spark):
    """Two cases with one apostille each: the same text, a page with dark marks and an empty page, and no page at all."""
    from paperloom.operators.raster import document_checks, page_checks
    from paperloom.plans.review_run import extract_documents, run_review

    text = ("APOSTILLE (Convention de La Haye du 5 octobre 1961) 1. Country: UNITED STATES OF AMERICA 2. has been signed by TOVE LIND "
            "3. acting in the capacity of NOTARY PUBLIC 5. at Salem, Oregon 6. the 1ST DAY OF JUNE, 2017 8. No. 4711")
    pages = spark.createDataFrame(
        [(c, 0, K.APOSTILLE, f"{c}.jpg", 1, text, [("w", 0.9)]) for c in ("dark", "white", "none")],
        "case_id string, position int, document_type string, source_path string, page_number int, raw_text string, words array<struct<text:string,confidence:double>>")
    rasters = spark.createDataFrame([("dark.jpg", 64, 64, [10] * 4096), ("white.jpg", 64, 64, [255] * 4096)], "image_id string, width int, height int, pixels array<int>")
    assert "pixels" not in page_checks(rasters).columns
    cases, documents = run_review(pages, None, rasters)
    found = {r.case_id: r.quality_checks for r in documents.collect()}
    template = found["dark"].detected_template_id
    wanted = {r.image_id: (r.seal_present, r.signature_present) for r in document_checks(rasters.withColumn("template_id", F.lit(template))).collect()}
    for name in ("dark", "white"):
        assert (found[name].seal_present, found[name].signature_present) == wanted[f"{name}.jpg"] and found[name].blur_score == 0.0
    assert wanted["dark.jpg"][0] is True and wanted["white.jpg"][0] is False
    assert found["none"].seal_present is None and found["none"].blur_score is None and found["none"].width is None
    rows = {r.case_id: r for r in cases.collect()}
    assert set(rows) == {"dark", "white", "none"} and all(r.document_count == 1 for r in rows.values())
    codes = {name: {f.code for f in r.findings} for name, r in rows.items()}
    assert codes["dark"] < codes["white"] == codes["none"]  # absent and unknown marks reject alike
    assert extract_documents(pages).filter("quality_checks.seal_present IS NOT NULL").count() == 0


def plain_rounds(batches, wait, kinds):
    """Rows of ``review_rounds`` by hand: (case, start, reason, papers counted, late ones), for all rounds that end."""
    out, cases = [], {}

    def ended(case, r):
        if not r["done"]:
            out.append((case, r["start"], "time_up", r["count"], r["late"]))
        elif r["late"]:
            out.append((case, r["start"], "late", r["count"], r["late"]))

    for papers in batches:
        for case, ts, position, kind in sorted(papers, key=lambda p: p[1:3]):
            r = cases.get(case)
            if r and ts >= r["start"] + wait:
                ended(case, r)
                r = None
            if r is None:
                r = cases[case] = {"start": ts, "done": False, "kinds": set(), "count": 0, "late": 0}
            if r["done"] or ts < r["start"]:
                r["late"] += 1
                continue
            r["kinds"].add(kind)
            r["count"] += 1
            if r["kinds"] == kinds:
                r["done"] = True
                out.append((case, r["start"], "complete", r["count"], r["late"]))
    return sorted(out + [x for case, r in cases.items() for x in [(case, r["start"], "time_up", r["count"], r["late"])] if not r["done"]]
                  + [(case, r["start"], "late", r["count"], r["late"]) for case, r in cases.items() if r["done"] and r["late"]])


def test_rounds_of_papers_out_of_order(spark, tmp_path):
    """Three batches with papers that come a batch late, a completed round with late papers, and a queue that is compacted twice."""
    import datetime

    from paperloom.sources.writers import QUEUE_PARTS, compact_queue
    from paperloom.streaming.rounds import review_rounds, start_rounds

    day = lambda d, h=0: datetime.datetime(2024, 1, d, h, tzinfo=datetime.timezone.utc)
    r, w, a = K.RESIDENCY, K.WITHHOLDING, K.APOSTILLE
    batches = [
        [("full", day(1), 1, r), ("full", day(1, 3), 3, a), ("open", day(1), 1, r), ("odd", day(2), 2, r), ("twice", day(1), 1, r), ("twice", day(1, 1), 2, w), ("twice", day(1, 2), 3, a)],
        [("full", day(1, 2), 2, w), ("full", day(2, 4), 4, w), ("odd", day(1, 22), 1, a), ("odd", day(2, 5), 3, w), ("twice", day(2), 4, a), ("twice", day(2, 1), 5, a)],
        [("full", day(3), 5, r), ("odd", day(3), 4, a), ("twice", day(7), 6, r)],
    ]
    yes = dict.fromkeys(("has_certification_text", "has_apostille_heading", "seal_present", "signature_present", "all_no_boxes_checked"), True)
    checks = ", ".join(f"{c}: boolean" for c in (*yes, "blurry", "low_ocr_confidence"))
    schema = f"case_id string, ts timestamp, position bigint, document_type string, fields map<string,string>, quality_checks struct<{checks}>"
    closing = [("end", day(30), 1, r)]
    for k, papers in enumerate([*batches, closing]):
        rows = [(c, t, p, kind, {"tin": f"{c}-{p}"}, {**yes, "blurry": False, "low_ocr_confidence": False}) for c, t, p, kind in papers]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/slice={k}"))
    queue = str(tmp_path / "queue")

    def reviewed():
        return review_rounds(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/slice=*")), datetime.timedelta(days=5))

    sink = reviewed().writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True)
    sink.start(str(tmp_path / "out")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    got = sorted((x.case_id, x.start.astimezone(datetime.timezone.utc), x.reason_of_review, x.document_count, x.late_count) for x in out if x.case_id != "end")
    assert got == plain_rounds(batches, datetime.timedelta(days=5), {r, w, a})
    assert {x[2] for x in got} == {"complete", "time_up", "late"}
    full = next(x for x in out if x.case_id == "full" and x.reason_of_review == "complete")
    assert {(p.document_type, p.position, p.fields["tin"]) for p in full.papers} == {(r, 1, "full-1"), (w, 2, "full-2"), (a, 3, "full-3")}

    # the same stream into the queue; compaction keeps what readers see, and can be repeated
    start_rounds(reviewed(), queue, str(tmp_path / "c2")).awaitTermination()
    seen = lambda: tuple(sorted(map(str, x.select(sorted(x.columns)).collect())) for x in read_queue(spark, queue))
    before = seen()
    assert len(before[0]) == len({x[0] for x in got}) and len(before[1]) >= 7
    last = compact_queue(spark, queue)
    assert seen() == before and compact_queue(spark, queue) == last and seen() == before
    import os

    assert all(os.listdir(f"{queue}/{part}") == [f"compacted={last}"] for part in QUEUE_PARTS)
    # a later batch replaces a compacted case; a half-written compaction is not read
    cases, papers = read_queue(spark, queue)
    new = [x.where("case_id = 'full'").drop("batch") for x in (cases, papers)]
    write_queue(new[0].withColumn("status", F.lit("pass")), new[1], queue, "000000000099")
    os.makedirs(f"{queue}/cases/compacted=000000000099")
    again = {x.case_id: (x.status, x.batch) for x in read_queue(spark, queue)[0].collect()}
    assert again["full"] == ("pass", "000000000099") and len(again) == len(before[0])
    assert compact_queue(spark, queue) == "000000000099"
    assert {x.case_id: x.status for x in read_queue(spark, queue)[0].collect()} == {c: s for c, (s, _) in again.items()}


def test_one_part_of_papers_is_ruled_by_many_tasks(spark):
    papers = spark.range(0, 60, 1, 1).selectExpr(
        "concat('c', id % 20) AS case_id", "'apostille' AS document_type", "id AS position", "map('issued_on', 'x') AS fields",
        "named_struct('has_apostille_heading', true, 'seal_present', true, 'signature_present', true, 'has_certification_text', true, 'all_no_boxes_checked', true, 'blurry', false, 'low_ocr_confidence', false) AS quality_checks")
    from paperloom.operators import review

    cases = review.review_cases(papers)
    assert cases.count() == 20 and {r.document_count for r in cases.collect()} == {3}
    assert "REPARTITION_BY_NUM" in cases._jdf.queryExecution().toString()


def test_cases_of_one_bucket_keep_their_own_rounds(spark, tmp_path, monkeypatch):
    """All cases in one bucket, one timer for all: one case completes, two run out of time at different ends, one has late papers."""
    import datetime

    from paperloom.streaming import rounds

    monkeypatch.setattr(rounds, "BUCKETS", 1)
    day = lambda d, h=0: datetime.datetime(2024, 1, d, h, tzinfo=datetime.timezone.utc)
    r, w, a = K.RESIDENCY, K.WITHHOLDING, K.APOSTILLE
    batches = [
        [("x", day(1), 1, r), ("x", day(1, 1), 2, w), ("x", day(1, 2), 3, a), ("x", day(1, 3), 4, a), ("y", day(1), 1, r), ("z", day(3), 1, w)],
        [("z", day(8, 1), 2, r), ("u", day(9), 1, a)],
    ]
    yes = dict.fromkeys(("has_certification_text", "has_apostille_heading", "seal_present", "signature_present", "all_no_boxes_checked"), True)
    checks = ", ".join(f"{c}: boolean" for c in (*yes, "blurry", "low_ocr_confidence"))
    schema = f"case_id string, ts timestamp, position bigint, document_type string, fields map<string,string>, quality_checks struct<{checks}>"
    for k, papers in enumerate([*batches, [("end", day(30), 1, r)]]):
        rows = [(c, t, p, kind, {"tin": f"{c}-{p}"}, {**yes, "blurry": False, "low_ocr_confidence": False}) for c, t, p, kind in papers]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/slice={k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/slice=*"))
    sink = rounds.review_rounds(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    sink.start(str(tmp_path / "out")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).where("case_id <> 'end'").collect()
    got = sorted((x.case_id, x.start.astimezone(datetime.timezone.utc), x.reason_of_review, x.document_count, x.late_count) for x in out)
    assert got == plain_rounds(batches, datetime.timedelta(days=5), {r, w, a})


def test_every_slice_has_the_files_of_one_micro_batch(spark):
    from workload.q_review import _files_per_slice

    assert _files_per_slice(spark, [50_000] * 5, 5) == 5 and _files_per_slice(spark, [10**9] * 5, 5) == 2 * spark.sparkContext.defaultParallelism
    assert _files_per_slice(spark, [10**9] * 4 + [3], 5) == 1 and _files_per_slice(spark, [10**9] * 4, 5) == 1 and _files_per_slice(spark, [], 5) == 1
