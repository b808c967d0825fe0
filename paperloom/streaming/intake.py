"""Streaming review intake: papers arrive one by one, a case is reviewed when it falls silent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paperloom import constants as K
from paperloom.operators.review import document_findings, finish_cases
from paperloom.sources.writers import write_queue


def review_stream(docs: DataFrame, delay: str = "1 day", gap: str = "2 days") -> DataFrame:
    """Reviewed cases of a stream (or table) of extracted papers with an event time ``ts``.

    A session per case stays open while papers keep coming within ``gap``; papers later than
    ``delay`` behind the newest are dropped by the watermark (see the progress metric
    ``numRowsDroppedByWatermark``).  The state of a session is the latest paper per type and two
    flags, however many papers the case gets.
    """
    ruled = document_findings(docs).select(
        "case_id", "ts", "document_type", "position", "fields", "findings",
        F.coalesce("quality_checks.blurry", F.lit(False)).alias("blurry"),
        F.coalesce("quality_checks.low_ocr_confidence", F.lit(False)).alias("low_confidence"),
    )
    latest = lambda kind: F.max_by(
        F.struct("fields", "findings"), F.when(F.col("document_type") == kind, F.struct("ts", "position"))
    )
    sessions = ruled.withWatermark("ts", delay).groupBy(F.session_window("ts", gap).alias("session"), "case_id").agg(
        *[latest(kind).alias(kind) for kind in K.DOCUMENT_TYPES],
        F.bool_or("blurry").alias("blurry"), F.bool_or("low_confidence").alias("low_confidence"),
        F.count(F.lit(1)).alias("document_count"),
    )
    return finish_cases(sessions).select("session.start", "session.end", "*").drop("session")


def start_queue(reviewed: DataFrame, root: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append the queued cases of each micro-batch to the queue table.

    The batch number names the folder, so a batch repeated after a lost executor or a restart
    replaces itself.  The papers stay in their own table, keyed by case.
    """

    def keep(batch: DataFrame, number: int) -> None:
        # two tables are written from the batch, whose computation includes the state: keep its rows
        queued = batch.filter("queued").persist()
        try:
            write_queue(queued, queued.select("case_id", "start", "end", "document_count"), root, f"{number:012d}")
        finally:
            queued.unpersist()

    writer = reviewed.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(keep)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
