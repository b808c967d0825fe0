"""Stateful intake: a case is reviewed as soon as its set of papers is complete, or when its time is up."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from paperloom import constants as K
from paperloom.operators.review import RULES, finish_cases
from paperloom.sources.writers import write_queue

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Why a round of a case gives a row.
COMPLETE, TIME_UP, LATE = "complete", "time_up", "late"
#: Stateful operators with timers need this state store.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: A paper's fields and checks travel through the state as one text; rules run on those that a review takes.
PAPER = "struct<position:bigint,ts:timestamp,content:string>"
#: What the state keeps of the open rounds of a bucket of cases: one text, for each case the latest paper of each type and a few counts.
OPEN = T.StructType([T.StructField("rounds", T.StringType())])
#: Buckets of cases: a call to the state store takes as long as many papers, so cases share it.
BUCKETS = 4096


def use_state_store(spark) -> None:
    """Set the state store that timers need, unless the session names another one with the same abilities."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in (spark.conf.get(key, None) or ""):
        spark.conf.set(key, STATE_STORE)


def aware(ts: datetime) -> datetime:
    return ts if ts.tzinfo else ts.astimezone(timezone.utc)


class Rounds(StatefulProcessor):
    """A case's round opens with its first paper and lasts ``wait``; see :func:`review_rounds`.

    The key is a bucket of cases.  It has one timer, at the first end of its open rounds.
    """

    def __init__(self, kinds: list[str], wait: timedelta) -> None:
        self.kinds, self.wait = kinds, wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rounds = self._read()
        before = self._first_end(rounds)
        # a micro-batch is bounded by its source; its papers of a case are taken in order of time
        papers = [(aware(ts), position, case, kind, content, blurry, low_confidence) for case, ts, kind, position, content, blurry, low_confidence in (row[:7] for row in rows)]
        for ts, position, case, kind, content, blurry, low_confidence in sorted(papers, key=lambda p: p[:2]):
            state = rounds.get(case)
            if state and ts >= state["start"] + self.wait:
                yield from self._closed(case, state)
                state = None
            if state is None:
                state = rounds[case] = {"start": ts, "done": False, "papers": {}, "blurry": False, "low_confidence": False, "document_count": 0, "late_count": 0}
            if state["done"] or ts < state["start"]:
                state["late_count"] += 1
                continue
            held = state["papers"].get(kind)
            order = [ts.isoformat(), position]
            if held is None or order >= held["order"]:
                state["papers"][kind] = {"order": order, "content": content}
            state["blurry"] |= blurry
            state["low_confidence"] |= low_confidence
            state["document_count"] += 1
            if all(k in state["papers"] for k in self.kinds):
                state["done"] = True
                yield self._row(case, state, COMPLETE)
        self._keep(rounds, before)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        rounds, passed, now = self._read(), expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        for case in [c for c, state in rounds.items() if (end := self._end(state)) <= passed or end < now]:
            yield from self._closed(case, rounds.pop(case))
        self._keep(rounds, None)

    def close(self) -> None:
        pass

    def _end(self, state: dict) -> int:
        return int((state["start"] + self.wait).timestamp() * 1000)

    def _first_end(self, rounds: dict) -> int | None:
        return min(map(self._end, rounds.values()), default=None)

    def _read(self) -> dict:
        held = self.open.get()
        rounds = json.loads(held[0]) if held else {}
        for state in rounds.values():
            state["start"] = datetime.fromisoformat(state["start"])
        return rounds

    def _keep(self, rounds: dict, timer: int | None) -> None:
        """Store what is open, with the timer at its first end; ``timer`` is the one that is set."""
        end = self._first_end(rounds)
        if timer is not None and timer != end:
            self.handle.deleteTimer(timer)
        if end is None:
            self.open.clear()
            return
        if timer != end:
            self.handle.registerTimer(end)
        self.open.update((json.dumps({case: {**state, "start": state["start"].isoformat()} for case, state in rounds.items()}),))

    def _closed(self, case: str, state: dict) -> Iterator[Row]:
        if not state["done"]:
            yield self._row(case, state, TIME_UP)
        elif state["late_count"]:
            yield self._row(case, state, LATE)

    def _row(self, case: str, state: dict, reason: str) -> Row:
        papers = {}
        for kind in self.kinds:
            p = state["papers"].get(kind)
            papers[kind] = None if p is None else Row(position=p["order"][1], ts=datetime.fromisoformat(p["order"][0]), content=p["content"])
        told = {c: state[c] for c in ("start", "blurry", "low_confidence", "document_count", "late_count")}
        return Row(case_id=case, reason_of_review=reason, **told, **papers)


def review_rounds(docs: DataFrame, wait: timedelta = timedelta(days=5), delay: str = "1 day") -> DataFrame:
    """Reviews of a stream of extracted papers (``case_id, ts, document_type, position, fields, quality_checks``).

    A round of a case lasts ``wait`` from its first paper on.  The paper that completes the set of document
    types gives a review at once (reason ``complete``), of the latest paper of each type so far.  A round
    that isn't complete is reviewed when its time is up (``time_up``): when the watermark, ``delay`` behind
    the newest paper, or a paper of the case itself passes its end.  Papers that come after a round's
    review, or that are older than its first paper, are late: they change nothing, and a completed round
    that has some gives one more row at its end (``late``) that counts them.  Papers older than the
    watermark are dropped by Spark and counted there.  Papers of one micro-batch are taken in order of time
    and position.  Papers without a case or a time take no part.

    Rules run after the state, on the papers that a review takes: a paper costs little before the shuffle,
    where a file is one task.  The state of a case is one paper per type and a few counts, kept with those of
    the other open rounds of its bucket; a case that holds a third of all papers is one key's work, bounded by
    the micro-batch of its source (``maxFilesPerTrigger``).
    """
    use_state_store(docs.sparkSession)
    content = docs.select("fields", "quality_checks").schema
    papers = docs.where("case_id IS NOT NULL AND ts IS NOT NULL").select(
        "case_id", "ts", "document_type", F.col("position").cast("bigint").alias("position"),
        F.to_json(F.struct("fields", "quality_checks"), {"ignoreNullFields": "false"}).alias("content"),
        F.coalesce("quality_checks.blurry", F.lit(False)).alias("blurry"),
        F.coalesce("quality_checks.low_ocr_confidence", F.lit(False)).alias("low_confidence"),
        F.pmod(F.xxhash64("case_id"), F.lit(BUCKETS)).alias("bucket"),
    )
    out = "case_id string, start timestamp, reason_of_review string, blurry boolean, low_confidence boolean, document_count bigint, late_count bigint"
    out += "".join(f", {kind} {PAPER}" for kind in K.DOCUMENT_TYPES)
    reviewed = papers.withWatermark("ts", delay).groupBy("bucket").transformWithState(
        statefulProcessor=Rounds(list(K.DOCUMENT_TYPES), wait), outputStructType=T._parse_datatype_string(out), outputMode="Append", timeMode="EventTime")
    kept = reviewed.columns
    for kind in K.DOCUMENT_TYPES:
        read = reviewed.withColumn("content", F.from_json(f"{kind}.content", content))
        ruled = read.select(*kept, "content.*").withColumn("findings", RULES[kind]())
        paper = F.struct(f"{kind}.position", f"{kind}.ts", "fields", "findings")
        reviewed = ruled.withColumn(kind, F.when(F.col(kind).isNotNull(), paper)).select(*kept)
    papers = F.filter(F.array(*[
        F.when(F.col(kind).isNotNull(), F.struct(F.lit(kind).alias("document_type"), f"{kind}.position", f"{kind}.ts", f"{kind}.fields", f"{kind}.findings"))
        for kind in K.DOCUMENT_TYPES]), lambda p: p.isNotNull())
    return finish_cases(reviewed.withColumn("papers", papers))


def start_rounds(reviewed: DataFrame, root: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Store the queued reviews of each micro-batch, and the papers that they saw, in the queue at ``root``.

    The batch number names the folder, so a batch repeated after a lost executor or a restart replaces
    itself.  Rows that only count late papers replace the review before them, whose papers they repeat.
    """

    def keep(batch: DataFrame, number: int) -> None:
        # several rounds of a case can end in one batch: the last one stands
        newest = batch.groupBy("case_id").agg(F.max_by(F.struct(*[c for c in batch.columns if c != "case_id"]), F.struct("start", F.col("reason_of_review") == LATE)).alias("x"))
        queued = newest.select("case_id", "x.*").where("queued").persist()
        try:
            documents = queued.select("case_id", F.explode("papers").alias("p")).select("case_id", "p.*")
            write_queue(queued.drop("papers"), documents, root, f"{number:012d}")
        finally:
            queued.unpersist()

    writer = reviewed.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(keep)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
