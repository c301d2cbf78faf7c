"""The ingest stream: raw log to serving tables, quarantine and batch reports.

Offsets are committed after a batch's writes, and every write is an overwrite of the
batch's own folder, so a batch that is run again leaves the same tables. The high-water
mark is part of the batch report: batch n always reads the mark of batch n - 1,
whether it runs for the first time or again after a restart.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel

from tallyport.functions.timing import earlier_by
from tallyport.operators import latency, parse, quarantine, retry
from tallyport.operators.compaction import FAN_IN
from tallyport.operators.fanout import compact_serving, fanout, write_serving
from tallyport.operators.telemetry import read_reports
from tallyport.session import together
from tallyport.sources.files import Storage
from tallyport.sources.schemas import BATCH_REPORT_SCHEMA, SERVING_TABLES


@dataclass
class IngestJob:
    spark: SparkSession
    root: str
    run_id: str = "adhoc"
    tables: list[str] = field(default_factory=lambda: list(SERVING_TABLES))
    watermark: str = "2 minutes"
    late_policy: str = "dlq"
    sample_rate: float = 0.05
    external_write: retry.WriteFn | None = None
    # Folder of a file-backed log; with it, how far the stream is behind is sampled after each batch.
    log: str | None = None
    retry_policy: retry.RetryPolicy = retry.RetryPolicy()
    # Batches between two compactions of the serving tables, 0 for none here: another job may do them.
    compact_every: int = 0
    fan_in: int = FAN_IN

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def start(self, raw: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        """Start the stream; `trigger` as in `DataStreamWriter.trigger`, default as fast as possible."""
        writer = (
            raw.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", self.path("checkpoint"))
            .queryName(f"ingest-{self.run_id}")
        )
        if trigger:
            writer = writer.trigger(**trigger)
        return writer.start()

    def run_available(self, raw: DataFrame) -> None:
        """Process what the log holds now, then return."""
        query = self.start(raw, {"availableNow": True})
        query.awaitTermination()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch: parse and validate once, then one write per destination.

        What changes from batch to batch (cutoff, clock) is applied above the persisted
        rows. The costly part below keeps the same plan, so its generated code is
        compiled once and stays warm. Nothing is counted for its own sake: the counters
        of the report are observed while the batch is written.
        """
        started = time.time()
        before = self.high_water(batch_id - 1)
        validated = parse.validate(parse.parse(batch)).persist(StorageLevel.MEMORY_AND_DISK)
        cutoff = earlier_by(F.lit(before).cast("timestamp"), self.watermark)
        classified = parse.assign_route(validated, cutoff, self.late_policy)
        try:
            counts = self._write(classified, batch_id, started)
            self._report(batch_id, counts, before, started)
        finally:
            validated.unpersist()
        if self.log:
            self._sample_lag(batch_id)
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            compact_serving(self.spark, self.root, self.tables, self.fan_in)

    def high_water(self, batch_id: int) -> datetime | None:
        """Greatest event time up to a batch, None before the first."""
        if batch_id < 0:
            return None
        newest = self._report_before(f"{self.path('reports')}/batch_id={batch_id}", batch_id)
        if newest is None:  # expired or moved: the newest of those that are left
            newest = self._report_before(self.path("reports"), batch_id)
        return _moment(newest["us"]) if newest else None

    def _report_before(self, path: str, batch_id: int) -> Row | None:
        """The newest report below `path` up to a batch; None without any, an error if it cannot be read."""
        try:
            found = read_reports(self.spark, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        row = (
            found.where(F.col("batch_id") <= batch_id)
            .select("batch_id", F.unix_micros("max_event_time").alias("us"))
            .orderBy(F.desc("batch_id"))
            .first()
        )
        if row is None and f"batch_id={batch_id}" in path:
            raise ValueError(f"the report {path} cannot be read; without it nothing would count as late")
        return row

    def _counters(self) -> list:
        route = F.col("route")
        timely = ~route.isin(parse.UNPARSEABLE, parse.LATE, parse.DROPPED)
        return [
            F.count(F.lit(1)).alias("input_rows"),
            F.count_if(route == parse.UNPARSEABLE).alias("unparseable"),
            F.count_if(route == parse.INVALID).alias("invalid"),
            F.count_if(route.isin(parse.LATE, parse.DROPPED)).alias("late"),
            F.count_if(F.col("failure_stage").isNotNull()).alias("dlq"),
            F.count_if(route == parse.OK).alias("ok"),
            F.unix_micros(F.max(F.when(timely, F.col("event_time")))).alias("high_us"),
        ]

    def _write(self, classified: DataFrame, batch_id: int, started: float) -> dict:
        """All writes of a batch; returns its counters.

        The quarantine comes first. It meets every row of the batch, so it fills the
        persisted rows and is where the batch is counted. The other writes follow side by
        side and take as long as the longest; the time written is taken before they begin.
        """
        sound, seen = classified.where(F.col("route") == parse.OK), Observation()
        now = F.lit(int(started * 1000)).cast("bigint")
        envelopes = quarantine.from_classified(classified.observe(seen, *self._counters()), now)
        if self.external_write:
            envelopes = envelopes.unionByName(self._deliver(sound, batch_id, now))
        quarantine.append_quarantine(envelopes, self.path("quarantine"), batch_id)
        counts = {**seen.get, "latency_sum_ms": 0, "latency_count": 0, "latency_max_ms": 0}
        if not counts["input_rows"]:
            return counts
        writing = F.lit(int(time.time() * 1000)).cast("bigint")
        writes = [
            partial(write_serving, {name: rows}, self.root, batch_id)
            for name, rows in fanout(sound, writing, self.tables, latest=False).items()
        ]
        waited = Observation()
        if self.sample_rate > 0:
            samples = latency.latency_samples(
                sound.withColumn("written_at_ms", writing), F.lit(self.run_id), F.lit(batch_id).cast("bigint"), self.sample_rate
            ).observe(
                waited, F.coalesce(F.sum("latency_ms"), F.lit(0)).alias("latency_sum_ms"),
                F.count("latency_ms").alias("latency_count"), F.coalesce(F.max("latency_ms"), F.lit(0)).alias("latency_max_ms"),
            )
            writes.append(partial(latency.write_samples, samples, self.path("latency_samples"), batch_id))
        together(self.spark, writes)
        return {**counts, **(waited.get if self.sample_rate > 0 else {})}

    def _deliver(self, sound: DataFrame, batch_id: int, now: Column) -> DataFrame:
        """Write to the external store, each event once; returns what failed as envelopes."""
        events = parse.dedup(sound)
        outcomes = retry.deliver_once(events, self.external_write, self.retry_policy, f"{self.path('deliveries')}/batch_id={batch_id}")
        failed = outcomes.where(~F.col("succeeded")).withColumn("table", F.lit("external"))
        return quarantine.from_sink(events, failed, now)

    def _sample_lag(self, batch_id: int) -> None:
        """Files that have landed in the log less those the stream has taken, after a batch.

        The source writes down the files of a batch before it is run.
        """
        files = F.from_json("value", "path string, batchId bigint")
        taken = self.spark.read.text(f"{self.path('checkpoint')}/sources/0").select(files.alias("f")).where(
            F.col("f.batchId") <= batch_id
        )
        landed = len(Storage(self.spark, self.log).matching("*.parquet"))
        taken.agg(
            F.current_timestamp().alias("at"), F.lit(landed).cast("bigint").alias("files_landed"),
            F.count_distinct("f.path").alias("files_taken"),
        ).withColumn("files_behind", F.col("files_landed") - F.col("files_taken")).write.mode("overwrite").json(
            f"{self.path('lag')}/batch_id={batch_id}"
        )

    def lag(self) -> DataFrame:
        """How far the stream was behind after each batch."""
        schema = "at timestamp, files_landed bigint, files_taken bigint, files_behind bigint, batch_id bigint"
        return self.spark.read.schema(schema).option("basePath", self.path("lag")).json(self.path("lag"))

    def _report(self, batch_id: int, counts: dict, before: datetime | None, started: float) -> None:
        """Append the batch report. Counters of one batch, one row."""
        marks = [m for m in (before, _moment(counts["high_us"])) if m is not None]
        ok = counts["ok"]
        row = {
            **{k: counts[k] for k in ("input_rows", "unparseable", "invalid", "late", "dlq")},
            **{k: counts[k] for k in ("latency_sum_ms", "latency_count", "latency_max_ms")},
            "run_id": self.run_id,
            "batch_id": batch_id,
            "wall_ts": datetime.fromtimestamp(started, timezone.utc),
            "rows_written": ok * len(self.tables),
            "successes": ok * len(self.tables),
            "batch_seconds": round(time.time() - started, 4),
            "retries_before_success": 0,
            "retried_writes": 0,
            "retried_writes_retries": 0,
            "failures_exhausted": 0,
            "max_event_time": max(marks) if marks else None,
        }
        if self.external_write and counts["input_rows"]:
            row |= self._delivery_counts(batch_id)
            row["dlq"] += row["failures_exhausted"]
        kinds = [(f.name, f.dataType) for f in StructType.fromDDL(BATCH_REPORT_SCHEMA)]
        reasons = [F.lit(x) for pair in sorted(row.get("failure_reasons", {}).items()) for x in pair]
        row["failure_reasons"] = F.create_map(*reasons) if reasons else None
        report = self.spark.range(1).select(*[F.lit(row.get(n)).cast(t).alias(n) for n, t in kinds])
        report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(
            f"{self.path('reports')}/batch_id={batch_id}"
        )

    def _delivery_counts(self, batch_id: int) -> dict:
        done = retry.read_ledger(self.spark, f"{self.path('deliveries')}/batch_id={batch_id}")
        won = F.col("succeeded")
        c = done.agg(
            F.coalesce(F.sum(F.when(won, F.col("attempts") - 1)), F.lit(0)).alias("retries"),
            F.count_if(won & (F.col("attempts") > 1)).alias("retried"),
            F.count_if(~won).alias("exhausted"),
        ).first()
        reasons = (
            done.where(~won).groupBy(F.split_part(F.col("last_error"), F.lit(":"), F.lit(1)).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")).collect()
        )
        return {
            "failure_reasons": {r["reason"]: r["n"] for r in reasons},
            "retries_before_success": c["retries"],
            "retried_writes": c["retried"],
            "retried_writes_retries": c["retries"],
            "failures_exhausted": c["exhausted"],
        }

    def reports(self) -> DataFrame:
        """All batch reports, one per batch."""
        return read_reports(self.spark, self.path("reports"))


def _moment(us: int | None) -> datetime | None:
    return None if us is None else datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=us)
