"""The hourly load as one flow that can be resumed: extract, load, verify, close.

The intent to load a window is recorded before any work, and every step leaves a marker
when its result is stored. A flow that died is run again under its run id and goes on after
its last marker; all results have folders of their own, so a step that was half done is
simply done again. Verification compares, trip by trip, what was extracted with what the
stage table holds for the window: a difference is recorded, raises an alert and ends the
flow with an error. Run again, it makes a new attempt from the extraction on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallyport.operators.fanout import city_hours
from tallyport.operators.telemetry import append_alerts
from tallyport.plans import rollup

PLANNED, EXTRACTED, LOADED, VERIFIED, DRIFTED, CLOSED = STEPS = ("planned", "extracted", "loaded", "verified", "drifted", "closed")
MARKER_SCHEMA = """
    step int, name string, at timestamp, window_start timestamp, window_end timestamp, load_id bigint, rows bigint,
    empty_hours int, notes string
"""
ALERT_SCHEMA = "kind string, audit_id string, window_start timestamp, window_end timestamp, hours int, rows bigint, at timestamp"


class RollupDrift(RuntimeError):
    """What was loaded is not what was extracted."""


def _stored(spark: SparkSession, path: str, schema: str, folders: str) -> DataFrame:
    """JSON records below `path` with the columns of their folders; none before the first."""
    try:
        return spark.read.schema(f"{schema}, {folders}").option("basePath", path).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, {folders}")


@dataclass
class RollupFlow:
    """Loads windows of the stored city-hour table below `serving` into the stage table below `root`.

    `min_rows` is the least a window must hold for its load to go ahead. `write` stores the
    rows of a load; `after` is called with each marker's name once it is stored.
    """

    spark: SparkSession
    serving: str
    root: str
    min_rows: int = 0
    write: Callable[[DataFrame, str, int], None] = rollup.write_load
    after: Callable[[str], None] = lambda name: None

    def markers(self) -> DataFrame:
        return _stored(self.spark, f"{self.root}/audit", MARKER_SCHEMA, "audit_id string, attempt int")

    def alerts(self) -> DataFrame:
        return _stored(self.spark, f"{self.root}/alerts", ALERT_SCHEMA, "alert string")

    def stage(self) -> DataFrame:
        return rollup.read_stage(self.spark, f"{self.root}/stage")

    def audit(self) -> DataFrame:
        """One row for each load as it stands: its last step, window, rows and notes."""
        return rollup.audit_view(
            self.markers().withColumn("step", F.col("attempt") * len(STEPS) + F.col("step"))
        ).select("audit_id", F.col("name").alias("state"), "attempt", "window_start", "window_end", F.col("rows").alias("rows_loaded"), "notes")

    def run(self, audit_id: str, start: datetime, end: datetime, loaded_at: Column) -> str:
        """Load the hours of [start, end); 'waiting' when they do not hold enough rows yet, else 'closed'."""
        hours = rollup.plan_backfill(start, end)
        lo, hi = F.lit(str(start)).cast("timestamp"), F.lit(str(end)).cast("timestamp")
        attempt, done = self._progress(audit_id)
        if CLOSED in done:
            return CLOSED
        source = city_hours(self.spark, self.serving, start, end)
        if EXTRACTED not in done and self.min_rows and not rollup.has_landed(source, lo, hi, self.min_rows).first()["landed"]:
            return "waiting"

        def mark(name: str, **values) -> None:
            self._mark(audit_id, attempt, name, {"window_start": lo, "window_end": hi, **values})

        if PLANNED not in done:
            newest = self.markers().agg(F.max("load_id").alias("n")).first()["n"]
            load_id = 0 if newest is None else newest + 1
            mark(PLANNED, load_id=load_id, notes=f"{hours} hours planned")
        else:
            load_id = done[PLANNED]["load_id"]
        extract = f"{self.root}/extracted/audit_id={audit_id}/attempt={attempt}"
        if EXTRACTED not in done:
            rollup.stage_rows(source, loaded_at).write.mode("overwrite").parquet(extract)
            filled = self._hours(extract).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("hours")).first()
            mark(EXTRACTED, load_id=load_id, rows=filled["rows"], empty_hours=hours - filled["hours"])
            rows, empty = filled["rows"], hours - filled["hours"]
        else:
            rows, empty = done[EXTRACTED]["rows"], done[EXTRACTED]["empty_hours"]
        if LOADED not in done:
            self.write(self.spark.read.parquet(extract), f"{self.root}/stage", load_id)
            mark(LOADED, load_id=load_id, rows=rows, empty_hours=empty)
        if VERIFIED not in done:
            self._verify(audit_id, attempt, extract, lo, hi, hours, mark)
        if empty == hours:
            self._alert(f"{audit_id}-{attempt}", "backfill_empty", audit_id, lo, hi, hours, rows)
        mark(CLOSED, load_id=load_id, rows=rows, empty_hours=empty, notes=f"{hours}h window, {empty} empty hours")
        return CLOSED

    def _progress(self, audit_id: str) -> tuple[int, dict[str, Row]]:
        """The attempt to go on with, and its markers; after a drift the next one, with none."""
        found = self.markers().where(F.col("audit_id") == audit_id).collect()
        attempt = max((m["attempt"] for m in found), default=0)
        done = {m["name"]: m for m in found if m["attempt"] == attempt}
        return (attempt + 1, {}) if DRIFTED in done else (attempt, done)

    def _mark(self, audit_id: str, attempt: int, name: str, values: dict) -> None:
        step = STEPS.index(name)
        values = {"step": step, "name": name, "at": F.current_timestamp(), **values}
        row = self.spark.range(1).select(*[
            (v if isinstance(v := values.get(c), Column) else F.lit(v)).cast(kind).alias(c)
            for c, kind in (part.split() for part in MARKER_SCHEMA.replace("\n", " ").split(","))
        ])
        row.coalesce(1).write.mode("overwrite").json(f"{self.root}/audit/audit_id={audit_id}/attempt={attempt}/marker={step}")
        self.after(name)

    def _hours(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path).groupBy(F.date_trunc("hour", "event_time")).agg(F.count("*").alias("n"))

    def _verify(
        self, audit_id: str, attempt: int, extract: str, lo: Column, hi: Column, hours: int, mark: Callable
    ) -> None:
        """Trips of the window in the stage against the extracted ones, by id and hour."""
        hour = F.date_trunc("hour", "event_time").alias("event_hour")
        held = self.stage().where((F.col("event_time") >= lo) & (F.col("event_time") < hi))
        per_hour = rollup.drift(self.spark.read.parquet(extract).select("trip_id", hour), held)
        wrong = F.col("missing") + F.col("unexpected") + F.col("moved")
        off = per_hour.agg(F.coalesce(F.sum(wrong), F.lit(0)).alias("trips"), F.count_if(wrong > 0).alias("hours")).first()
        if not off["trips"]:
            mark(VERIFIED)
            return
        self._alert(f"{audit_id}-{attempt}", "rollup_drift", audit_id, lo, hi, hours, off["trips"])
        mark(DRIFTED, rows=off["trips"], notes=f"{off['trips']} trips of {off['hours']} hours differ")
        raise RollupDrift(f"{audit_id}: {off['trips']} trips of {off['hours']} hours are not in the stage as extracted")

    def _alert(self, name: str, kind: str, audit_id: str, lo: Column, hi: Column, hours: int, rows: int) -> None:
        """One record of each kind and attempt, however often the step is repeated."""
        row = self.spark.range(1).select(
            F.lit(kind).alias("kind"), F.lit(audit_id).alias("audit_id"), lo.alias("window_start"), hi.alias("window_end"),
            F.lit(hours).alias("hours"), F.lit(rows).cast("bigint").alias("rows"),
        )
        append_alerts(row, f"{self.root}/alerts/alert={kind}-{name}")
