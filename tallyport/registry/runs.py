"""Work that several registered queries share, done once per session and data folder."""

from __future__ import annotations

from contextlib import suppress
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.operators import parse, quarantine, retry
from tallyport.operators.compaction import read_live
from tallyport.plans import star
from tallyport.plans.flow import LOADED, RollupDrift, RollupFlow
from tallyport.plans.rollup import write_load
from tallyport.session import configure, new_folder
from tallyport.sources import adapters, tables
from tallyport.sources.files import Storage
from tallyport.sources.raw_log import publish_files, read_raw_stream
from tallyport.sources.schemas import SERVING_TABLES
from tallyport.sources.tables import table
from tallyport.streaming.ingest import IngestJob

_done: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make):
    """What `make` made for the tables as they are now; a table that has changed makes it anew."""
    found = Storage(spark, sf_dir).matching("*.parquet")
    key = (spark.sparkContext.applicationId, sf_dir, name, tuple(sorted(found.items())))
    if key not in _done:
        configure(spark)
        _done[key] = make()
    return _done[key]


def _days_of(df: DataFrame, column: str) -> tuple[str, str]:
    """First day of a column, and the day after its last."""
    day = F.to_date(F.col(column).cast("timestamp"))
    row = df.agg(F.min(day).cast("string").alias("first"), F.date_add(F.max(day), 1).cast("string").alias("end")).first()
    return row["first"] or "1970-01-01", row["end"] or "1970-01-02"


def trip_window(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """[first day, day after the last) of the trips."""
    return _once(spark, sf_dir, "trip-window", lambda: _days_of(table(spark, sf_dir, "lineitem"), "l_shipdate"))


def ride_window(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return _once(spark, sf_dir, "ride-window", lambda: _days_of(table(spark, sf_dir, "events"), "ts"))


def trip_house(spark: SparkSession, sf_dir: str) -> star.Warehouse:
    def load() -> star.Warehouse:
        rows = table(spark, sf_dir, "lineitem").count()
        lines = adapters.trip_lines(spark, sf_dir)
        return star.load(
            spark, lines, rows, star.TRIP_LABELS, *trip_window(spark, sf_dir), "trips", adapters.trip_time(), adapters.trip_columns()
        )

    return _once(spark, sf_dir, "trips", load)


def ride_house(spark: SparkSession, sf_dir: str) -> star.Warehouse:
    def load() -> star.Warehouse:
        rows = table(spark, sf_dir, "events").count()
        return star.load(spark, adapters.rides(spark, sf_dir), rows, star.RIDE_LABELS, *ride_window(spark, sf_dir), "rides")

    return _once(spark, sf_dir, "rides", load)


def slices(spark: SparkSession, sf_dir: str) -> range:
    """Numbers of the arrival slices of the log, none left out."""
    ts = F.col("ts").cast("timestamp")
    ends = table(spark, sf_dir, "events").agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    row = ends.select(adapters.slice_of(F.col("lo")).alias("lo"), adapters.slice_of(F.col("hi")).alias("hi")).first()
    return range(row["lo"], row["hi"] + 1) if row["lo"] is not None else range(0)


@dataclass(frozen=True)
class IngestRun:
    job: IngestJob
    log: str
    batches: int
    slice_files: int = 0


def ingest_run(spark: SparkSession, sf_dir: str) -> IngestRun:
    """The stream over the whole log: each slice lands, is processed as one batch, and
    the query stops; the next slice resumes from the checkpoint. The serving tables are
    compacted between batches. One batch is run a second time on the way, as after a crash
    before its commit, when its first writes have been merged already."""

    def run() -> IngestRun:
        root = new_folder(spark, "ingest")
        log = f"{root}/raw_log"
        job = IngestJob(spark, root, run_id="registered", sample_rate=1.0, compact_every=2, fan_in=2)
        batches = slices(spark, sf_dir)
        for batch_id, n in enumerate(batches):
            slice_rows = adapters.raw_events(spark, sf_dir, n)
            publish_files(slice_rows, log)
            job.run_available(read_raw_stream(spark, log))
            if batch_id == len(batches) // 2:
                job.process(slice_rows.drop("batch_no"), batch_id)
        return IngestRun(job, log, len(batches))

    return _once(spark, sf_dir, "ingest", run)


# Files that a slice of the log lands in at least, and that a batch of the bounded stream takes.
SLICE_FILES = 4


def files_for(rows: list[int]) -> int:
    """Files for every slice, one a task's rows. The smallest slice decides: each must fill them all."""
    return max(SLICE_FILES, min(rows, default=0) // tables.ROWS_PER_TASK)


def delivery_run(spark: SparkSession, sf_dir: str) -> IngestRun:
    """A stream that takes a slice's files a batch from a log that has landed whole, and
    delivers to an external store that fails. One batch is run a second time."""

    def run() -> IngestRun:
        root = new_folder(spark, "delivery")
        job = IngestJob(
            spark, root, run_id="delivery", tables=["trips_by_id"], sample_rate=0.25, log=f"{root}/raw_log",
            external_write=adapters.UnsteadyStore(), retry_policy=retry.RetryPolicy(schedule_ms=(2, 4, 8)),
        )
        batches = slices(spark, sf_dir)
        files = files_for([adapters.slice_events(spark, sf_dir, n).count() for n in batches])
        for n in batches:
            publish_files(adapters.raw_events(spark, sf_dir, n).repartition(files), job.log)
        job.run_available(read_raw_stream(spark, job.log, max_files=files))
        if batches:
            job.process(adapters.raw_events(spark, sf_dir, batches[-1]).drop("batch_no"), len(batches) - 1)
        return IngestRun(job, job.log, len(batches), files)

    return _once(spark, sf_dir, "delivery", run)


BACKFILL_WIDTH = timedelta(days=14)


def stored_days(spark: SparkSession, sf_dir: str) -> tuple[datetime, datetime]:
    """The whole days of the stored city-hour table, from its folders."""
    days = read_live(spark, ingest_run(spark, sf_dir).job.path("trips_by_city_hour")).agg(
        F.min("event_date").cast("timestamp_ntz").alias("first"), (F.max("event_date") + F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz").alias("end")
    ).first()
    return days["first"], days["end"]


def backfill_windows(spark: SparkSession, sf_dir: str) -> list[tuple[datetime, datetime]]:
    """The stored days in windows of two weeks, and the empty day after them."""
    first, last = stored_days(spark, sf_dir)
    starts = [first + n * BACKFILL_WIDTH for n in range(-(-(last - first) // BACKFILL_WIDTH))]
    return [*((s, min(s + BACKFILL_WIDTH, last)) for s in starts), (last, last + timedelta(days=1))]


def rollup_run(spark: SparkSession, sf_dir: str) -> RollupFlow:
    """Loads of all windows from the stream's table into an empty stage.

    The flow of the first window dies after its load and is run again. The writer of the
    second loses the trips paid in cash, which its verification finds; it too is run again.
    """

    def run() -> RollupFlow:
        root, serving = new_folder(spark, "rollup"), ingest_run(spark, sf_dir).job.root

        def die(name: str) -> None:
            if name == LOADED:
                raise InterruptedError("lost its driver")

        def lossy(rows: DataFrame, path: str, load_id: int) -> None:
            write_load(rows.where("payment_type <> 'cash'"), path, load_id)

        sound = RollupFlow(spark, serving, root)
        faulty = {0: RollupFlow(spark, serving, root, after=die), 1: RollupFlow(spark, serving, root, write=lossy)}
        for n, (start, end) in enumerate(backfill_windows(spark, sf_dir)):
            loaded_at = F.lit(str(end)).cast("timestamp")
            if n in faulty:
                with suppress(InterruptedError, RollupDrift):
                    faulty[n].run(f"run-{n}", start, end, loaded_at)
            sound.run(f"run-{n}", start, end, loaded_at)
        return sound

    return _once(spark, sf_dir, "rollup", run)


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log as its producer left it: a table that is written once."""

    def write() -> str:
        path = new_folder(spark, "log")
        adapters.raw_events(spark, sf_dir).write.parquet(path)
        return path

    return spark.read.parquet(_once(spark, sf_dir, "log", write))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse(raw_log(spark, sf_dir))


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validated log as a table: each record is parsed and checked once, however
    many queries follow."""

    def write() -> str:
        path = new_folder(spark, "validated")
        parse.validate(parsed(spark, sf_dir)).write.parquet(path)
        return path

    return spark.read.parquet(_once(spark, sf_dir, "validated", write))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classified log. A route follows from a record's stored columns and its batch's cutoff."""
    return parse.route_log(validated(spark, sf_dir))


def sound_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(spark, sf_dir).where(F.col("route") == parse.OK)


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.write_attempts(spark, sf_dir, list(SERVING_TABLES), retry.MAX_ATTEMPTS)


def exhausted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The writes that ran out of attempts, as a table."""

    def write() -> str:
        path = new_folder(spark, "exhausted")
        lost = retry.exhausted_writes(attempts(spark, sf_dir))
        lost.select("event_id", "table", "attempts", "last_error").write.parquet(path)
        return path

    return spark.read.parquet(_once(spark, sf_dir, "exhausted", write))


def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of all four producers, as the stored quarantine that replays start from."""

    def write() -> str:
        rows = classified(spark, sf_dir)
        at_log_time = F.unix_millis("_log_time")
        failed, lost = exhausted(spark, sf_dir), adapters.undelivered(spark, sf_dir)
        sound = parse.dedup(quarantine.concerned(rows.where(F.col("route") == parse.OK), failed))
        path = new_folder(spark, "quarantine")
        (
            quarantine.from_classified(rows, at_log_time)
            .unionByName(quarantine.from_sink(sound, failed, at_log_time))
            .unionByName(
                quarantine.from_producer(lost, "KafkaException: delivery failed", 4, F.unix_millis("timestamp"))
            )
            .write.parquet(path)
        )
        return path

    return spark.read.parquet(_once(spark, sf_dir, "quarantine", write))
