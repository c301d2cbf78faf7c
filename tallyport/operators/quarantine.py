"""Quarantine envelopes: building, storing, profiling, routing and replaying them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyport.operators.parse import (
    OK, STAGE_LATE, STAGE_PARSE, STAGE_PRODUCER, STAGE_SINK, UNPARSEABLE, UNPARSEABLE_REASON, parse, validate,
)
from tallyport.session import small_side
from tallyport.sources.schemas import ENVELOPE_SCHEMA

# Envelope version, replay ceiling, and which stages are replayed how.
ENVELOPE_VERSION = 1
MAX_REPLAYS = 3
REINJECT_STAGES = [STAGE_SINK, STAGE_PRODUCER]
DIRECT_STAGES = [STAGE_LATE]
UNREADABLE_STAGE = "unreadable_dlq_record"
# Event ids that are broadcast at most, and only if they are small in bytes as well.
CONCERNED_ROWS = 500_000


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def envelope(
    rows: DataFrame,
    payload: Column,
    reason: Column,
    stage: Column,
    retry_count: Column,
    at_ms: Column,
    event_id: Column | None = None,
    topic: Column | None = None,
    partition: Column | None = None,
    offset: Column | None = None,
    replay_count: Column | None = None,
    host: str = "",
) -> DataFrame:
    """Envelope rows of any producer; the payload is kept verbatim, whole.

    Without an `event_id` it is read from the payload; an unreadable payload has none.
    """
    read_id = F.from_json(payload, "event_id string")["event_id"]
    none = F.lit(None)
    return rows.select(
        payload.alias("original_payload"),
        reason.alias("failure_reason"),
        stage.alias("failure_stage"),
        retry_count.cast("int").alias("retry_count"),
        at_ms.cast("bigint").alias("first_failed_at_ms"),
        at_ms.cast("bigint").alias("quarantined_at_ms"),
        (read_id if event_id is None else event_id).alias("event_id"),
        (none if topic is None else topic).cast("string").alias("source_topic"),
        (none if partition is None else partition).cast("int").alias("source_partition"),
        (none if offset is None else offset).cast("bigint").alias("source_offset"),
        (F.lit(0) if replay_count is None else replay_count).cast("int").alias("replay_count"),
        F.lit(host).alias("host"),
        F.lit(ENVELOPE_VERSION).alias("dlq_schema_version"),
    )


def from_classified(classified: DataFrame, at_ms: Column) -> DataFrame:
    """Envelopes of the records that parsing, validation and lateness set aside."""
    aside = classified.where(F.col("failure_stage").isNotNull())
    return envelope(
        aside,
        F.col("_raw"),
        F.col("failure_reason"),
        F.col("failure_stage"),
        F.lit(0),
        at_ms,
        event_id=F.when(F.col("route") != UNPARSEABLE, F.col("event_id")),
        topic=F.col("_topic"),
        partition=F.col("_partition"),
        offset=F.col("_offset"),
        replay_count=F.col("_replay_count"),
    )


def concerned(events: DataFrame, exhausted: DataFrame) -> DataFrame:
    """All records of the events that have a write in `exhausted`.

    Only these need to be moved to find the first record of each event; the others stay where
    they are as long as the ids can be broadcast. If not, the shuffle by id serves both.
    """
    ids = exhausted.select("event_id").where(F.col("event_id").isNotNull()).distinct()
    return events.join(small_side(ids, CONCERNED_ROWS), "event_id", "left_semi")


def from_sink(events: DataFrame, exhausted: DataFrame, at_ms: Column) -> DataFrame:
    """Envelopes of events whose writes ran out of attempts: one per event.

    `exhausted` has one row per event and failed table (event_id, table, attempts,
    last_error); several failed tables of an event share its envelope.
    """
    per_event = exhausted.groupBy("event_id").agg(
        F.max("attempts").alias("_attempts"),
        F.max_by("last_error", "table").alias("_error"),
        F.array_sort(F.collect_set("table")).alias("_tables"),
    )
    rows = events.join(per_event, "event_id")
    return envelope(
        rows,
        F.col("_raw"),
        F.concat(F.col("_error"), F.lit(": "), F.concat_ws(",", "_tables")),
        F.lit(STAGE_SINK),
        F.col("_attempts"),
        at_ms,
        event_id=F.col("event_id"),
        topic=F.col("_topic"),
        partition=F.col("_partition"),
        offset=F.col("_offset"),
        replay_count=F.col("_replay_count"),
    )


def from_producer(undelivered: DataFrame, error: str, attempts: int, at_ms: Column) -> DataFrame:
    """Envelopes of messages that never reached the log."""
    return envelope(
        undelivered,
        F.col("value"),
        F.lit(error),
        F.lit(STAGE_PRODUCER),
        F.lit(attempts),
        at_ms,
        topic=F.col("topic"),
    )


def append_quarantine(envelopes: DataFrame, path: str, batch_id: int) -> None:
    """One folder per batch: a re-run batch replaces its own records."""
    envelopes.write.mode("overwrite").partitionBy("failure_stage").parquet(f"{path}/batch_id={batch_id}")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE_SCHEMA + ", batch_id bigint").option("basePath", path).parquet(path)


def as_messages(envelopes: DataFrame, topic: str) -> DataFrame:
    """Envelopes as JSON messages of a quarantine log, keyed by event."""
    return envelopes.select(
        F.coalesce("event_id", F.sha2("original_payload", 256)).alias("key"),
        F.to_json(F.struct(*StructType.fromDDL(ENVELOPE_SCHEMA).fieldNames())).alias("value"),
        F.lit(topic).alias("topic"), F.lit(0).alias("replay_count"),
    )


def read_envelope_messages(messages: DataFrame) -> DataFrame:
    """Envelopes from a JSON log of them: unknown fields are dropped, missing ones default.

    A message that is not an envelope is kept whole, under a stage of its own.
    """
    e = F.from_json("value", ENVELOPE_SCHEMA)
    rows = messages.withColumn("_e", e)
    readable = F.coalesce(F.col("_e.original_payload").isNotNull(), F.lit(False))
    return rows.select(
        F.when(readable, F.col("_e.original_payload")).otherwise(F.col("value")).alias("original_payload"),
        "_e.failure_reason",
        F.when(readable, F.coalesce("_e.failure_stage", F.lit("?"))).otherwise(UNREADABLE_STAGE).alias("failure_stage"),
        F.coalesce("_e.retry_count", F.lit(0)).alias("retry_count"),
        "_e.first_failed_at_ms",
        "_e.quarantined_at_ms",
        "_e.event_id",
        "_e.source_topic",
        "_e.source_partition",
        "_e.source_offset",
        F.coalesce("_e.replay_count", F.lit(0)).alias("replay_count"),
        F.coalesce("_e.host", F.lit("")).alias("host"),
        F.coalesce("_e.dlq_schema_version", F.lit(ENVELOPE_VERSION)).alias("dlq_schema_version"),
    )


def inspect(quarantine: DataFrame, *more: Column) -> DataFrame:
    """One row of totals: records, distinct events, retries, what a drain would do, and what else is asked for."""
    has_id = F.coalesce(F.col("event_id"), F.lit("")) != ""
    stage = F.col("failure_stage")
    return quarantine.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct(F.when(has_id, F.col("event_id"))).alias("distinct_event_ids"),
        F.count_if(~has_id).alias("records_without_event_id"),
        F.coalesce(F.round(F.avg(F.when(F.col("retry_count") > 0, F.col("retry_count"))), 3), F.lit(0.0)).alias(
            "mean_retry_count_when_retried"
        ),
        F.count_if(stage.isin(REINJECT_STAGES)).alias("would_reinject"),
        F.count_if(stage.isin(DIRECT_STAGES)).alias("would_direct_write"),
        F.count_if(stage == STAGE_PARSE).alias("would_park"),
        *more,
    )


def by_reason(quarantine: DataFrame) -> DataFrame:
    """Records per stage and reason prefix."""
    prefix = F.split_part(F.coalesce("failure_reason", F.lit("?")), F.lit(":"), F.lit(1))
    return quarantine.groupBy("failure_stage", prefix.alias("reason")).agg(F.count(F.lit(1)).alias("records"))


def sample(quarantine: DataFrame, rows: int = 3) -> DataFrame:
    """The few records that failed first, to look at."""
    return quarantine.orderBy("first_failed_at_ms", "failure_stage", "event_id", "source_offset").limit(rows)


def within_budget(quarantine: DataFrame, budget: int, parts: int = 64) -> DataFrame:
    """About `budget` records, the oldest of each of `parts` shares of the identities.

    Every share is cut for itself, before it is shuffled, so no task orders all records. A
    drain of these and one of the rest are together one drain of all.
    """
    share = F.pmod(F.xxhash64("_identity"), F.lit(parts))
    oldest = W.partitionBy("_share").orderBy("first_failed_at_ms", "_identity")
    return (
        quarantine.withColumn("_identity", identity()).withColumn("_share", share)
        .withColumn("_place", F.row_number().over(oldest)).where(F.col("_place") <= -(-budget // parts))
        .drop("_identity", "_share", "_place")
    )


def pending(quarantine: DataFrame, ledger: DataFrame) -> DataFrame:
    """Records no earlier drain has handled, matched by identity.

    A message is identified by its log coordinates, a record that never had any by its
    event id.
    """
    return (
        quarantine.withColumn("_identity", identity())
        .join(ledger.select("_identity").distinct(), "_identity", "left_anti")
        .drop("_identity")
    )


def identity() -> Column:
    """Identity of a quarantined record across drains: origin, stage and replay round.

    A record that never had log coordinates is told from a later failure of the same
    event by the time it first failed.
    """
    coordinates = F.concat_ws(
        "/", "source_topic", F.col("source_partition").cast("string"), F.col("source_offset").cast("string")
    )
    unlogged = F.concat_ws(
        "@", F.coalesce("event_id", F.sha2("original_payload", 256)), F.col("first_failed_at_ms").cast("string")
    )
    origin = F.when(F.col("source_offset").isNotNull(), coordinates).otherwise(unlogged)
    return F.concat_ws("|", origin, "failure_stage", F.col("replay_count").cast("string"))


def ledger_rows(settled: DataFrame) -> DataFrame:
    return settled.select(identity().alias("_identity"), "outcome")


def route(quarantine: DataFrame, max_replays: int = MAX_REPLAYS) -> DataFrame:
    """Adds `action` (reinject, direct_write, park) and `park_reason`: what is to be done."""
    stage = F.col("failure_stage")
    spent = F.col("replay_count") >= max_replays
    action = (
        F.when(spent, "park")
        .when(stage.isin(REINJECT_STAGES), "reinject")
        .when(stage.isin(DIRECT_STAGES), "direct_write")
        .otherwise("park")
    )
    why = F.when(spent, F.lit(f"replay_count >= {max_replays}")).otherwise(
        F.concat(F.lit("stage '"), stage, F.lit("' is not automatically recoverable"))
    )
    return quarantine.withColumn("action", action).withColumn("park_reason", F.when(F.col("action") == "park", why))


def settle(routed: DataFrame) -> DataFrame:
    """Adds `outcome` and `why`: what can be done with each record.

    A record to re-inject needs a readable payload and one to write a sound event; what
    fails there is parked with its reason, so every record ends in exactly one place.
    """
    message = F.from_json("original_payload", "event_id string, trip_id string")
    readable = message["event_id"].isNotNull() | message["trip_id"].isNotNull()
    checked = validate(parse(as_log(routed)))
    action, unsound = F.col("action"), F.col("_unparseable") | F.col("defect").isNotNull()
    outcome = (
        F.when((action == "reinject") & ~F.coalesce(readable, F.lit(False)), "reinject_failed")
        .when(action == "reinject", "reinjected")
        .when((action == "direct_write") & unsound, "direct_write_failed")
        .when(action == "direct_write", "direct_written")
        .otherwise("parked")
    )
    why = (
        F.when(F.col("outcome") == "reinject_failed", "payload is not readable")
        .when(F.col("outcome") == "direct_write_failed", F.coalesce("defect", F.lit(UNPARSEABLE_REASON)))
        .otherwise(F.col("park_reason"))
    )
    record = checked.select("_unparseable", "defect", *(F.col(f"_record.{c}").alias(c) for c in routed.columns))
    return record.withColumn("outcome", outcome).select(*routed.columns, "outcome", why.alias("why"))


def as_log(routed: DataFrame) -> DataFrame:
    """Records in the shape of the raw log, the record itself beside them."""
    return routed.select(
        F.col("original_payload").alias("value"),
        F.col("source_topic").alias("topic"),
        F.col("source_partition").alias("partition"),
        F.col("source_offset").alias("offset"),
        F.timestamp_millis("first_failed_at_ms").alias("timestamp"),
        "replay_count",
        F.struct(*routed.columns).alias("_record"),
    )


def reinject(routed: DataFrame, topic: str) -> DataFrame:
    """Messages for the raw log: verbatim payload, key trip id, one replay more."""
    trip = F.from_json("original_payload", "trip_id string")["trip_id"]
    return routed.where(F.col("action") == "reinject").select(
        F.coalesce(trip, F.col("event_id"), F.lit("unknown")).alias("key"),
        F.col("original_payload").alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("replay_count") + 1).cast("int").alias("replay_count"),
        F.col("failure_stage"),
    )


def direct_events(routed: DataFrame) -> DataFrame:
    """Late records parsed and validated again, without the lateness check.

    `defect` tells why a record still cannot be written.
    """
    return validate(parse(as_log(routed.where(F.col("action") == "direct_write")))).drop("_record")


def writable(events: DataFrame) -> DataFrame:
    return events.where(~F.col("_unparseable") & F.col("defect").isNull()).withColumn("route", F.lit(OK))


OUTCOMES = ["reinjected", "reinject_failed", "direct_written", "direct_write_failed", "parked"]


def drain_totals(settled: DataFrame, by: list[str] | None = None) -> DataFrame:
    """What a drain read against where it went: back, into the tables or parked, by decision or as it failed."""
    counts = [F.count_if(F.col("outcome") == name).alias(name) for name in OUTCOMES]
    totals = settled.groupBy(*by or []).agg(F.count(F.lit(1)).alias("records_read"), *counts)
    failed = F.col("reinject_failed") + F.col("direct_write_failed")
    done = F.col("reinjected") + F.col("direct_written") + F.col("parked") + failed
    return totals.withColumns({"failed": failed, "accounted_for": done, "unaccounted": F.col("records_read") - done})


def breaker_alert(quarantine: DataFrame, ceiling: int) -> DataFrame:
    """An alert row when there are too many records to drain without a person looking."""
    return (
        quarantine.agg(F.count(F.lit(1)).alias("records"))
        .where(F.col("records") > ceiling)
        .select(
            F.lit("dlq_circuit_breaker").alias("kind"),
            F.col("records"),
            F.lit(ceiling).cast("bigint").alias("ceiling"),
        )
    )
