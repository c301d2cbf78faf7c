"""From raw log records to classified events.

`classify` is the one place where a record gets its route, for batch and stream alike.
Routes are disjoint and cover every record: a NULL in any test falls through to the
next test and in the end to a required-field check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyport.functions.keys import canonical_uuid
from tallyport.session import small_side
from tallyport.sources.schemas import EVENT_SCHEMA

# Fields an event must have, in the order in which they are checked.
REQUIRED_TEXT = ["event_id", "trip_id", "event_time", "city_id", "driver_id"]
REQUIRED_VALUES = ["fare_amount", "produced_at_ms"]

# Stages and reasons of quarantined records.
STAGE_PRODUCER = "producer"
STAGE_SINK = "cassandra_sink"
STAGE_PARSE = "parse"
STAGE_LATE = "late_event"
UNPARSEABLE_REASON = "JsonParseError: value did not match event schema"

OK, UNPARSEABLE, LATE, INVALID, DROPPED = "ok", "unparseable", "late", "invalid", "dropped"


def parse(raw: DataFrame) -> DataFrame:
    """Event fields beside the verbatim record and its coordinates (underscored)."""
    carried = [c for c in ("batch_no", "_record") if c in raw.columns]
    return (
        raw.select(
            F.col("value").alias("_raw"),
            F.col("topic").alias("_topic"),
            F.col("partition").alias("_partition"),
            F.col("offset").alias("_offset"),
            F.col("timestamp").alias("_log_time"),
            F.col("replay_count").alias("_replay_count"),
            *carried,
            F.from_json("value", EVENT_SCHEMA).alias("_event"),
        )
        .select("*", "_event.*")
        .drop("_event")
        .withColumn("_unparseable", F.col("event_id").isNull())
        .withColumn("event_time", F.try_to_timestamp(F.col("event_time")))
    )


def defect() -> Column:
    """First reason why an event can never be written, NULL when there is none."""
    missing = [
        F.when(
            F.col(name).isNull() if name == "event_time" else F.col(name).isNull() | (F.col(name) == ""),
            f"PermanentDefect: missing required field '{name}'",
        )
        for name in REQUIRED_TEXT
    ]
    nulls = [F.when(F.col(name).isNull(), f"PermanentDefect: {name} is null") for name in REQUIRED_VALUES]
    malformed = [
        F.when(canonical_uuid(F.col(name)).isNull(), "ValueError: badly formed hexadecimal UUID string")
        for name in ("trip_id", "event_id")
    ]
    return F.coalesce(*missing, *nulls, *malformed)


def validate(parsed: DataFrame) -> DataFrame:
    """Adds `defect`; keys of sound events are brought to their canonical spelling."""
    checked = parsed.withColumn("defect", F.when(~F.col("_unparseable"), defect()))
    sound = F.col("defect").isNull() & ~F.col("_unparseable")
    for name in ("trip_id", "event_id"):
        checked = checked.withColumn(
            name, F.when(sound, canonical_uuid(F.col(name))).otherwise(F.col(name))
        )
    return checked


def late_reason(cutoff: Column) -> Column:
    return F.concat(
        F.lit("LateEvent: event_time older than watermark "),
        F.date_format(cutoff, "yyyy-MM-dd'T'HH:mm:ss.SSSxxx"),
    )


def classify(parsed: DataFrame, cutoff: Column, policy: str = "dlq") -> DataFrame:
    """Validates and routes parsed records, see `assign_route`."""
    return assign_route(validate(parsed), cutoff, policy)


def assign_route(validated: DataFrame, cutoff: Column, policy: str = "dlq") -> DataFrame:
    """Adds `route`, `failure_stage` and `failure_reason`.

    An event older than `cutoff` is late. Policies: 'process' ignores lateness, 'dlq'
    quarantines late events, anything else counts and drops them. A NULL cutoff (no
    batch before this one) makes nothing late.
    """
    rows = validated.withColumn("_cutoff", cutoff)
    is_late = F.lit(False) if policy == "process" else F.coalesce(F.col("event_time") < F.col("_cutoff"), F.lit(False))
    route = (
        F.when(F.col("_unparseable"), UNPARSEABLE)
        .when(is_late, LATE if policy == "dlq" else DROPPED)
        .when(F.col("defect").isNotNull(), INVALID)
        .otherwise(OK)
    )
    return (
        rows.withColumn("route", route)
        .withColumn(
            "failure_stage",
            F.when(F.col("route").isin(UNPARSEABLE, INVALID), STAGE_PARSE).when(F.col("route") == LATE, STAGE_LATE),
        )
        .withColumn(
            "failure_reason",
            F.when(F.col("route") == UNPARSEABLE, UNPARSEABLE_REASON)
            .when(F.col("route") == LATE, late_reason(F.col("_cutoff")))
            .when(F.col("route") == INVALID, F.col("defect")),
        )
        .drop("_cutoff", "defect")
    )


def batch_cutoffs(parsed: DataFrame, lateness: int) -> DataFrame:
    """Cutoff of each batch of the log: high-water mark of the batches before, less lateness.

    Late rows never raise the mark, since they lie below it.
    """
    earlier = W.partitionBy("_topic").orderBy("batch_no").rowsBetween(W.unboundedPreceding, -1)
    per_batch = (
        parsed.where(~F.col("_unparseable"))
        .groupBy("_topic", "batch_no")
        .agg(F.max("event_time").alias("_high"))
    )
    return per_batch.select(
        "_topic",
        "batch_no",
        (F.max("_high").over(earlier) - F.make_dt_interval(secs=F.lit(lateness))).alias("_batch_cutoff"),
    )


def classify_log(parsed: DataFrame, lateness: int = 120, policy: str = "dlq") -> DataFrame:
    """`classify` over a whole log, each batch against its own cutoff."""
    return route_log(validate(parsed), lateness, policy)


def route_log(validated: DataFrame, lateness: int = 120, policy: str = "dlq") -> DataFrame:
    """`assign_route` over a whole validated log, each batch against its own cutoff.

    The log is read twice, for the cutoffs and for the routes: over a stored validated log
    neither parses a record again.
    """
    cutoffs = small_side(batch_cutoffs(validated, lateness))
    rows = validated.join(cutoffs, ["_topic", "batch_no"], "left")
    return assign_route(rows, F.col("_batch_cutoff"), policy).drop("_batch_cutoff")


def dedup(events: DataFrame) -> DataFrame:
    """One row per event id; a re-sent event is byte-identical, the first offset stays."""
    order = F.struct("_topic", "_partition", "_offset")
    newest = W.partitionBy("event_id").orderBy(order)
    return events.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")
