"""Hourly rollup: load closed hours into the stage table, verify, backfill, watch freshness."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.functions.timing import event_hour
from tallyport.operators.upsert import latest_per_key, partial_upsert, read_partial, write_delta

# Stage columns, columns a re-load may change, longest backfill in hours,
# promised delay of a load after its hour has closed.
STAGE_COLUMNS = [
    "trip_id", "event_id", "event_time", "city_id", "driver_id", "rider_id", "pickup_zone_id", "dropoff_zone_id",
    "vehicle_class", "payment_type", "distance_km", "duration_sec", "fare_amount", "surge_multiplier", "status",
]
UPDATED = ["event_time", "fare_amount", "status"]
MAX_BACKFILL_HOURS = 336
LOAD_SLA_MINUTES = 20
# Buckets of a sketch of distinct drivers, as a power of two, and the relative error it is
# used with: three times its standard error of 1.6 %.
SKETCH_LG_K = 12
SKETCH_BOUND = 0.05

HOUR = "INTERVAL 1 HOUR"


def with_defaults(rows: DataFrame) -> DataFrame:
    """Missing measures become 0 and a missing or zero surge becomes 1."""
    surge = F.when(F.col("surge_multiplier") == 0, 1.0).otherwise(F.coalesce("surge_multiplier", F.lit(1.0)))
    return rows.withColumns(
        {
            "distance_km": F.coalesce("distance_km", F.lit(0.0)),
            "duration_sec": F.coalesce("duration_sec", F.lit(0)),
            "fare_amount": F.coalesce("fare_amount", F.lit(0.0)),
            "surge_multiplier": surge,
        }
    )


def closed_hours(city_hour: DataFrame, start: Column, end: Column) -> DataFrame:
    """Rows of the hours in [start, end). On the stored table the day folders are pruned too."""
    inside = (F.col("event_hour") >= start) & (F.col("event_hour") < end)
    if "event_date" in city_hour.columns:
        inside &= (F.col("event_date") >= F.to_date(start)) & (F.col("event_date") <= F.to_date(end))
    return city_hour.where(inside)


def stage_rows(city_hour: DataFrame, loaded_at: Column) -> DataFrame:
    """Rows for the stage table, one per trip."""
    rows = latest_per_key(with_defaults(city_hour), ["trip_id"], ["event_time", "event_id"])
    return rows.select(*STAGE_COLUMNS).withColumn("loaded_at", loaded_at)


def load_window(stage: DataFrame, new: DataFrame) -> DataFrame:
    """Stage table after a load: known trips change only in `UPDATED` and `loaded_at`."""
    return partial_upsert(stage, new, ["trip_id"], {**{c: None for c in UPDATED}, "loaded_at": None})


def write_load(rows: DataFrame, path: str, load_id: int) -> None:
    """Store one load of the stage table; running it again replaces it."""
    write_delta(rows, path, load_id)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """Stage table over all loads so far, as `load_window` would leave it."""
    return read_partial(spark, path, ["trip_id"], [*UPDATED, "loaded_at"]).select(*STAGE_COLUMNS, "loaded_at")


def drift(extracted: DataFrame, stage: DataFrame) -> DataFrame:
    """Per hour of the source: what was extracted against what the stage holds.

    Trips are matched by id, so one that moved to another hour is told apart from one
    that is missing.
    """
    source = extracted.select("trip_id", F.col("event_hour").alias("_from"))
    held = stage.select("trip_id", event_hour(F.col("event_time")).alias("_to"))
    both = source.join(held, "trip_id", "full_outer")
    return both.groupBy(F.coalesce("_from", "_to").alias("event_hour")).agg(
        F.count("_from").alias("extracted"),
        F.count("_to").alias("loaded"),
        F.count_if(F.col("_to").isNull()).alias("missing"),
        F.count_if(F.col("_from").isNull()).alias("unexpected"),
        F.count_if(F.col("_from") != F.col("_to")).alias("moved"),
    ).withColumn("drift", F.col("extracted") - F.col("loaded"))


def completeness(city_hour: DataFrame, start: Column, end: Column) -> DataFrame:
    """Rows of every city and hour of [start, end), hours without rows included."""
    counts = closed_hours(city_hour, start, end).groupBy("city_id", "event_hour").agg(
        F.count(F.lit(1)).alias("rows")
    )
    spine = city_hour.select("city_id").distinct().select(
        "city_id", F.explode(F.sequence(start, end - F.expr(HOUR), F.expr(HOUR))).alias("event_hour")
    )
    return spine.join(counts, ["city_id", "event_hour"], "left").select(
        "city_id",
        "event_hour",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.col("rows").isNull().alias("is_empty"),
    )


def has_landed(city_hour: DataFrame, start: Column, end: Column, min_rows: int = 1) -> DataFrame:
    """Whether a window holds enough rows for its load to go ahead."""
    return closed_hours(city_hour, start, end).agg(
        F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) >= min_rows).alias("landed")
    )


def plan_backfill(start: datetime, end: datetime) -> int:
    """Hours of a backfill window; raises when it is empty or too long."""
    if end <= start:
        raise ValueError(f"window end {end} does not lie after its start {start}")
    hours = int((end - start) / timedelta(hours=1))
    if hours > MAX_BACKFILL_HOURS:
        raise ValueError(f"window has {hours} hours, at most {MAX_BACKFILL_HOURS} may be loaded at once")
    return hours


def landed_windows(city_hour: DataFrame, windows: list[tuple[datetime, datetime]], min_rows: int) -> DataFrame:
    """`has_landed` of several windows that do not overlap, in one pass over their rows."""
    at = lambda moment: F.lit(str(moment)).cast("timestamp")
    number = F.coalesce(*[
        F.when((F.col("event_hour") >= at(start)) & (F.col("event_hour") < at(end)), n) for n, (start, end) in enumerate(windows)
    ])
    counts = city_hour.groupBy(number.alias("_n")).agg(F.count(F.lit(1)).alias("rows"))
    wanted = F.array(*[F.struct(F.lit(n).alias("n"), at(start).alias("start")) for n, (start, _) in enumerate(windows)])
    every = city_hour.sparkSession.range(1).select(F.explode(wanted).alias("w")).select("w.n", F.col("w.start").alias("window_start"))
    rows = F.coalesce("rows", F.lit(0))
    return every.join(counts, F.col("n") == F.col("_n"), "left").select("window_start", rows.alias("rows"), (rows >= min_rows).alias("landed"))


def audit_view(audit_log: DataFrame) -> DataFrame:
    """Latest record of each load."""
    return latest_per_key(audit_log, ["audit_id"], ["step"]).drop("step")


def freshness_violations(stage: DataFrame, sla_minutes: int = LOAD_SLA_MINUTES) -> DataFrame:
    """Hours whose load finished later than promised after they closed."""
    hour = event_hour(F.col("event_time"))
    late = (F.unix_micros("loaded_at") - F.unix_micros(F.col("event_hour") + F.expr(HOUR))) / 60e6
    return (
        stage.groupBy(hour.alias("event_hour"))
        .agg(F.max("loaded_at").alias("loaded_at"), F.count(F.lit(1)).alias("trips"))
        .withColumn("minutes_after_close", F.round(late, 3))
        .where(F.col("minutes_after_close") > sla_minutes)
    )


def city_rollup(events: DataFrame, window: str, exact: bool = True) -> DataFrame:
    """Completed trips per city and tumbling event-time window; batch and stream alike.

    A stream cannot count distinct drivers exactly. Without `exact` the rollup keeps a
    sketch of them and its estimate, and the sums that averages are made of, so windows
    can be merged (`merge_windows`).
    """
    drivers = [F.count_distinct("driver_id").alias("active_drivers")]
    if not exact:
        drivers = [
            F.hll_sketch_agg("driver_id", SKETCH_LG_K).alias("driver_sketch"),
            F.sum("duration_sec").alias("duration_sum"), F.count("duration_sec").alias("durations"),
        ]
    rows = (
        events.where(F.col("status") == "completed")
        .groupBy(F.window("event_time", window).alias("_w"), "city_id")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.sum("fare_amount").alias("revenue"),
            F.avg("duration_sec").alias("avg_duration_sec"),
            *drivers,
        )
    )
    if not exact:
        rows = rows.withColumn("active_drivers", F.hll_sketch_estimate("driver_sketch"))
    kept = [c for c in rows.columns if c not in ("_w", "city_id")]
    return rows.select("city_id", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *kept)


def merge_windows(rollups: DataFrame, by: list[str]) -> DataFrame:
    """Stored windows added up by other columns: a driver in several windows or cities counts once."""
    return rollups.groupBy(*by).agg(
        F.sum("trips").alias("trips"), F.sum("revenue").alias("revenue"),
        (F.sum("duration_sum") / F.sum("durations")).alias("avg_duration_sec"),
        F.hll_union_agg("driver_sketch").alias("driver_sketch"),
    ).withColumn("active_drivers", F.hll_sketch_estimate("driver_sketch"))
