"""Stateful streams: windowed rollup per city, duplicate absorption."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyport.operators.parse import parse
from tallyport.operators.upsert import latest_per_key
from tallyport.plans.rollup import city_rollup


def timed_events(raw: DataFrame, watermark: str) -> DataFrame:
    """Readable events with a time, under a watermark."""
    return (
        parse(raw)
        .where(~F.col("_unparseable") & F.col("event_time").isNotNull())
        .withWatermark("event_time", watermark)
    )


def start_city_rollup(
    raw: DataFrame, root: str, window: str = "1 minute", watermark: str = "2 minutes", trigger: dict | None = None
) -> StreamingQuery:
    """Rollup with its own checkpoint. Each trigger writes the windows it changed.

    The rows stay on the executors; a re-run trigger replaces its own folder.
    """
    def write(changed: DataFrame, batch_id: int) -> None:
        changed.withColumn("computed_at", F.current_timestamp()).write.mode("overwrite").parquet(
            f"{root}/city_rollup/batch_id={batch_id}"
        )

    return (
        city_rollup(timed_events(raw, watermark), window, exact=False)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{root}/checkpoint-rollup")
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def read_city_rollup(spark: SparkSession, root: str) -> DataFrame:
    """Latest value of each city and window, newest window first within a city."""
    path = f"{root}/city_rollup"
    rows = spark.read.option("basePath", path).parquet(path)
    return (
        latest_per_key(rows, ["city_id", "window_start"], ["batch_id"])
        .drop("batch_id")
        .orderBy("city_id", F.desc("window_start"))
    )


def start_dedup(raw: DataFrame, root: str, watermark: str, trigger: dict | None = None) -> StreamingQuery:
    """Pass each event on once, as long as its copies arrive within the watermark."""
    once = timed_events(raw, watermark).dropDuplicatesWithinWatermark(["event_id"])
    return (
        once.select("event_id", "trip_id", "event_time", "city_id", "driver_id", "fare_amount", "status")
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{root}/events")
        .option("checkpointLocation", f"{root}/checkpoint-dedup")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
