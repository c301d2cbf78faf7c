"""One event to several serving tables, and the keyed reads those tables are for."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.functions.timing import event_hour
from tallyport.operators import compaction
from tallyport.operators.upsert import latest_per_key, read_latest, write_delta, write_folders
from tallyport.sources.files import Storage
from tallyport.sources.schemas import SERVING_TABLES

# Key buckets of a table that no other number was set for.
KEY_BUCKETS = 16
# Writes of several writers are comparable by the time of ingest, and in one batch by log order.
WRITE_ORDER = ["ingested_at_ms", "log_offset"]
# Folder columns of each table, and the order of rows inside its files. Hours are found
# by day folder and by the row-group statistics of the sorted hour; a folder per hour
# would leave a stream with a great many tiny files. The number of key buckets is set for a
# table and stands beside the bucket, so folders of different numbers can be read together.
LAYOUT = {
    "trips_by_id": (["buckets", "key_bucket"], ["trip_id"]),
    "trips_by_driver_day": (["event_date"], ["driver_id", "event_time desc", "trip_id"]),
    "trips_by_city_hour": (["event_date"], ["event_hour", "city_id", "trip_id"]),
}


def key_bucket(trip_id: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(trip_id), buckets).cast("int")


def bucketed(rows: DataFrame, path: str) -> DataFrame:
    """Rows with the key bucket that new folders of the table have."""
    buckets = compaction.manifest(rows.sparkSession, path).buckets or KEY_BUCKETS
    return rows.withColumn("buckets", F.lit(buckets)).withColumn("key_bucket", key_bucket(F.col("trip_id"), F.col("buckets")))


def fanout(
    events: DataFrame, ingested_at_ms: Column, tables: list[str] | None = None, latest: bool = True
) -> dict[str, DataFrame]:
    """Rows of each serving table; the event date and hour are taken in UTC.

    With `latest` each key holds its last record in log order. Without it all records
    are kept with their `log_offset`, and the reader picks the last one: a stream
    writes this form, which spares it a shuffle per table. Records of one key share a
    log partition, so offsets order them.
    """
    rows = (
        events.withColumn("ingested_at_ms", ingested_at_ms)
        .withColumn("event_date", F.to_date("event_time"))
        .withColumn("event_hour", event_hour(F.col("event_time")))
        .withColumn("log_offset", F.col("_offset"))
    )
    out = {}
    for name in tables or list(SERVING_TABLES):
        columns, keys = SERVING_TABLES[name]
        if latest:
            out[name] = latest_per_key(rows, keys, ["log_offset"]).select(*columns)
        else:
            out[name] = rows.select(*columns, "log_offset")
    return out


def write_serving(tables: dict[str, DataFrame], root: str, write_id: int, writer: str = "stream") -> None:
    """Write one batch of each table; every writer has folders, and so write ids, of its own."""
    for name, rows in tables.items():
        if name == "trips_by_id":
            rows = bucketed(rows, f"{root}/{name}")
        if name == "trips_by_city_hour":
            rows = rows.withColumn("event_date", F.to_date("event_hour"))
        write_delta(rows, f"{root}/{name}/writer={writer}", write_id, *LAYOUT[name])


def compact_serving(
    spark: SparkSession, root: str, tables: list[str] | None = None, fan_in: int = compaction.FAN_IN
) -> dict[str, compaction.Manifest]:
    """Merge the deltas of each table in place; beside a running stream as well."""

    def one(name: str) -> compaction.Manifest:
        path, keys = f"{root}/{name}", SERVING_TABLES[name][1]

        def resolve(rows: DataFrame) -> DataFrame:
            newest = latest_per_key(rows, keys, WRITE_ORDER)
            return bucketed(newest, path) if name == "trips_by_id" else newest

        return compaction.compact(spark, path, resolve, lambda rows, into: write_folders(rows, into, *LAYOUT[name]), fan_in)

    return {name: one(name) for name in tables or list(SERVING_TABLES)}


def read_serving(spark: SparkSession, root: str, name: str) -> DataFrame:
    columns, keys = SERVING_TABLES[name]
    return read_latest(spark, f"{root}/{name}", keys, WRITE_ORDER).select(*columns)


def trip_lookup(spark: SparkSession, root: str, trip_ids: DataFrame | list[str]) -> DataFrame:
    """Trips by id. A list of ids becomes filters, which leave only their bucket folders
    to read; a DataFrame of ids is joined on bucket and id."""
    columns, keys = SERVING_TABLES["trips_by_id"]
    rows = compaction.read_live(spark, f"{root}/trips_by_id")
    bucket = F.col("key_bucket")
    if isinstance(trip_ids, list):
        # On folder columns and constants only, so folders are left out whatever their number of buckets.
        there = [bucket == key_bucket(F.lit(i), F.col("buckets")) for i in trip_ids] or [F.lit(False)]
        found = rows.where(reduce(or_, there) & F.col("trip_id").isin(*trip_ids))
    else:
        there = Storage(spark, f"{root}/trips_by_id").matching("writer=*/write_id=*/buckets=*")
        numbers = sorted({int(folder.rpartition("=")[2]) for folder in there})
        wanted = (
            trip_ids.select("trip_id").distinct()
            .withColumn("buckets", F.explode(F.array(*map(F.lit, numbers)).cast("array<int>")))
            .withColumn("key_bucket", key_bucket(F.col("trip_id"), F.col("buckets")))
        )
        found = rows.join(wanted, ["buckets", "key_bucket", "trip_id"], "left_semi")
    return latest_per_key(found, keys, WRITE_ORDER).select(*columns)


def driver_day(spark: SparkSession, root: str, driver_id: str | None = None, day: str | None = None) -> DataFrame:
    """Trips of a driver and day (or of all), newest first."""
    columns, keys = SERVING_TABLES["trips_by_driver_day"]
    rows = compaction.read_live(spark, f"{root}/trips_by_driver_day")
    if day:
        rows = rows.where(F.col("event_date") == F.lit(day).cast("date"))
    if driver_id:
        rows = rows.where(F.col("driver_id") == driver_id)
    return latest_per_key(rows, keys, WRITE_ORDER).select(*columns).orderBy(
        "driver_id", "event_date", F.desc("event_time"), "trip_id"
    )


def city_hours(
    spark: SparkSession, root: str, start: datetime, end: datetime, city_ids: list[str] | None = None
) -> DataFrame:
    """Trips of the hours in [start, end), of some cities or all.

    The hour and the city are part of the key, and the day follows from the hour: all
    filters hold before the last write of a key is picked, so they reach folders and files.
    """
    columns, keys = SERVING_TABLES["trips_by_city_hour"]
    lo, hi = F.lit(str(start)).cast("timestamp"), F.lit(str(end)).cast("timestamp")
    rows = compaction.read_live(spark, f"{root}/trips_by_city_hour").where(
        F.col("event_date").between(F.to_date(lo), F.to_date(hi)) & (F.col("event_hour") >= lo) & (F.col("event_hour") < hi)
    )
    if city_ids is not None:
        rows = rows.where(F.col("city_id").isin(*city_ids))
    return latest_per_key(rows, keys, WRITE_ORDER).select(*columns)


def city_hour(spark: SparkSession, root: str, city_id: str, hour: str) -> DataFrame:
    """Trips of one city and hour ('2024-01-08 13:00:00')."""
    start = datetime.fromisoformat(hour)
    return city_hours(spark, root, start, start + timedelta(hours=1), [city_id]).orderBy("trip_id")
