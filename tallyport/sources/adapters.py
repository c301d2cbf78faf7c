"""Views of the given tables in the shape of trips, raw log records and telemetry.

`trips` and `rides` are wide trip tables, `raw_events` is the raw log with defects in
it, and the rest are telemetry series. All are derived row by row (plus the key joins
of `trips`), so their size follows the tables.
"""

from __future__ import annotations

from datetime import date, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.functions.ranges import running_before
from tallyport.sources.tables import dealt, table

TOPIC = "trips.raw"
LOG_PARTITIONS = 6
SLICE_DAYS = 5
LATE_DAYS = 7
FIRST_DAY = "2024-01-01"

WIDE_COLUMNS = [
    "trip_id", "event_id", "event_time", "city_id", "city_name", "region", "driver_id",
    "rider_id", "pickup_zone_id", "dropoff_zone_id", "vehicle_class", "payment_type",
    "distance_km", "duration_sec", "fare_amount", "surge_multiplier", "status",
]

# The defect put into a log record, by event id; the first match wins.
DEFECTS = [
    ("truncated", 97, 0),
    ("null_fare", 89, 1),
    ("bad_time", 83, 2),
    ("late", 71, 3),
    ("duplicate", 53, 4),
    ("write_failure", 61, 5),
    ("producer_failure", 67, 6),
]


def _padded(text: Column, least: int) -> Column:
    """Zeros in front up to `least` characters; longer numbers stay whole."""
    return F.lpad(text, F.greatest(F.length(text), F.lit(least)), F.lit("0"))


def _tagged(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), _padded(number.cast("string"), 6))


def _uuid(head: Column, number: Column) -> Column:
    return F.concat(head, F.lit("-0000-4000-8000-"), _padded(F.lower(F.hex(number)), 12))


def trip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with what trips need of their order, customer, nation and region."""
    line = table(spark, sf_dir, "lineitem").drop("l_tax")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    # Places are joined to orders first, so that the order lines are shuffled only once.
    placed = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return line.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *line.columns, "c_nationkey", "n_name", "r_name", "o_custkey", "o_orderpriority"
    )


def trip_time() -> Column:
    return F.col("l_shipdate").cast("timestamp")


def trip_columns() -> list[Column]:
    """The columns of a wide trip from `trip_lines`. They are long texts for the most part, so
    whoever moves or sorts trips moves their lines and makes the trips of them afterwards."""
    trip_id = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return [
        trip_id.alias("trip_id"),
        F.concat_ws(
            "-", trip_id, F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
        ).alias("event_id"),
        trip_time().alias("event_time"),
        F.col("c_nationkey").cast("string").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("region"),
        _tagged("d-", F.col("l_suppkey")).alias("driver_id"),
        _tagged("r-", F.col("o_custkey")).alias("rider_id"),
        F.col("l_linenumber").alias("pickup_zone_id"),
        (F.col("l_partkey") % 40).cast("int").alias("dropoff_zone_id"),
        F.col("o_orderpriority").alias("vehicle_class"),
        F.col("l_returnflag").alias("payment_type"),
        F.col("l_quantity").alias("distance_km"),
        (F.col("l_quantity") * 60).cast("int").alias("duration_sec"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("fare_amount"),
        (1 + 10 * F.col("l_discount")).alias("surge_multiplier"),
        F.when(F.col("l_linestatus") == "F", "completed").otherwise("cancelled").alias("status"),
    ]


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide trips from order lines with their order, customer, nation and region."""
    return trip_lines(spark, sf_dir).select(*trip_columns())


def _event_fields(events: DataFrame) -> DataFrame:
    """Trip fields every event carries, before any defect."""
    k = F.get_json_object("props", "$.k").cast("int")
    user = F.col("user_id")
    return events.select(
        "event_id",
        "user_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "value",
        k.alias("k"),
        _uuid(F.lit("00000000"), F.col("event_id")).alias("event_uuid"),
        _uuid(_padded(F.lower(F.hex(user)), 8), F.col("event_id")).alias("trip_uuid"),
        F.col("event_type").alias("city_id"),
        _tagged("d-", user).alias("driver_id"),
        _tagged("r-", k).alias("rider_id"),
        (k % 40).alias("pickup_zone_id"),
        (user % 40).cast("int").alias("dropoff_zone_id"),
        F.element_at(F.array(*map(F.lit, ("economy", "comfort", "xl", "black"))), (user % 4 + 1).cast("int")).alias(
            "vehicle_class"
        ),
        F.element_at(F.array(*map(F.lit, ("card", "wallet", "cash"))), (user % 3 + 1).cast("int")).alias(
            "payment_type"
        ),
        k.cast("double").alias("distance_km"),
        (k * 60 + 30).alias("duration_sec"),
        F.when(k % 5 == 0, 1.5).otherwise(1.0).alias("surge_multiplier"),
        F.when(F.col("event_type") == "error", "cancelled").otherwise("completed").alias("status"),
    )


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide trips from the events table: the corpus with a time of day."""
    e = _event_fields(table(spark, sf_dir, "events"))
    return e.select(
        F.col("trip_uuid").alias("trip_id"),
        F.col("event_uuid").alias("event_id"),
        F.col("ts").alias("event_time"),
        "city_id",
        F.col("city_id").alias("city_name"),
        F.when(F.col("city_id").isin("view", "click"), "browse").otherwise("act").alias("region"),
        "driver_id", "rider_id", "pickup_zone_id", "dropoff_zone_id", "vehicle_class", "payment_type",
        "distance_km", "duration_sec",
        F.col("value").cast("decimal(12,2)").alias("fare_amount"),
        "surge_multiplier", "status",
    )


def slice_of(ts: Column) -> Column:
    """Number of the arrival slice (micro-batch) a record belongs to."""
    return F.floor(F.datediff(ts, F.lit(FIRST_DAY).cast("date")) / SLICE_DAYS).cast("bigint")


def defect_of(event_id: Column) -> Column:
    return F.coalesce(*[F.when(event_id % m == r, name) for name, m, r in DEFECTS])


def _messages(events: DataFrame) -> DataFrame:
    """Every event as the text its producer would send, with its defect."""
    e = _event_fields(events).withColumn("defect", defect_of(F.col("event_id")))
    sent = F.when(F.col("defect") == "late", F.col("ts") - F.expr(f"INTERVAL {LATE_DAYS} DAYS")).otherwise(
        F.col("ts")
    )
    iso = F.date_format(sent, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    payload = F.to_json(
        F.struct(
            F.col("event_uuid").alias("event_id"),
            F.col("trip_uuid").alias("trip_id"),
            F.when(F.col("defect") == "bad_time", "not-a-time").otherwise(iso).alias("event_time"),
            F.unix_millis("ts").alias("produced_at_ms"),
            "city_id", "driver_id", "rider_id", "pickup_zone_id", "dropoff_zone_id",
            "vehicle_class", "payment_type", "distance_km", "duration_sec",
            F.when(F.col("defect") == "null_fare", F.lit(None)).otherwise(F.col("value")).alias("fare_amount"),
            "surge_multiplier", "status",
            F.lit("producer-1").alias("producer_id"),
            F.lit(1).alias("schema_version"),
        )
    )
    half = F.left(payload, F.floor(F.length(payload) / 2).cast("int"))
    return e.select(
        "event_id",
        "ts",
        F.coalesce("defect", F.lit("none")).alias("defect"),
        F.col("trip_uuid").alias("key"),
        F.when(F.col("defect") == "truncated", half).otherwise(payload).alias("value"),
    )


def slice_events(spark: SparkSession, sf_dir: str, slice_no: int) -> DataFrame:
    """The events of one arrival slice."""
    first = date.fromisoformat(FIRST_DAY) + timedelta(days=SLICE_DAYS * slice_no)
    bounds = [F.lit(d.isoformat()).cast("timestamp_ntz") for d in (first, first + timedelta(days=SLICE_DAYS))]
    return table(spark, sf_dir, "events").where((F.col("ts") >= bounds[0]) & (F.col("ts") < bounds[1]))


def raw_events(spark: SparkSession, sf_dir: str, slice_no: int | None = None) -> DataFrame:
    """The raw log, or one arrival slice of it; `batch_no` is the slice."""
    events = table(spark, sf_dir, "events") if slice_no is None else slice_events(spark, sf_dir, slice_no)
    copies = F.when(F.col("defect") == "duplicate", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        _messages(dealt(events))
        .where(F.col("defect") != "producer_failure")
        .withColumn("copy", F.explode(copies))
        .select(
            "key",
            "value",
            F.lit(TOPIC).alias("topic"),
            F.pmod(F.col("event_id"), F.lit(LOG_PARTITIONS)).cast("int").alias("partition"),
            (F.floor(F.col("event_id") / LOG_PARTITIONS) * 2 + F.col("copy")).cast("bigint").alias("offset"),
            F.col("ts").alias("timestamp"),
            F.when(F.col("defect") == "write_failure", F.floor(F.col("event_id") / 61) % 5)
            .otherwise(0)
            .cast("int")
            .alias("replay_count"),
            slice_of(F.col("ts")).alias("batch_no"),
        )
    )


def undelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages the producer gave up on: they never reach the log."""
    return (
        _messages(table(spark, sf_dir, "events"))
        .where(F.col("defect") == "producer_failure")
        .select("key", "value", F.lit(TOPIC).alias("topic"), F.col("ts").alias("timestamp"))
    )


def write_attempts(spark: SparkSession, sf_dir: str, tables: list[str], max_attempts: int = 4) -> DataFrame:
    """Attempt log of the event writes: one row per event, table and attempt.

    Events marked `write_failure` fail `event_id % 6` times on the driver-day table
    before they succeed; all other writes succeed at once.
    """
    e = dealt(table(spark, sf_dir, "events").select("event_id")).select("event_id", defect_of(F.col("event_id")).alias("defect"))
    failing = F.when(
        (F.col("defect") == "write_failure") & (F.col("table") == "trips_by_driver_day"),
        (F.col("event_id") % 6).cast("int"),
    ).otherwise(0)
    writes = (
        e.where(F.col("defect").isNull() | F.col("defect").isin("duplicate", "write_failure"))
        .withColumn("table", F.explode(F.array(*map(F.lit, tables))))
        .withColumn("failures", failing)
    )
    tried = F.least(F.col("failures") + 1, F.lit(max_attempts))
    return writes.withColumn("attempt", F.explode(F.sequence(F.lit(1), tried))).select(
        _uuid(F.lit("00000000"), F.col("event_id")).alias("event_id"),
        "table",
        "attempt",
        (F.col("attempt") > F.col("failures")).alias("ok"),
        F.when(
            F.col("attempt") <= F.col("failures"),
            F.when(F.col("attempt") % 2 == 1, "WriteTimeout").otherwise("Unavailable"),
        ).alias("error"),
        F.lit(False).alias("permanent"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry samples from the events table, five runs."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), (F.col("user_id") % 5).cast("string")).alias("run_id"),
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        "event_type",
    )


def duration_counters(spark: SparkSession, sf_dir: str, bounds: list[float]) -> DataFrame:
    """The samples' values as counters of a cumulative histogram, which restart every day."""
    rows = samples(spark, sf_dir).withColumn("day", F.to_date("ts"))
    under = [(F.col("value") <= F.lit(float(b))).cast("int") for b in bounds] + [F.col("value").isNotNull().cast("int")]
    counted = running_before(
        rows, ["run_id", "day"], ["ts", "event_id"], {f"c{i}": F.coalesce(c, F.lit(0)) for i, c in enumerate(under)}
    )
    so_far = F.array(*[F.col(f"c{i}") + F.coalesce(c, F.lit(0)) for i, c in enumerate(under)]).cast("array<bigint>")
    return counted.select("run_id", "event_id", "ts", so_far.alias("cumulative"))


class UnsteadyStore:
    """Write function of a store with passing, lasting and raised failures, by event number.

    The first write of every batch raises. After that some events are refused for ever,
    some time out every time, and some get through at the fourth attempt.
    """

    # What befalls an event whose number leaves this remainder; the first match wins.
    REFUSED, TIMES_OUT, BUSY = (41, 5), (43, 6), (47, 7)

    def __init__(self):
        self.calls: dict[str, int] = {}

    def __call__(self, batch: pd.DataFrame) -> list[str | None]:
        ids = list(batch["event_id"])
        new = any(i not in self.calls for i in ids)
        for i in ids:
            self.calls[i] = self.calls.get(i, 0) + 1
        if new:
            raise ConnectionError("reset by peer")
        return [self.error(int(i[-12:], 16), self.calls[i]) for i in ids]

    def error(self, number: int, call: int) -> str | None:
        hit = lambda rule: number % rule[0] == rule[1]
        if hit(self.REFUSED):
            return "!InvalidRequest: refused"
        if hit(self.TIMES_OUT):
            return "WriteTimeout: slow"
        return "Unavailable: busy" if hit(self.BUSY) and call < 4 else None
