"""The registered queries: (spark, sf_dir) -> DataFrame over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.functions import ranges
from tallyport.functions.keys import log_partition
from tallyport.functions.sequences import counter_rate, longest_rising_run, trailing_slope
from tallyport.operators import fanout, key_map, latency, parse, quarantine, reconcile, retry, skew, telemetry, upsert
from tallyport.plans import drain as drains
from tallyport.plans import questions, reports, rollup, star
from tallyport.registry import runs
from tallyport.session import configure, new_folder
from tallyport.sources import adapters, raw_log
from tallyport.sources.tables import table
from tallyport.streaming import rollup as stream_rollup

LOG_TIME = "_log_time"
SLOPE_SECONDS = 7_200
RATE_SECONDS = 21_600
LAG_THRESHOLD = 5
STEP_SECONDS = 3_600
FIRST_LOAD_ENDS = "2024-01-16"

QUERIES: dict = {}


def present(df: DataFrame) -> DataFrame:
    """Plain column types: zone-less timestamps, dates as ISO text, doubles for decimals."""
    def plain(name: str, kind: str) -> Column:
        if kind == "timestamp":
            return F.col(name).cast("timestamp_ntz").alias(name)
        if kind == "date":
            return F.col(name).cast("string").alias(name)
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        return F.col(name)

    return df.select(*[plain(name, kind) for name, kind in df.dtypes])


def query(make):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(make(configure(spark), sf_dir))

    QUERIES[make.__name__] = run
    return make


def named(name: str):
    """`query` under another name than the function's."""
    def register(make):
        make.__name__ = name
        return query(make)

    return register


# -- the five questions ------------------------------------------------------------

def _question(name: str, on_star: bool):
    def run(spark, sf_dir):
        on_rides = name == "q4"
        house = (runs.ride_house if on_rides else runs.trip_house)(spark, sf_dir)
        window = (runs.ride_window if on_rides else runs.trip_window)(spark, sf_dir)
        wide, starred = questions.PAIRS[name]
        if on_star:
            return starred(house.window("fact_trip", *window), house.dims(), *window)
        return wide(house.window("trips_wide", *window), *window)

    run.__name__ = f"{name}_{'star' if on_star else 'wide'}"
    return run


for _name in questions.PAIRS:
    query(_question(_name, False))
    query(_question(_name, True))


@query
def q_equivalence(spark, sf_dir):
    out = None
    for name in questions.PAIRS:
        part = questions.compare(name, _question(name, False)(spark, sf_dir), _question(name, True)(spark, sf_dir))
        out = part if out is None else out.unionByName(part)
    return out


# -- star schema -------------------------------------------------------------------

@query
def dim_date(spark, sf_dir):
    return runs.trip_house(spark, sf_dir).dims()["dim_date"]


@query
def dim_city(spark, sf_dir):
    return runs.trip_house(spark, sf_dir).dims()["dim_city"]


@query
def dim_vehicle(spark, sf_dir):
    return runs.trip_house(spark, sf_dir).dims()["dim_vehicle"]


@query
def dim_payment(spark, sf_dir):
    return runs.trip_house(spark, sf_dir).dims()["dim_payment"]


@query
def dim_driver(spark, sf_dir):
    return runs.trip_house(spark, sf_dir).dims()["dim_driver"]


@query
def persistent_keys(spark, sf_dir):
    """Keys of customer names after two loads; those of the first stay."""
    path, names = new_folder(spark, "keys"), table(spark, sf_dir, "customer")
    key_map.extend_keys(spark, path, names.where("c_custkey % 3 = 0"), "c_name")
    return key_map.extend_keys(spark, path, names, "c_name").withColumnRenamed("c_name", "name")


@query
def star_fact(spark, sf_dir):
    return runs.trip_house(spark, sf_dir).fact.drop("period")


@query
def star_fk_violations(spark, sf_dir):
    """All facts against a city dimension that was loaded from completed rides only."""
    house = runs.ride_house(spark, sf_dir)
    done = house.wide.where("status = 'completed'").select("city_id").distinct()
    dims = house.dims()
    return star.fk_violations(house.fact, {**dims, "dim_city": dims["dim_city"].join(done, "city_id", "left_semi")})


@query
def storage_report(spark, sf_dir):
    """Rows of each stored table; files and bytes depend on the writer and are left out."""
    return star.storage_report(runs.trip_house(spark, sf_dir)).select("table_name", "rows")


# -- log, parsing, routing ---------------------------------------------------------

@query
def parse_events(spark, sf_dir):
    return runs.parsed(spark, sf_dir).select(
        F.col("_partition").alias("partition"), F.col("_offset").alias("offset"), F.col("_unparseable").alias("unparseable"),
        "event_id", "trip_id", "event_time", "produced_at_ms", "city_id", "driver_id", "rider_id", "pickup_zone_id",
        "dropoff_zone_id", "vehicle_class", "payment_type", "distance_km", "duration_sec", "fare_amount",
        "surge_multiplier", "status", "producer_id", "schema_version",
    )


@query
def validate_events(spark, sf_dir):
    return parse.validate(runs.parsed(spark, sf_dir)).select(
        F.col("_partition").alias("partition"), F.col("_offset").alias("offset"), "event_id", "defect"
    )


@query
def late_split(spark, sf_dir):
    return parse.classify_log(runs.parsed(spark, sf_dir)).select(
        "batch_no", F.col("_partition").alias("partition"), F.col("_offset").alias("offset"), "event_id",
        "event_time", "route", "failure_stage", "failure_reason",
    )


@query
def dedup_events(spark, sf_dir):
    readable = runs.classified(spark, sf_dir).where(~F.col("_unparseable"))
    return parse.dedup(readable).select(
        "event_id", "trip_id", F.col("_partition").alias("partition"), F.col("_offset").alias("offset"), "fare_amount"
    )


@query
def log_end_offsets(spark, sf_dir):
    return raw_log.end_offsets(runs.raw_log(spark, sf_dir))


@query
def partition_observed(spark, sf_dir):
    return skew.partition_observed(runs.raw_log(spark, sf_dir))


@query
def kafka_partition_of(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", log_partition(F.col("c_name"), adapters.LOG_PARTITIONS).alias("partition")
    )


@query
def partition_skew(spark, sf_dir):
    keys = ["trip_id", "city_id", "driver_id", "rider_id"]
    return skew.partition_skew(adapters.rides(spark, sf_dir), keys, adapters.LOG_PARTITIONS)


# -- serving tables ----------------------------------------------------------------

def _fanout(spark, sf_dir, name):
    events = runs.sound_events(spark, sf_dir)
    return fanout.fanout(events, F.unix_millis(LOG_TIME), [name])[name]


@query
def fanout_by_id(spark, sf_dir):
    return _fanout(spark, sf_dir, "trips_by_id")


@query
def fanout_driver_day(spark, sf_dir):
    return _fanout(spark, sf_dir, "trips_by_driver_day")


@query
def fanout_city_hour(spark, sf_dir):
    return _fanout(spark, sf_dir, "trips_by_city_hour")


@query
def driver_day_view(spark, sf_dir):
    return fanout.driver_day(spark, runs.ingest_run(spark, sf_dir).job.root).drop("ingested_at_ms")


@query
def trip_lookup(spark, sf_dir):
    """The newest trip of each driver, looked up by id."""
    root = runs.ingest_run(spark, sf_dir).job.root
    newest = fanout.read_serving(spark, root, "trips_by_driver_day").groupBy("driver_id").agg(
        F.max_by("trip_id", F.struct("event_time", "trip_id")).alias("trip_id")
    )
    return fanout.trip_lookup(spark, root, newest).select(
        "trip_id", "event_id", "event_time", "driver_id", "city_id", "fare_amount", "status"
    )


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_KEYS = ["l_orderkey", "l_linenumber"]


def _line_columns(df):
    return df.select(
        *LINE_KEYS, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus",
        "l_shipdate",
    )


@query
def upsert_latest(spark, sf_dir):
    """Order lines written in two batches by status; the latest row of each key is read back."""
    path = new_folder(spark, "upsert")
    line = _line_columns(table(spark, sf_dir, "lineitem"))
    upsert.write_delta(line.where("l_linestatus = 'F'"), path, 0)
    upsert.write_delta(line.where("l_linestatus <> 'F'"), path, 1)
    return upsert.read_latest(spark, path, LINE_KEYS, ["write_id", *LINE_ORDER]).drop("write_id")


@query
def rollup_partial_upsert(spark, sf_dir):
    """First status of each order line, updated in three columns from the other one."""
    line = _line_columns(table(spark, sf_dir, "lineitem"))
    old = upsert.latest_per_key(line.where("l_linestatus = 'F'"), LINE_KEYS, LINE_ORDER)
    new = upsert.latest_per_key(line.where("l_linestatus <> 'F'"), LINE_KEYS, LINE_ORDER)
    updated = {"l_shipdate": None, "l_extendedprice": None, "l_linestatus": None}
    return upsert.partial_upsert(old, new, LINE_KEYS, updated)


# -- quarantine --------------------------------------------------------------------

@query
def quarantine_union(spark, sf_dir):
    return runs.quarantined(spark, sf_dir).drop("host")


@query
def dlq_inspect(spark, sf_dir):
    return quarantine.inspect(runs.quarantined(spark, sf_dir))


@query
def dlq_by_reason(spark, sf_dir):
    return quarantine.by_reason(runs.quarantined(spark, sf_dir))


@query
def dlq_route(spark, sf_dir):
    return quarantine.route(runs.quarantined(spark, sf_dir)).select(
        "failure_stage", "event_id", "source_partition", "source_offset", "replay_count", "action", "park_reason"
    )


@query
def dlq_pending(spark, sf_dir):
    """What is left once the records of the first half of the log have been drained."""
    records = runs.quarantined(spark, sf_dir)
    cut = F.unix_millis(F.lit(FIRST_LOAD_ENDS).cast("timestamp"))
    drained = quarantine.settle(quarantine.route(records.where(F.col("first_failed_at_ms") < cut)))
    return quarantine.pending(records, quarantine.ledger_rows(drained)).select(
        "failure_stage", "event_id", "source_partition", "source_offset", "first_failed_at_ms"
    )


@query
def dlq_reinject(spark, sf_dir):
    return quarantine.reinject(quarantine.route(runs.quarantined(spark, sf_dir)), adapters.TOPIC)


@query
def dlq_direct_write(spark, sf_dir):
    events = quarantine.writable(quarantine.direct_events(quarantine.route(runs.quarantined(spark, sf_dir))))
    rows = fanout.fanout(events, F.unix_millis(LOG_TIME), ["trips_by_driver_day"])["trips_by_driver_day"]
    return rows.select("driver_id", "event_date", "event_time", "trip_id", "event_id", "city_id", "fare_amount", "status")


@query
def dlq_drain_totals(spark, sf_dir):
    return quarantine.drain_totals(quarantine.settle(quarantine.route(runs.quarantined(spark, sf_dir))))


DLQ_TOPIC = "trips.dlq"


@query
def dlq_log_inspect(spark, sf_dir):
    """The profile of a quarantine that lies in a JSON log, some of whose messages were cut off."""
    path = new_folder(spark, "dlq-log")
    cut = F.col("first_failed_at_ms") % 7 == 0
    records = runs.quarantined(spark, sf_dir)
    messages = quarantine.as_messages(records.where(~cut), DLQ_TOPIC).unionByName(
        quarantine.as_messages(records.where(cut), DLQ_TOPIC).withColumn("value", F.expr("left(value, length(value) div 2)"))
    )
    nothing = spark.createDataFrame([], raw_log.RAW_SCHEMA)
    raw_log.publish_files(drains.next_messages(messages, nothing, adapters.LOG_PARTITIONS), path)
    read = quarantine.read_envelope_messages(raw_log.read_raw(spark, path))
    unreadable = F.count_if(F.col("failure_stage") == quarantine.UNREADABLE_STAGE).alias("unreadable")
    return quarantine.inspect(read, unreadable)


@query
def dlq_sample(spark, sf_dir):
    """The three records that failed first."""
    return quarantine.sample(runs.quarantined(spark, sf_dir)).select("failure_stage", "event_id", "first_failed_at_ms", "source_offset")


@query
def dlq_breaker(spark, sf_dir):
    """The alert of a quarantine with more records than its ceiling."""
    return quarantine.breaker_alert(runs.quarantined(spark, sf_dir), 10)


@query
def dlq_bounded_drains(spark, sf_dir):
    """Drains of at most half the records each, until nothing is pending: together one drain of all."""
    root = new_folder(spark, "bounded")
    records = runs.quarantined(spark, sf_dir)
    budget = max(1, -(-records.count() // 2))
    totals = None
    for n in range(64):  # shares are filled unevenly, so it takes some more than two
        done = drains.drain(
            spark, records, root, n, adapters.TOPIC, f"{root}/log", f"{root}/serving", adapters.LOG_PARTITIONS, budget=budget
        )
        totals = done if totals is None else totals.unionByName(done)
        if not done.first()["records_read"]:
            break
    held = drains.read_ledger(spark, f"{root}/ledger").count()
    return totals.agg(
        *[F.sum(c).alias(c) for c in ("records_read", "reinjected", "direct_written", "parked")],
        (F.max("records_read") <= budget + 64).alias("within_budget"), F.lit(held).cast("bigint").alias("in_ledger"),
    )


def _damaged(records):
    """Records of which some can no longer be replayed: cut payloads, late ones without a fare."""
    payload, odd = F.col("original_payload"), F.col("first_failed_at_ms")
    return records.withColumn(
        "original_payload",
        F.when((F.col("failure_stage") == parse.STAGE_PRODUCER) & (odd % 3 == 0), F.left(payload, F.lit(20)))
        .when((F.col("failure_stage") == parse.STAGE_LATE) & (odd % 2 == 0), F.replace(payload, F.lit('"fare_amount"'), F.lit('"lost"')))
        .otherwise(payload),
    )


@query
def drain_end_to_end(spark, sf_dir):
    """Three drains of damaged records: of the first half, of all, and once more. After the
    first a stream batch with the same number brings newer fares for the trips it wrote.
    Beside each drain's totals stands what the log, tables, parking and ledger then hold."""
    root = new_folder(spark, "drained")
    log, serving = f"{root}/log", f"{root}/serving"
    runs.raw_log(spark, sf_dir).select(*raw_log.RAW_COLUMNS).write.parquet(log)
    records = _damaged(runs.quarantined(spark, sf_dir))
    cut = F.unix_millis(F.lit(FIRST_LOAD_ENDS).cast("timestamp"))
    out = None
    for n, todo in enumerate([records.where(F.col("first_failed_at_ms") < cut), records, records]):
        before = raw_log.read_raw(spark, log).count()
        totals = drains.drain(spark, todo, root, n, adapters.TOPIC, log, serving, adapters.LOG_PARTITIONS)
        served = fanout.read_serving(spark, serving, "trips_by_id")
        held = {
            "drain_id": n,
            "in_log": raw_log.read_raw(spark, log).count() - before,
            "in_ledger": drains.read_ledger(spark, f"{root}/ledger").where(F.col("drain_id") == n).count(),
            "in_parking": spark.read.text(f"{root}/parked/drain_id={n}").count(),
            "trips_served": served.count(),
            "newer_fares": served.where("fare_amount >= 1000000").count(),
        }
        part = totals.select(*[F.lit(v).cast("bigint").alias(k) for k, v in held.items()], *totals.columns)
        out = part if out is None else out.unionByName(part)
        if n == 0:
            events = quarantine.writable(quarantine.direct_events(quarantine.route(todo)))
            newer = events.withColumn("fare_amount", F.lit(1e6))
            fanout.write_serving(fanout.fanout(newer, quarantine.now_ms(), latest=False), serving, n)
    return out


# -- reliability -------------------------------------------------------------------

@query
def retry_outcomes(spark, sf_dir):
    return retry.retry_outcomes(runs.attempts(spark, sf_dir))


@query
def retry_accounting(spark, sf_dir):
    rows = retry.retry_accounting(runs.attempts(spark, sf_dir), ["table"])
    return rows.withColumn("failure_reasons", retry.reasons_text(F.col("failure_reasons")))


@query
def backoff_delays(spark, sf_dir):
    return retry.with_backoff(runs.attempts(spark, sf_dir)).where(~F.col("ok")).select(
        "event_id", "table", "attempt", "error", "backoff_ms"
    )


def _followed(spark, sf_dir):
    written = parse.dedup(runs.sound_events(spark, sf_dir))
    return reconcile.follow(runs.classified(spark, sf_dir), written, runs.quarantined(spark, sf_dir))


@query
def reconcile_identity(spark, sf_dir):
    return reconcile.reconcile_identity(_followed(spark, sf_dir))


@query
def reconcile_totals(spark, sf_dir):
    return reconcile.reconcile_totals(_followed(spark, sf_dir))


# -- rollup ------------------------------------------------------------------------

def _loaded_at() -> Column:
    """An hour's rows count as loaded some minutes after it closed."""
    return F.timestamp_micros(
        F.unix_micros("event_hour") + ((F.col("distance_km") + 60) * 60_000_000).cast("bigint")
    )


def _earlier_stage(city_hour):
    """Stage table after a first load of the first half: other values in every column."""
    first = city_hour.where(F.col("event_hour") < F.lit(FIRST_LOAD_ENDS).cast("timestamp"))
    rows = rollup.stage_rows(first.withColumn("_loaded", _loaded_at()), F.lit(None).cast("timestamp"))
    moved = F.when(F.col("payment_type") == "cash", F.col("event_time") + F.expr("INTERVAL 1 HOUR")).otherwise(
        F.col("event_time")
    )
    return rows.withColumns(
        {
            "event_time": moved,
            "fare_amount": F.lit(0.0),
            "status": F.lit("pending"),
            "vehicle_class": F.lit("unknown"),
            "loaded_at": F.lit(FIRST_LOAD_ENDS).cast("timestamp"),
        }
    )


def _stage_source(city_hour):
    rows = upsert.latest_per_key(rollup.with_defaults(city_hour), ["trip_id"], ["event_time", "event_id"])
    return rows.withColumn("loaded_at", _loaded_at()).select(*rollup.STAGE_COLUMNS, "loaded_at")


@query
def hourly_rollup_load(spark, sf_dir):
    city_hour = _fanout(spark, sf_dir, "trips_by_city_hour")
    return rollup.load_window(_earlier_stage(city_hour), _stage_source(city_hour)).select(
        "trip_id", "event_time", "city_id", "vehicle_class", "fare_amount", "surge_multiplier", "status", "loaded_at"
    )


@query
def rollup_stage_reads(spark, sf_dir):
    """The same two loads stored as deltas and resolved on reading."""
    city_hour, path = _fanout(spark, sf_dir, "trips_by_city_hour"), new_folder(spark, "stage")
    rollup.write_load(_earlier_stage(city_hour), path, 0)
    rollup.write_load(_stage_source(city_hour), path, 1)
    return rollup.read_stage(spark, path).select(
        "trip_id", "event_time", "city_id", "vehicle_class", "fare_amount", "surge_multiplier", "status", "loaded_at"
    )


@query
def rollup_drift(spark, sf_dir):
    city_hour = _fanout(spark, sf_dir, "trips_by_city_hour")
    return rollup.drift(city_hour, _earlier_stage(city_hour))


@query
def hour_completeness(spark, sf_dir):
    """Every city and hour of the stored table's days, read from it."""
    root, days = runs.ingest_run(spark, sf_dir).job.root, runs.stored_days(spark, sf_dir)
    return rollup.completeness(fanout.city_hours(spark, root, *days), *[F.lit(str(d)).cast("timestamp") for d in days])


@query
def backfill_window(spark, sf_dir):
    """The audit of the loads of all windows that hold rows, as it reads afterwards."""
    return runs.rollup_run(spark, sf_dir).audit().where("rows_loaded > 0").select(
        "audit_id", "window_start", "window_end", "rows_loaded", "notes"
    )


@query
def rollup_flow(spark, sf_dir):
    """What the loads leave behind after a death between load and verification and a lossy
    write: the stage by hour, every marker of the audit, and the alerts."""
    flow = runs.rollup_run(spark, sf_dir)
    none = F.lit(None)
    stage = flow.stage().groupBy(F.date_trunc("hour", "event_time").alias("at")).agg(
        F.count("*").alias("rows"), F.round(F.sum("fare_amount"), 2).alias("fares")
    ).select(F.lit("stage").alias("part"), none.cast("string").alias("audit_id"), none.cast("string").alias("name"), "at", "rows", "fares")
    audit = flow.markers().select(
        F.lit("audit").alias("part"), "audit_id", F.concat(F.col("attempt").cast("string"), F.lit("-"), "name").alias("name"),
        F.col("window_start").alias("at"), "rows", none.cast("double").alias("fares"),
    )
    alerts = flow.alerts().select(
        F.lit("alert").alias("part"), "audit_id", F.col("kind").alias("name"), F.col("window_start").alias("at"), "rows",
        none.cast("double").alias("fares"),
    )
    return stage.unionByName(audit).unionByName(alerts)


@query
def closed_hour_gate(spark, sf_dir):
    """Whether each of the log's windows, and the one after its end, holds enough rows to load:
    one read of their hours from the stored table."""
    windows = runs.backfill_windows(spark, sf_dir)
    hours = fanout.city_hours(spark, runs.ingest_run(spark, sf_dir).job.root, windows[0][0], windows[-1][1])
    return rollup.landed_windows(hours, windows, min_rows=100)


@query
def city_hour_lookup(spark, sf_dir):
    """The trips of the city and hour that have most, read by key from the stored table."""
    root = runs.ingest_run(spark, sf_dir).job.root
    busiest = fanout.read_serving(spark, root, "trips_by_city_hour").groupBy("city_id", "event_hour").agg(F.count("*").alias("n"))
    key = busiest.orderBy(F.desc("n"), "city_id", "event_hour").select("city_id", F.col("event_hour").cast("string").alias("hour")).first()
    if key is None:
        return fanout.read_serving(spark, root, "trips_by_city_hour").drop("ingested_at_ms")
    return fanout.city_hour(spark, root, key["city_id"], key["hour"]).drop("ingested_at_ms")


@query
def driver_day_lookup(spark, sf_dir):
    """The trips of the driver and day that have most, read by key from the stored table."""
    root = runs.ingest_run(spark, sf_dir).job.root
    busiest = fanout.read_serving(spark, root, "trips_by_driver_day").groupBy("driver_id", "event_date").agg(F.count("*").alias("n"))
    key = busiest.orderBy(F.desc("n"), "driver_id", "event_date").select("driver_id", F.col("event_date").cast("string").alias("day")).first()
    return fanout.driver_day(spark, root, *(key or ())).drop("ingested_at_ms")


@query
def backfill_alerts(spark, sf_dir):
    """Alerts of loads that found nothing: the day after the log's end is empty."""
    return runs.rollup_run(spark, sf_dir).alerts().where("kind = 'backfill_empty'").select(
        "kind", "window_start", "window_end", "hours"
    )


@query
def freshness_violations(spark, sf_dir):
    return rollup.freshness_violations(_stage_source(_fanout(spark, sf_dir, "trips_by_city_hour")))


@query
def city_window_rollup(spark, sf_dir):
    rows = rollup.city_rollup(parse.dedup(runs.sound_events(spark, sf_dir)), "6 hours")
    return _rounded(rows, revenue=2, avg_duration_sec=6)


def _near(estimate: str, exact: str) -> Column:
    """Whether a sketch's estimate is within the bound it is used with."""
    return (F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(F.lit(1.0), F.col(exact) * rollup.SKETCH_BOUND)).alias("within_bound")


@query
def rollup_distinct(spark, sf_dir):
    """Distinct drivers from the sketches of six-hour windows, merged over days and cities, beside exact counts."""
    events, path = parse.dedup(runs.sound_events(spark, sf_dir)), new_folder(spark, "sketches")
    rollup.city_rollup(events, "6 hours", exact=False).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("day", F.to_date("window_start"))
    done = events.where("status = 'completed'").withColumn("day", F.to_date("event_time"))
    out = None
    for by in (["city_id", "day"], ["day"], ["city_id"]):
        merged = rollup.merge_windows(stored, by).select(*by, "trips", "active_drivers")
        exact = done.groupBy(*by).agg(F.count_distinct("driver_id").alias("drivers"))
        part = ranges.join_same(merged, exact, by).select(
            *[F.col(c).cast("string").alias(c) if c in by else F.lit(None).cast("string").alias(c) for c in ("city_id", "day")],
            "trips", "drivers", _near("active_drivers", "drivers"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def _rounded(df, **digits):
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})


# -- telemetry ---------------------------------------------------------------------

def _latency_samples(spark, sf_dir):
    s = adapters.samples(spark, sf_dir)
    produced = F.unix_millis("ts")
    rows = s.withColumn("produced_at_ms", produced).withColumn(
        "written_at_ms", produced + F.round(F.col("value") * 100).cast("bigint") - 50
    )
    return latency.latency_samples(rows, F.col("run_id"), adapters.slice_of(F.col("ts")), 1.0)


@query
def latency_samples(spark, sf_dir):
    return _latency_samples(spark, sf_dir)


@query
def latency_retained(spark, sf_dir):
    """Samples that are still kept when the last one is written."""
    rows = _latency_samples(spark, sf_dir)
    last = rows.agg(F.max("produced_at_ms").alias("now")).first()["now"] or 0
    return latency.unexpired(rows, F.lit(last)).select("run_id", "event_id", "minute_bucket", "latency_ms")


@query
def latency_panel(spark, sf_dir):
    """Quantiles of the latency histogram by run."""
    filled = telemetry.histogram(_latency_samples(spark, sf_dir), ["run_id"], "latency_ms", telemetry.LATENCY_BOUNDS)
    quantile = lambda q: telemetry.histogram_quantile(q, F.col("cumulative"), telemetry.LATENCY_BOUNDS)
    return filled.select("run_id", *[F.round(quantile(q), 6).alias(n) for n, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))])


@query
def latency_percentiles(spark, sf_dir):
    return latency.latency_report(_latency_samples(spark, sf_dir), ["run_id"])


@query
def batch_duration_percentiles(spark, sf_dir):
    return telemetry.batch_duration_percentiles(adapters.samples(spark, sf_dir), ["run_id"], "value")


@query
def run_summary(spark, sf_dir):
    run_id = F.concat(F.lit("partition-"), F.col("_partition").cast("string"))
    made = reports.batch_reports(
        runs.classified(spark, sf_dir),
        runs.attempts(spark, sf_dir),
        run_id,
        (F.col("distance_km") * 10).cast("bigint"),
    )
    rows = telemetry.run_summary(made, ["run_id"])
    return rows.withColumn("failure_reasons", retry.reasons_text(F.col("failure_reasons")))


@query
def run_stats(spark, sf_dir):
    rows = adapters.samples(spark, sf_dir).withColumn("recovered", F.col("k") > 0)
    return telemetry.run_stats(rows, ["run_id"], "value", "recovered")


@named("longest_rising_run")
def longest_run_of_rising_lag(spark, sf_dir):
    return longest_rising_run(adapters.samples(spark, sf_dir), ["run_id"], "ts", "value", "event_id")


@query
def first_recovery(spark, sf_dir):
    batches = adapters.samples(spark, sf_dir).withColumn("batch_id", F.col("event_id"))
    faults = batches.where("event_type = 'error'").groupBy("run_id").agg(F.min("ts").alias("fault_at"))
    good = (F.col("value") > 0) & (F.col("k") > 10)
    return telemetry.first_after(batches, faults, ["run_id"], "ts", good)


def _steps(spark, sf_dir):
    """Load steps: one per campaign and rate, measured from its samples."""
    s = adapters.samples(spark, sf_dir).withColumn("rate", (F.floor(F.col("k") / 10) * 100 + 100).cast("bigint"))
    rows = F.count(F.lit(1))
    return s.groupBy(F.col("run_id").alias("campaign"), "rate").agg(
        F.lit(90.0).alias("duration_seconds"),
        (F.sum("k") % 40 * F.col("rate") / 400.0).alias("drain_seconds"),
        (F.lit(94.5) + rows % 50).alias("attainment_pct"),
        F.floor((rows % 12) * F.col("rate") / 1000).cast("bigint").alias("growth_run"),
        (F.sum("k") % 19 != 0).alias("drained"),
        F.when(F.max("event_id") % 23 == 0, 1).otherwise(0).cast("bigint").alias("unaccounted"),
    )


@query
def step_verdict(spark, sf_dir):
    rows = telemetry.step_verdict(_steps(spark, sf_dir))
    return rows.withColumn("failed_because", F.array_join("failed_because", ","))


@query
def sustained_prefix(spark, sf_dir):
    return telemetry.sustained_prefix(telemetry.step_verdict(_steps(spark, sf_dir)), ["campaign"], "rate", "sustained")


@query
def lag_slope(spark, sf_dir):
    rows = trailing_slope(adapters.samples(spark, sf_dir), ["run_id"], "ts", "value", SLOPE_SECONDS)
    return rows.select("run_id", "event_id", "ts", "points", F.round("slope", 6).alias("slope"))


def _rates(spark, sf_dir):
    return counter_rate(
        adapters.samples(spark, sf_dir), ["run_id", "event_type"], "ts", "k", "event_id", RATE_SECONDS
    )


@named("counter_rate")
def counter_rates(spark, sf_dir):
    return _rates(spark, sf_dir).select(
        "run_id", "event_type", "event_id", "ts", "samples", "increase", F.round("rate", 9).alias("rate")
    )


@query
def counter_rate_by_stage(spark, sf_dir):
    rows = telemetry.sum_by(_rates(spark, sf_dir), ["run_id", "event_type"], "event_type", "ts", "rate", STEP_SECONDS)
    return rows.withColumn("rate", F.round("rate", 9))


@query
def histogram_quantile(spark, sf_dir):
    filled = telemetry.histogram(
        adapters.samples(spark, sf_dir).withColumn("day", F.to_date("ts")), ["run_id", "day"], "value",
        telemetry.DURATION_BOUNDS,
    )
    return filled.select(
        "run_id",
        "day",
        *[
            F.round(telemetry.histogram_quantile(q, F.col("cumulative"), telemetry.DURATION_BOUNDS), 6).alias(name)
            for name, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))
        ],
    )


@query
def duration_p95_sliding(spark, sf_dir):
    """Median and p95 of the durations of the last six hours, at each sample."""
    counters = adapters.duration_counters(spark, sf_dir, telemetry.DURATION_BOUNDS)
    rows = telemetry.sliding_quantiles(
        counters, ["run_id"], "cumulative", telemetry.DURATION_BOUNDS, RATE_SECONDS, {"p50": 0.5, "p95": 0.95}
    )
    return rows.select("run_id", "event_id", "ts", F.element_at("increase", -1).alias("samples"), F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))


# The counter rules on event types in place of counters, with thresholds of their size.
COUNTER_RULES = {
    "dlq_rate_high": ("signup", "rate", 0.01, STEP_SECONDS),
    "writes_exhausted": ("error", "increase", 0, telemetry.EXHAUSTED_HOLD),
    "retry_rate_high": ("click", "rate", 0.02, STEP_SECONDS),
    "deliveries_failing": ("purchase", "increase", 0, telemetry.EXHAUSTED_HOLD),
}


@query
def alert_intervals(spark, sf_dir):
    s = adapters.samples(spark, sf_dir)
    by = ["run_id"]
    per_hour = F.timestamp_seconds(F.floor(F.unix_seconds("ts") / STEP_SECONDS) * STEP_SECONDS)
    grouped = s.withColumn("ts", per_hour)
    actual = grouped.where("event_type in ('view', 'click', 'purchase')").groupBy("run_id", "ts").agg(
        F.avg("k").alias("actual_rate")
    )
    target = grouped.where("event_type in ('signup', 'error')").groupBy("run_id", "ts").agg(
        F.max("k").alias("target_rate")
    )
    fired = {
        "lag_rising": telemetry.lag_rising(s, by, SLOPE_SECONDS, telemetry.LAG_RISING_HOLD),
        "lag_high": telemetry.lag_high(s, by, LAG_THRESHOLD, STEP_SECONDS),
        "batch_duration_high": telemetry.rate_above(
            telemetry.duration_p95(s, by, "value", STEP_SECONDS), by, "p95", telemetry.BATCH_P95_SECONDS, STEP_SECONDS
        ),
        "producer_below_target": telemetry.producer_below_target(actual, target, by, STEP_SECONDS),
        "counter_increasing": telemetry.rate_above(
            counter_rate(s, by, "ts", "k", "event_id", RATE_SECONDS), by, "increase", 300, STEP_SECONDS
        ),
    }
    return telemetry.alerts(fired | telemetry.counter_rules(s, by, "event_type", "k", RATE_SECONDS, COUNTER_RULES), by)


@query
def lag_samples(spark, sf_dir):
    counts = runs.raw_log(spark, sf_dir).groupBy("topic", "partition", F.col("batch_no").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return telemetry.lag_samples(counts, ["topic"])


# -- streams -----------------------------------------------------------------------

@query
def stream_ingest(spark, sf_dir):
    run = runs.ingest_run(spark, sf_dir)
    return fanout.read_serving(spark, run.job.root, "trips_by_id").drop("ingested_at_ms")


@query
def stream_late_quarantine(spark, sf_dir):
    run = runs.ingest_run(spark, sf_dir)
    return quarantine.read_quarantine(spark, run.job.path("quarantine")).where(
        F.col("failure_stage") == parse.STAGE_LATE
    ).select("batch_id", "event_id", "source_partition", "source_offset", "failure_reason", "original_payload")


@query
def stream_batch_report(spark, sf_dir):
    return runs.ingest_run(spark, sf_dir).job.reports().select(
        "batch_id", "input_rows", "unparseable", "invalid", "late", "dlq", "rows_written", "max_event_time"
    )


@query
def stream_restart(spark, sf_dir):
    """Tables after a run with a restart before every slice and one batch run twice."""
    run = runs.ingest_run(spark, sf_dir)
    out = None
    for name in runs.SERVING_TABLES:
        rows = fanout.read_serving(spark, run.job.root, name)
        part = rows.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("events")
        )
        out = part if out is None else out.unionByName(part)
    records = quarantine.read_quarantine(spark, run.job.path("quarantine"))
    return out.unionByName(
        records.agg(
            F.lit("quarantine").alias("table_name"), F.count(F.lit(1)).alias("rows"),
            F.count_distinct("event_id").alias("events"),
        )
    )


@query
def stream_delivery(spark, sf_dir):
    """Batch reports of a stream that delivers to a failing store, from what it observed."""
    rows = runs.delivery_run(spark, sf_dir).job.reports().select(
        "batch_id", "input_rows", "dlq", "rows_written", "failures_exhausted", "retries_before_success", "retried_writes", "failure_reasons"
    )
    return rows.withColumn("failure_reasons", retry.reasons_text(F.col("failure_reasons")))


@query
def stream_delivery_dlq(spark, sf_dir):
    """What that stream could not deliver, as its quarantine holds it."""
    job = runs.delivery_run(spark, sf_dir).job
    return quarantine.read_quarantine(spark, job.path("quarantine")).where(F.col("failure_stage") == parse.STAGE_SINK).select(
        "batch_id", "event_id", "retry_count", "failure_reason", "source_partition", "source_offset"
    )


@query
def stream_delivery_ledger(spark, sf_dir):
    """The ledger of that stream by batch: every event has one outcome, though a batch ran twice."""
    path = runs.delivery_run(spark, sf_dir).job.path("deliveries")
    rows = spark.read.schema(retry.LEDGER_SCHEMA + ", batch_id bigint, try int").option("basePath", path).parquet(path)
    first = F.when(F.col("attempts") == 2, F.col("backoff_ms"))
    return rows.groupBy("batch_id").agg(
        F.count("*").alias("outcomes"), F.count_distinct("event_id").alias("events"), F.count_if("succeeded").alias("succeeded"),
        F.sum("attempts").alias("attempts"), F.max("try").alias("last_try"),
        # Waits before the second attempt: 2 ms with a tenth of jitter.
        (F.coalesce(F.min(first), F.lit(2.0)) >= 1.8).alias("waits_not_below"),
        (F.coalesce(F.max(first), F.lit(2.0)) <= 2.2).alias("waits_not_above"),
        F.coalesce(F.bool_or(first != 2.0), F.lit(True)).alias("jittered"),
    )


@query
def stream_lag(spark, sf_dir):
    """Slices that had landed and were not taken after each batch, as sampled while the stream ran."""
    run = runs.delivery_run(spark, sf_dir)
    slices = lambda name: (F.col(name) / run.slice_files).cast("bigint").alias(name.replace("files", "slices"))
    return run.job.lag().select("batch_id", *map(slices, ("files_landed", "files_taken", "files_behind")))


@query
def stream_dedup(spark, sf_dir):
    run, root = runs.ingest_run(spark, sf_dir), new_folder(spark, "dedup")
    stream_rollup.start_dedup(raw_log.read_raw_stream(spark, run.log), root, "10 days").awaitTermination()
    return spark.read.parquet(f"{root}/events")


@query
def stream_city_rollup(spark, sf_dir):
    run, root = runs.ingest_run(spark, sf_dir), new_folder(spark, "rollup")
    started = stream_rollup.start_city_rollup(
        raw_log.read_raw_stream(spark, run.log), root, "6 hours", "10 days", {"availableNow": True}
    )
    started.awaitTermination()
    rows = stream_rollup.read_city_rollup(spark, root)
    # The same windows of the log with exact counts: what the stream's sketches are held against.
    events = stream_rollup.timed_events(raw_log.read_raw(spark, run.log), "10 days")
    exact = rollup.city_rollup(events, "6 hours").select("city_id", "window_start", F.col("active_drivers").alias("drivers"))
    rows = ranges.join_same(rows, exact, ["city_id", "window_start"]).select(
        "city_id", "window_start", "window_end", "trips", "revenue", "avg_duration_sec", "drivers", _near("active_drivers", "drivers")
    )
    return _rounded(rows, revenue=2, avg_duration_sec=6)
