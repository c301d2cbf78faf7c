"""Fixed schemas: the event on the wire, the quarantine envelope, batch reports."""

from __future__ import annotations

# Field names and types of the event, as every producer writes it.
EVENT_SCHEMA = """
    event_id string, trip_id string, event_time string, produced_at_ms bigint,
    city_id string, driver_id string, rider_id string,
    pickup_zone_id int, dropoff_zone_id int,
    vehicle_class string, payment_type string,
    distance_km double, duration_sec int, fare_amount double, surge_multiplier double,
    status string, producer_id string, schema_version int
"""

# Quarantine envelope.
ENVELOPE_SCHEMA = """
    original_payload string, failure_reason string, failure_stage string, retry_count int,
    first_failed_at_ms bigint, quarantined_at_ms bigint, event_id string,
    source_topic string, source_partition int, source_offset bigint,
    replay_count int, host string, dlq_schema_version int
"""

# Raw log rows: the record value and its coordinates. replay_count travels beside
# the payload, so that a re-injected record keeps it while the payload stays verbatim.
RAW_SCHEMA = """
    key string, value string, topic string, partition int, offset bigint,
    timestamp timestamp, replay_count int
"""

# Serving tables, key columns first.
TRIPS_BY_ID = [
    "trip_id", "event_id", "event_time", "produced_at_ms", "ingested_at_ms", "city_id",
    "driver_id", "rider_id", "pickup_zone_id", "dropoff_zone_id", "vehicle_class",
    "payment_type", "distance_km", "duration_sec", "fare_amount", "surge_multiplier",
    "status", "producer_id", "schema_version",
]
TRIPS_BY_DRIVER_DAY = [
    "driver_id", "event_date", "event_time", "trip_id", "event_id", "city_id", "rider_id",
    "vehicle_class", "payment_type", "distance_km", "duration_sec", "fare_amount",
    "surge_multiplier", "status", "ingested_at_ms",
]
TRIPS_BY_CITY_HOUR = [
    "city_id", "event_hour", "trip_id", "event_id", "event_time", "driver_id", "rider_id",
    "pickup_zone_id", "dropoff_zone_id", "vehicle_class", "payment_type", "distance_km",
    "duration_sec", "fare_amount", "surge_multiplier", "status", "ingested_at_ms",
]
SERVING_TABLES = {
    "trips_by_id": (TRIPS_BY_ID, ["trip_id"]),
    "trips_by_driver_day": (TRIPS_BY_DRIVER_DAY, ["driver_id", "event_date", "event_time", "trip_id"]),
    "trips_by_city_hour": (TRIPS_BY_CITY_HOUR, ["city_id", "event_hour", "trip_id"]),
}

BATCH_REPORT_SCHEMA = """
    run_id string, batch_id bigint, wall_ts timestamp, input_rows bigint, unparseable bigint,
    invalid bigint, late bigint, dlq bigint, rows_written bigint, batch_seconds double,
    successes bigint, retries_before_success bigint, retried_writes bigint,
    retried_writes_retries bigint, failures_exhausted bigint,
    latency_sum_ms bigint, latency_count bigint, latency_max_ms bigint,
    max_event_time timestamp, failure_reasons map<string, bigint>
"""
