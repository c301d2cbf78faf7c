"""SQL equivalents of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# -- shared views ------------------------------------------------------------------

TRIPS = """
trips AS (
  SELECT l_orderkey || '-' || l_linenumber AS trip_id,
         l_shipdate AS event_time,
         CAST(c_nationkey AS VARCHAR) AS city_id, n_name AS city_name, r_name AS region,
         l_suppkey AS driver_no, 'd-' || lpad(CAST(l_suppkey AS VARCHAR), CAST(greatest(length(CAST(l_suppkey AS VARCHAR)), 6) AS INTEGER), '0') AS driver_id,
         l_linenumber AS pickup_zone_id,
         o_orderpriority AS vehicle_class, l_returnflag AS payment_type,
         l_quantity AS distance_km, CAST(trunc(l_quantity * 60) AS INTEGER) AS duration_sec,
         CAST(l_extendedprice AS DECIMAL(12, 2)) AS fare_amount,
         1 + 10 * l_discount AS surge_multiplier,
         CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'cancelled' END AS status
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

FIELDS = """
fields AS (
  SELECT event_id AS id, user_id, ts, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         event_type AS city_id,
         '00000000-0000-4000-8000-' || lpad(lower(to_hex(event_id)), CAST(greatest(length(lower(to_hex(event_id))), 12) AS INTEGER), '0') AS event_id,
         lpad(lower(to_hex(user_id)), CAST(greatest(length(lower(to_hex(user_id))), 8) AS INTEGER), '0') || '-0000-4000-8000-' || lpad(lower(to_hex(event_id)), CAST(greatest(length(lower(to_hex(event_id))), 12) AS INTEGER), '0') AS trip_id,
         'd-' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(length(CAST(user_id AS VARCHAR)), 6) AS INTEGER), '0') AS driver_id,
         'r-' || lpad(CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR), CAST(greatest(length(CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR)), 6) AS INTEGER), '0') AS rider_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 40 AS pickup_zone_id,
         CAST(user_id % 40 AS INTEGER) AS dropoff_zone_id,
         ['economy', 'comfort', 'xl', 'black'][CAST(user_id % 4 + 1 AS INTEGER)] AS vehicle_class,
         ['card', 'wallet', 'cash'][CAST(user_id % 3 + 1 AS INTEGER)] AS payment_type,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS distance_km,
         CAST(json_extract_string(props, '$.k') AS INTEGER) * 60 + 30 AS duration_sec,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 = 0 THEN 1.5 ELSE 1.0 END::DOUBLE AS surge_multiplier,
         CASE WHEN event_type = 'error' THEN 'cancelled' ELSE 'completed' END AS status,
         CASE WHEN event_id % 97 = 0 THEN 'truncated' WHEN event_id % 89 = 1 THEN 'null_fare'
              WHEN event_id % 83 = 2 THEN 'bad_time' WHEN event_id % 71 = 3 THEN 'late'
              WHEN event_id % 53 = 4 THEN 'duplicate' WHEN event_id % 61 = 5 THEN 'write_failure'
              WHEN event_id % 67 = 6 THEN 'producer_failure' ELSE 'none' END AS defect
  FROM events),
sent AS (
  SELECT *, date_trunc('milliseconds', CASE WHEN defect = 'late' THEN ts - INTERVAL 7 DAY ELSE ts END) AS sent_time
  FROM fields),
texts AS (
  SELECT *, '{"event_id":"' || event_id || '","trip_id":"' || trip_id || '","event_time":"'
    || CASE WHEN defect = 'bad_time' THEN 'not-a-time' ELSE strftime(sent_time, '%Y-%m-%dT%H:%M:%S.%gZ') END
    || '","produced_at_ms":' || (epoch_us(ts) // 1000) || ',"city_id":"' || city_id || '","driver_id":"' || driver_id
    || '","rider_id":"' || rider_id || '","pickup_zone_id":' || pickup_zone_id || ',"dropoff_zone_id":' || dropoff_zone_id
    || ',"vehicle_class":"' || vehicle_class || '","payment_type":"' || payment_type || '","distance_km":'
    || CAST(distance_km AS VARCHAR) || ',"duration_sec":' || duration_sec
    || CASE WHEN defect = 'null_fare' THEN '' ELSE ',"fare_amount":' || CAST(value AS VARCHAR) END
    || ',"surge_multiplier":' || CAST(surge_multiplier AS VARCHAR) || ',"status":"' || status
    || '","producer_id":"producer-1","schema_version":1}' AS whole
  FROM sent),
messages AS (
  SELECT *, CASE WHEN defect = 'truncated' THEN left(whole, length(whole) // 2) ELSE whole END AS payload FROM texts)"""

LOG = FIELDS + """,
log AS (
  SELECT m.*, CAST(id % 6 AS INTEGER) AS "partition", (id // 6) * 2 + copy AS "offset",
         date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 5 AS batch_no,
         CAST(CASE WHEN defect = 'write_failure' THEN (id // 61) % 5 ELSE 0 END AS INTEGER) AS replay_count,
         defect = 'truncated' AS unparseable
  FROM messages m, LATERAL (SELECT unnest(CASE WHEN defect = 'duplicate' THEN [0, 1] ELSE [0] END) AS copy)
  WHERE defect <> 'producer_failure'),
parsed AS (
  SELECT *, CASE WHEN defect IN ('truncated', 'bad_time') THEN NULL ELSE sent_time END AS event_time,
         CASE WHEN defect IN ('truncated', 'null_fare') THEN NULL ELSE value END AS fare_amount FROM log)"""

ROUTED = LOG + """,
highs AS (SELECT batch_no, max(event_time) AS high FROM parsed WHERE NOT unparseable GROUP BY batch_no),
cutoffs AS (
  SELECT batch_no, max(high) OVER (ORDER BY batch_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
         - INTERVAL 2 MINUTE AS cutoff FROM highs),
classified AS (
  SELECT p.*, cutoff,
    CASE WHEN unparseable THEN 'unparseable' WHEN event_time < cutoff THEN 'late'
         WHEN event_time IS NULL OR fare_amount IS NULL THEN 'invalid' ELSE 'ok' END AS route
  FROM parsed p LEFT JOIN cutoffs USING (batch_no)),
routed AS (
  SELECT *, CASE WHEN route IN ('unparseable', 'invalid') THEN 'parse' WHEN route = 'late' THEN 'late_event' END AS failure_stage,
    CASE route WHEN 'unparseable' THEN 'JsonParseError: value did not match event schema'
         WHEN 'late' THEN 'LateEvent: event_time older than watermark ' || strftime(cutoff, '%Y-%m-%dT%H:%M:%S.%g') || '+00:00'
         WHEN 'invalid' THEN CASE WHEN event_time IS NULL THEN 'PermanentDefect: missing required field ''event_time'''
                                  ELSE 'PermanentDefect: fare_amount is null' END END AS failure_reason
  FROM classified),
sound AS (SELECT * FROM routed WHERE route = 'ok' QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY "offset") = 1)"""

ATTEMPTS = """
failing AS (
  SELECT event_id AS id, '00000000-0000-4000-8000-' || lpad(lower(to_hex(event_id)), CAST(greatest(length(lower(to_hex(event_id))), 12) AS INTEGER), '0') AS event_id,
         CASE WHEN event_id % 97 = 0 OR event_id % 89 = 1 OR event_id % 83 = 2 OR event_id % 71 = 3 THEN NULL
              WHEN event_id % 53 = 4 THEN 0 WHEN event_id % 61 = 5 THEN event_id % 6
              WHEN event_id % 67 = 6 THEN NULL ELSE 0 END AS failures
  FROM events),
writes AS (
  SELECT id, event_id, t AS "table", CASE WHEN t = 'trips_by_driver_day' THEN failures ELSE 0 END AS failures
  FROM failing, (SELECT unnest(['trips_by_id', 'trips_by_driver_day', 'trips_by_city_hour']) AS t)
  WHERE failures IS NOT NULL),
attempts AS (
  SELECT *, attempt > failures AS ok,
         CASE WHEN attempt <= failures THEN CASE WHEN attempt % 2 = 1 THEN 'WriteTimeout' ELSE 'Unavailable' END END AS error,
         CASE WHEN attempt <= failures AND attempt < 4 THEN [1000.0, 2000.0, 4000.0][attempt]::DOUBLE ELSE 0.0::DOUBLE END AS backoff_ms
  FROM (SELECT *, CAST(unnest(range(1, CAST(least(failures + 1, 4) AS BIGINT) + 1)) AS INTEGER) AS attempt FROM writes)),
outcomes AS (
  SELECT event_id, "table", CAST(count(*) AS INTEGER) AS attempts, bool_or(ok) AS succeeded,
         arg_max(error, attempt) FILTER (WHERE error IS NOT NULL AND NOT ok) AS any_error,
         CASE WHEN bool_or(ok) THEN NULL ELSE arg_max(error, attempt) END AS last_error,
         sum(backoff_ms) AS backoff_ms,
         CASE WHEN bool_or(ok) AND count(*) = 1 THEN 'first_try' WHEN bool_or(ok) THEN 'retried' ELSE 'exhausted' END AS outcome,
         CAST(CASE WHEN bool_or(ok) THEN count(*) - 1 ELSE 0 END AS INTEGER) AS retries
  FROM attempts GROUP BY event_id, "table")"""

QUARANTINE = ROUTED + "," + ATTEMPTS + """,
quarantine AS (
  SELECT payload AS original_payload, failure_reason, failure_stage, 0 AS retry_count, (epoch_us(ts) // 1000) AS first_failed_at_ms,
         CASE WHEN route <> 'unparseable' THEN event_id END AS event_id, trip_id, 'trips.raw' AS source_topic,
         "partition" AS source_partition, "offset" AS source_offset, replay_count, sent_time, driver_id, city_id, value, status
  FROM routed WHERE failure_stage IS NOT NULL
  UNION ALL
  SELECT payload, last_error || ': ' || "table", 'cassandra_sink', attempts, (epoch_us(ts) // 1000), s.event_id, trip_id, 'trips.raw',
         "partition", "offset", replay_count, sent_time, driver_id, city_id, value, status
  FROM sound s JOIN outcomes o ON s.event_id = o.event_id AND o.outcome = 'exhausted'
  UNION ALL
  SELECT payload, 'KafkaException: delivery failed', 'producer', 4, (epoch_us(ts) // 1000), event_id, trip_id, 'trips.raw',
         NULL, NULL, 0, sent_time, driver_id, city_id, value, status
  FROM messages WHERE defect = 'producer_failure'),
actions AS (
  SELECT *, CASE WHEN replay_count >= 3 THEN 'park' WHEN failure_stage IN ('cassandra_sink', 'producer') THEN 'reinject'
                 WHEN failure_stage = 'late_event' THEN 'direct_write' ELSE 'park' END AS action
  FROM quarantine)"""

SAMPLES = """
samples AS (
  SELECT 'run-' || (user_id % 5) AS run_id, event_id, ts, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type
  FROM events)"""

RIDES = FIELDS + """,
rides AS (SELECT *, ts AS event_time, CAST(value AS DECIMAL(12, 2)) AS fare FROM fields)"""


def _with(views: str, body: str) -> str:
    return f"WITH {views.strip()} {body.strip()}"


# -- the five questions ------------------------------------------------------------

REVENUE = "CAST(round(sum(fare_amount), 2) AS DOUBLE) AS revenue"

QUESTIONS = {
    "q1": _with(TRIPS, f"""SELECT region, CAST(CAST(event_time AS DATE) AS VARCHAR) AS day, count(*) AS trips, {REVENUE}
        FROM trips WHERE status = 'completed' GROUP BY 1, 2"""),
    "q2": _with(TRIPS, f"""SELECT driver_id, count(*) AS trips, {REVENUE}
        FROM trips WHERE status = 'completed'
        GROUP BY 1 ORDER BY revenue DESC, driver_id LIMIT 25"""),
    "q3": _with(TRIPS, f"""SELECT vehicle_class, dayofweek(event_time) IN (0, 6) AS is_weekend, count(*) AS trips, {REVENUE},
        round(CAST(sum(fare_amount) AS DOUBLE) / count(*), 2) AS avg_fare
        FROM trips WHERE status = 'completed' GROUP BY 1, 2"""),
    "q4": _with(RIDES, """SELECT city_id AS city_name, CAST(hour(event_time) AS INTEGER) AS hour_of_day, count(*) AS trips,
        round(avg(distance_km), 3) AS avg_distance, CAST(round(sum(fare), 2) AS DOUBLE) AS revenue
        FROM rides WHERE status = 'completed' GROUP BY 1, 2"""),
    "q5": _with(TRIPS, f"""SELECT city_name, CAST(isoyear(event_time) AS INTEGER) AS iso_year, CAST(week(event_time) AS INTEGER) AS iso_week,
        count(*) AS trips, count(*) FILTER (WHERE surge_multiplier > 1.0) AS surged_trips,
        round(100.0::DOUBLE * count(*) FILTER (WHERE surge_multiplier > 1.0) / nullif(count(*), 0), 2) AS surge_pct, {REVENUE}
        FROM trips WHERE status = 'completed' GROUP BY 1, 2, 3"""),
}
for _name, _sql in QUESTIONS.items():
    ORACLE[f"{_name}_wide"] = ORACLE[f"{_name}_star"] = _sql

ORACLE["q_equivalence"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS query, count(*) AS wide_rows, count(*) AS star_rows, CAST(0 AS BIGINT) AS only_wide,
        CAST(0 AS BIGINT) AS only_star, true AS equivalent FROM ({sql})"""
    for name, sql in QUESTIONS.items()
)

# -- star schema -------------------------------------------------------------------

DIMS = TRIPS + """,
cities AS (SELECT CAST(row_number() OVER (ORDER BY city_id) AS INTEGER) AS city_key, * FROM
  (SELECT DISTINCT city_id, city_name, region FROM trips)),
vehicles AS (SELECT CAST(row_number() OVER (ORDER BY vehicle_class) AS INTEGER) AS vehicle_key, vehicle_class FROM
  (SELECT DISTINCT vehicle_class FROM trips)),
payments AS (SELECT CAST(row_number() OVER (ORDER BY payment_type) AS INTEGER) AS payment_key, payment_type FROM
  (SELECT DISTINCT payment_type FROM trips))"""

ORACLE["dim_date"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(CAST(d AS DATE) AS VARCHAR) AS full_date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
       dayname(d) AS day_name, CAST(week(d) AS INTEGER) AS iso_week, CAST(isoyear(d) AS INTEGER) AS iso_year,
       dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT unnest(generate_series(first - INTERVAL 2 DAY, last + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS d FROM
  (SELECT date_trunc('day', min(l_shipdate)::TIMESTAMP) AS first, date_trunc('day', max(l_shipdate)::TIMESTAMP) AS last FROM lineitem))"""
ORACLE["dim_city"] = _with(DIMS, "SELECT *, city_name AS country FROM cities")
ORACLE["dim_vehicle"] = _with(DIMS, """SELECT vehicle_key, vehicle_class,
    CASE WHEN vehicle_class IN ('1-URGENT', '2-HIGH') THEN 'premium' ELSE 'standard' END AS tier FROM vehicles""")
ORACLE["dim_payment"] = _with(DIMS, "SELECT payment_key, payment_type, payment_type <> 'R' AS is_cashless FROM payments")
_DRIVERS = """,
drivers AS (SELECT driver_id, row_number() OVER (ORDER BY driver_id) AS driver_key FROM (SELECT DISTINCT driver_id FROM trips))"""
ORACLE["dim_driver"] = _with(TRIPS + _DRIVERS, """SELECT driver_key, driver_id,
    ['new', 'established', 'veteran'][CAST(driver_key % 3 + 1 AS INTEGER)] AS tenure_band FROM drivers""")
ORACLE["persistent_keys"] = """
WITH early AS (SELECT c_name AS name, row_number() OVER (ORDER BY c_name) AS key FROM (SELECT DISTINCT c_name FROM customer WHERE c_custkey % 3 = 0))
SELECT key, name, 0 AS load FROM early
UNION ALL SELECT (SELECT count(*) FROM early) + row_number() OVER (ORDER BY c_name), c_name, 1
FROM (SELECT DISTINCT c_name FROM customer WHERE c_name NOT IN (SELECT name FROM early))"""
ORACLE["star_fact"] = _with(DIMS + _DRIVERS, """
SELECT trip_id, CAST(strftime(event_time, '%Y%m%d') AS INTEGER) AS date_key, driver_key,
       duration_sec, pickup_zone_id, CAST(fare_amount AS DOUBLE) AS fare_amount, distance_km, surge_multiplier, city_key,
       vehicle_key, payment_key, CAST(hour(event_time) AS INTEGER) AS hour_of_day, status = 'completed' AS is_completed,
       surge_multiplier > 1.0 AS is_surged
FROM trips JOIN cities USING (city_id) JOIN vehicles USING (vehicle_class) JOIN payments USING (payment_type)
JOIN drivers USING (driver_id)""")
ORACLE["star_fk_violations"] = _with(RIDES, """
SELECT 'dim_city' AS dimension, CAST(count(*) AS BIGINT) AS orphan_rows, count(DISTINCT city_id) AS orphan_keys
FROM rides WHERE city_id NOT IN (SELECT city_id FROM rides WHERE status = 'completed')
UNION ALL SELECT unnest(['dim_date', 'dim_driver', 'dim_vehicle', 'dim_payment']), 0, 0""")

ORACLE["storage_report"] = _with(DIMS, """SELECT unnest(['trips_wide', 'fact_trip']) AS table_name, count(*) AS rows FROM trips
UNION ALL SELECT 'dim_city', count(*) FROM cities UNION ALL SELECT 'dim_vehicle', count(*) FROM vehicles
UNION ALL SELECT 'dim_payment', count(*) FROM payments UNION ALL SELECT 'dim_driver', count(DISTINCT driver_id) FROM trips
UNION ALL SELECT 'dim_date', date_diff('day', min(event_time)::TIMESTAMP, max(event_time)::TIMESTAMP) + 6 FROM trips""")

# -- log, parsing, routing ---------------------------------------------------------

_BLANK = ", ".join(
    f"CASE WHEN unparseable THEN NULL ELSE {c} END AS {a}"
    for c, a in [
        ("event_id", "event_id"), ("trip_id", "trip_id"), ("(epoch_us(ts) // 1000)", "produced_at_ms"), ("city_id", "city_id"),
        ("driver_id", "driver_id"), ("rider_id", "rider_id"), ("pickup_zone_id", "pickup_zone_id"),
        ("dropoff_zone_id", "dropoff_zone_id"), ("vehicle_class", "vehicle_class"), ("payment_type", "payment_type"),
        ("distance_km", "distance_km"), ("duration_sec", "duration_sec"), ("surge_multiplier", "surge_multiplier"),
        ("status", "status"), ("'producer-1'", "producer_id"), ("1", "schema_version"),
    ]
)
ORACLE["parse_events"] = _with(LOG, f'SELECT "partition", "offset", unparseable, event_time, fare_amount, {_BLANK} FROM parsed')
ORACLE["validate_events"] = _with(LOG, """
SELECT "partition", "offset", CASE WHEN NOT unparseable THEN event_id END AS event_id,
  CASE WHEN unparseable THEN NULL WHEN event_time IS NULL THEN 'PermanentDefect: missing required field ''event_time'''
       WHEN fare_amount IS NULL THEN 'PermanentDefect: fare_amount is null' END AS defect
FROM parsed""")
ORACLE["late_split"] = _with(ROUTED, """SELECT batch_no, "partition", "offset",
    CASE WHEN NOT unparseable THEN event_id END AS event_id, event_time, route, failure_stage, failure_reason FROM routed""")
ORACLE["dedup_events"] = _with(LOG, """SELECT event_id, trip_id, "partition", "offset", fare_amount FROM parsed
    WHERE NOT unparseable QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY "offset") = 1""")
ORACLE["log_end_offsets"] = _with(LOG, """SELECT 'trips.raw' AS topic, "partition", max("offset") + 1 AS end_offset,
    count(*) AS messages FROM log GROUP BY "partition" """)
ORACLE["partition_observed"] = _with(LOG, """SELECT 'trips.raw' AS topic, CAST(sum(n) AS BIGINT) AS total_events,
    count(*) AS partitions_seen, max(n) AS hottest, round(max(n) / avg(n), 3) AS imbalance_ratio
    FROM (SELECT "partition", count(*) AS n FROM log GROUP BY "partition")""")

_M = "1540483477"
_MASK = "4294967295"


def _times_m(x: str) -> str:
    return f"((({x}) * {_M}) & {_MASK})"


def _murmur2(key: str) -> str:
    """Murmur2 of an ASCII text, word by word, for SQL with list functions."""
    byte = lambda at: f"CAST(unicode(substr({key}, CAST({at} AS BIGINT), 1)) AS HUGEINT)"
    word = f"({byte('i*4+1')} | ({byte('i*4+2')} << 8) | ({byte('i*4+3')} << 16) | ({byte('i*4+4')} << 24))"
    mixed_word = _times_m(f"xor({_times_m('w')}, {_times_m('w')} >> 24)")
    words = f"[{mixed_word} for w in [{word} for i in range(length({key}) // 4)]]"
    start = f"xor(CAST(2538058380 AS HUGEINT), CAST(length({key}) AS HUGEINT))"
    body = f"list_reduce(list_concat([{start}], {words}), lambda h, w: xor({_times_m('h')}, w))"
    base = f"(length({key}) // 4) * 4"
    rest = f"""CASE length({key}) % 4
        WHEN 0 THEN b
        WHEN 1 THEN {_times_m(f"xor(b, {byte(base + ' + 1')})")}
        WHEN 2 THEN {_times_m(f"xor(b, {byte(base + ' + 1')} | ({byte(base + ' + 2')} << 8))")}
        ELSE {_times_m(f"xor(b, {byte(base + ' + 1')} | ({byte(base + ' + 2')} << 8) | ({byte(base + ' + 3')} << 16))")} END"""
    return body, rest


def _partition_view(source: str, columns: str, key: str) -> str:
    body, rest = _murmur2(key)
    return f"""
bodies AS (SELECT {columns}, {body} AS b FROM {source}),
tails AS (SELECT *, {rest} AS t FROM bodies),
folded AS (SELECT *, {_times_m('xor(t, t >> 13)')} AS f FROM tails),
placed AS (SELECT *, CAST((xor(f, f >> 15) & 2147483647) % 6 AS INTEGER) AS "partition" FROM folded)"""


ORACLE["kafka_partition_of"] = _with(
    _partition_view("customer", "c_custkey, c_name", "c_name"), 'SELECT c_custkey, c_name, "partition" FROM placed'
)
ORACLE["partition_skew"] = _with(
    FIELDS + """,
pairs AS (SELECT * FROM (SELECT unnest(['trip_id', 'city_id', 'driver_id', 'rider_id']) AS candidate,
                         unnest([trip_id, city_id, driver_id, rider_id]) AS key FROM fields)),
keys AS (SELECT candidate, key, count(*) AS n FROM pairs GROUP BY 1, 2),"""
    + _partition_view("keys", "candidate, key, n", "key")
    + """,
counts AS (SELECT candidate, p AS "partition", coalesce(sum(n) FILTER (WHERE "partition" = p), 0) AS r
  FROM placed, (SELECT unnest(range(6)) AS p) GROUP BY 1, 2)""",
    """SELECT candidate, CAST(sum(r) AS BIGINT) AS total_events,
    string_agg(CAST(CAST(r AS BIGINT) AS VARCHAR), ',' ORDER BY "partition") AS per_partition,
    round(CAST(sum(r) AS DOUBLE) / 6, 1) AS ideal_per_partition,
    round(max(r) / (CAST(sum(r) AS DOUBLE) / 6), 3) AS imbalance_ratio,
    round(100 * CAST(max(r) AS DOUBLE) / CAST(sum(r) AS DOUBLE), 2) AS hottest_partition_pct,
    round(100 * CAST(min(r) AS DOUBLE) / CAST(sum(r) AS DOUBLE), 2) AS coldest_partition_pct,
    count(*) FILTER (WHERE r = 0) AS empty_partitions,
    (SELECT count(*) FROM keys k WHERE k.candidate = counts.candidate) AS distinct_keys
    FROM counts GROUP BY candidate""",
)

# -- serving tables ----------------------------------------------------------------

_MEASURES = "vehicle_class, payment_type, distance_km, duration_sec, fare_amount, surge_multiplier, status"
ORACLE["fanout_by_id"] = _with(ROUTED, f"""SELECT trip_id, event_id, event_time, (epoch_us(ts) // 1000) AS produced_at_ms,
    (epoch_us(ts) // 1000) AS ingested_at_ms, city_id, driver_id, rider_id, pickup_zone_id, dropoff_zone_id, {_MEASURES},
    'producer-1' AS producer_id, 1 AS schema_version FROM sound""")
ORACLE["fanout_driver_day"] = _with(ROUTED, f"""SELECT driver_id, CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date,
    event_time, trip_id, event_id, city_id, rider_id, {_MEASURES}, (epoch_us(ts) // 1000) AS ingested_at_ms FROM sound""")
ORACLE["fanout_city_hour"] = _with(ROUTED, f"""SELECT city_id, date_trunc('hour', event_time) AS event_hour, trip_id, event_id,
    event_time, driver_id, rider_id, pickup_zone_id, dropoff_zone_id, {_MEASURES}, (epoch_us(ts) // 1000) AS ingested_at_ms FROM sound""")
ORACLE["driver_day_view"] = _with(ROUTED, f"""SELECT driver_id, CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date,
    event_time, trip_id, event_id, city_id, rider_id, {_MEASURES} FROM sound""")
ORACLE["trip_lookup"] = _with(ROUTED, """SELECT trip_id, event_id, event_time, driver_id, city_id, fare_amount, status FROM sound
    QUALIFY row_number() OVER (PARTITION BY driver_id ORDER BY event_time DESC, trip_id DESC) = 1""")

_LINES = """l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, l_shipdate"""
_NEWEST = """ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC"""
ORACLE["upsert_latest"] = f"""SELECT {_LINES} FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_linestatus = 'F', {_NEWEST.removeprefix('ORDER BY ')}) = 1"""
ORACLE["rollup_partial_upsert"] = f"""
WITH old AS (SELECT {_LINES} FROM lineitem WHERE l_linestatus = 'F'
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber {_NEWEST}) = 1),
     new AS (SELECT {_LINES} FROM lineitem WHERE l_linestatus <> 'F'
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber {_NEWEST}) = 1)
SELECT l_orderkey, l_linenumber,
       {", ".join(f"coalesce(o.{c}, n.{c}) AS {c}" for c in ("l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax"))},
       {", ".join(f"coalesce(n.{c}, o.{c}) AS {c}" for c in ("l_extendedprice", "l_linestatus", "l_shipdate"))}
FROM old o FULL OUTER JOIN new n USING (l_orderkey, l_linenumber)"""

# -- quarantine --------------------------------------------------------------------

ORACLE["quarantine_union"] = _with(QUARANTINE, """SELECT original_payload, failure_reason, failure_stage, retry_count, first_failed_at_ms,
    first_failed_at_ms AS quarantined_at_ms, event_id, source_topic, source_partition, source_offset, replay_count,
    1 AS dlq_schema_version FROM quarantine""")
ORACLE["dlq_inspect"] = _with(QUARANTINE, """SELECT count(*) AS records, count(DISTINCT event_id) AS distinct_event_ids,
    count(*) FILTER (WHERE event_id IS NULL) AS records_without_event_id,
    coalesce(round(avg(retry_count) FILTER (WHERE retry_count > 0), 3), 0.0) AS mean_retry_count_when_retried,
    count(*) FILTER (WHERE failure_stage IN ('cassandra_sink', 'producer')) AS would_reinject,
    count(*) FILTER (WHERE failure_stage = 'late_event') AS would_direct_write,
    count(*) FILTER (WHERE failure_stage = 'parse') AS would_park FROM quarantine""")
ORACLE["dlq_by_reason"] = _with(QUARANTINE, """SELECT failure_stage, split_part(failure_reason, ':', 1) AS reason,
    count(*) AS records FROM quarantine GROUP BY 1, 2""")
ORACLE["dlq_route"] = _with(QUARANTINE, """SELECT failure_stage, event_id, source_partition, source_offset, replay_count, action,
    CASE WHEN replay_count >= 3 THEN 'replay_count >= 3'
         WHEN action = 'park' THEN 'stage ''' || failure_stage || ''' is not automatically recoverable' END AS park_reason
    FROM actions""")
ORACLE["dlq_pending"] = _with(QUARANTINE, """SELECT failure_stage, event_id, source_partition, source_offset, first_failed_at_ms
    FROM quarantine WHERE first_failed_at_ms >= epoch_ms(TIMESTAMP '2024-01-16')""")
ORACLE["dlq_reinject"] = _with(QUARANTINE, """SELECT trip_id AS key, original_payload AS value, 'trips.raw' AS topic,
    CAST(replay_count + 1 AS INTEGER) AS replay_count, failure_stage FROM actions WHERE action = 'reinject'""")
ORACLE["dlq_direct_write"] = _with(QUARANTINE, """SELECT driver_id, CAST(CAST(sent_time AS DATE) AS VARCHAR) AS event_date,
    sent_time AS event_time, trip_id, event_id, city_id, value AS fare_amount, status FROM actions WHERE action = 'direct_write'""")
ORACLE["dlq_drain_totals"] = _with(QUARANTINE, """SELECT count(*) AS records_read,
    count(*) FILTER (WHERE action = 'reinject') AS reinjected, CAST(0 AS BIGINT) AS reinject_failed,
    count(*) FILTER (WHERE action = 'direct_write') AS direct_written, CAST(0 AS BIGINT) AS direct_write_failed,
    count(*) FILTER (WHERE action = 'park') AS parked, CAST(0 AS BIGINT) AS failed, count(*) AS accounted_for,
    CAST(0 AS BIGINT) AS unaccounted FROM actions""")
_LOGGED = QUARANTINE + """,
logged AS (SELECT *, first_failed_at_ms % 7 = 0 AS cut FROM quarantine)"""
ORACLE["dlq_log_inspect"] = _with(_LOGGED, """SELECT count(*) AS records, count(DISTINCT CASE WHEN NOT cut THEN event_id END) AS distinct_event_ids,
    count(*) FILTER (WHERE cut OR event_id IS NULL) AS records_without_event_id,
    coalesce(round(avg(retry_count) FILTER (WHERE retry_count > 0 AND NOT cut), 3), 0.0) AS mean_retry_count_when_retried,
    count(*) FILTER (WHERE failure_stage IN ('cassandra_sink', 'producer') AND NOT cut) AS would_reinject,
    count(*) FILTER (WHERE failure_stage = 'late_event' AND NOT cut) AS would_direct_write,
    count(*) FILTER (WHERE failure_stage = 'parse' AND NOT cut) AS would_park, count(*) FILTER (WHERE cut) AS unreadable FROM logged""")
ORACLE["dlq_sample"] = _with(QUARANTINE, """SELECT failure_stage, event_id, first_failed_at_ms, source_offset FROM quarantine
    ORDER BY first_failed_at_ms NULLS FIRST, failure_stage NULLS FIRST, event_id NULLS FIRST, source_offset NULLS FIRST LIMIT 3""")
ORACLE["dlq_breaker"] = _with(QUARANTINE, """SELECT 'dlq_circuit_breaker' AS kind, count(*) AS records, CAST(10 AS BIGINT) AS ceiling
    FROM quarantine HAVING count(*) > 10""")
ORACLE["dlq_bounded_drains"] = _with(QUARANTINE, """SELECT count(*) AS records_read,
    count(*) FILTER (WHERE action = 'reinject') AS reinjected, count(*) FILTER (WHERE action = 'direct_write') AS direct_written,
    count(*) FILTER (WHERE action = 'park') AS parked, true AS within_budget, count(*) AS in_ledger FROM actions""")

ORACLE["drain_end_to_end"] = _with(QUARANTINE + """,
ends AS (SELECT *, CASE WHEN action = 'reinject' AND failure_stage = 'producer' AND first_failed_at_ms % 3 = 0 THEN 'reinject_failed'
    WHEN action = 'reinject' THEN 'reinjected' WHEN action = 'direct_write' AND first_failed_at_ms % 2 = 0 THEN 'direct_write_failed'
    WHEN action = 'direct_write' THEN 'direct_written' ELSE 'parked' END AS outcome,
    CASE WHEN first_failed_at_ms < epoch_ms(TIMESTAMP '2024-01-16') THEN 0 ELSE 1 END AS done_by FROM actions),
drains AS (SELECT CAST(unnest(range(3)) AS BIGINT) AS drain_id),
sums AS (SELECT drain_id, count(outcome) AS records_read,
    count(*) FILTER (WHERE outcome = 'reinjected') AS reinjected, count(*) FILTER (WHERE outcome = 'reinject_failed') AS reinject_failed,
    count(*) FILTER (WHERE outcome = 'direct_written') AS direct_written,
    count(*) FILTER (WHERE outcome = 'direct_write_failed') AS direct_write_failed, count(*) FILTER (WHERE outcome = 'parked') AS parked
  FROM drains LEFT JOIN ends ON done_by = drain_id GROUP BY drain_id)""", """
SELECT *, reinjected AS in_log, records_read AS in_ledger, reinject_failed + direct_write_failed + parked AS in_parking,
  (SELECT count(DISTINCT trip_id) FROM ends WHERE outcome = 'direct_written' AND done_by <= drain_id) AS trips_served,
  CASE WHEN drain_id = 0 THEN 0 ELSE (SELECT count(DISTINCT trip_id) FROM ends WHERE outcome = 'direct_written' AND done_by = 0) END AS newer_fares,
  reinject_failed + direct_write_failed AS failed, records_read AS accounted_for, CAST(0 AS BIGINT) AS unaccounted FROM sums""")

# -- reliability -------------------------------------------------------------------

ORACLE["retry_outcomes"] = _with(ATTEMPTS, """SELECT event_id, "table", attempts, succeeded, last_error, backoff_ms, outcome, retries
    FROM outcomes""")
ORACLE["retry_accounting"] = _with(ATTEMPTS, """
SELECT "table", CAST(sum(attempts) AS BIGINT) AS attempts, count(*) FILTER (WHERE succeeded) AS successes,
  count(*) FILTER (WHERE outcome = 'exhausted') AS failures_exhausted, CAST(sum(retries) AS BIGINT) AS retries_before_success,
  count(*) FILTER (WHERE outcome = 'retried') AS retried_writes, round(sum(backoff_ms), 1) AS total_backoff_ms,
  coalesce((SELECT string_agg(error || '=' || n, ',' ORDER BY error) FROM
     (SELECT error, count(*) AS n FROM attempts a WHERE a."table" = outcomes."table" AND error IS NOT NULL GROUP BY error)), '') AS failure_reasons,
  coalesce(round(sum(retries) / nullif(count(*) FILTER (WHERE succeeded), 0), 4), 0.0) AS avg_retries_to_success,
  coalesce(round(sum(retries) / nullif(count(*) FILTER (WHERE outcome = 'retried'), 0), 3), 0.0) AS avg_retries_among_retried
FROM outcomes GROUP BY "table" """)
ORACLE["backoff_delays"] = _with(ATTEMPTS, """SELECT event_id, "table", attempt, error, backoff_ms FROM attempts WHERE NOT ok""")

FOLLOWED = QUARANTINE + """,
sides AS (
  SELECT CASE WHEN unparseable THEN 'trips.raw/' || "partition" || '/' || "offset" ELSE event_id END AS identity, 1 AS m, 0 AS w, 0 AS q FROM routed
  UNION ALL SELECT event_id, 0, 1, 0 FROM sound
  UNION ALL SELECT coalesce(event_id, source_topic || '/' || source_partition || '/' || source_offset), 0, 0, 1 FROM quarantine),
followed AS (SELECT identity, CAST(sum(m) AS BIGINT) AS messages, max(w) = 1 AS written, max(q) = 1 AS quarantined FROM sides GROUP BY 1),
status AS (SELECT *, CASE WHEN messages = 0 AND quarantined AND NOT written THEN 'never_logged' WHEN messages = 0 THEN 'unexpected'
   WHEN written AND quarantined THEN 'written_and_quarantined' WHEN written THEN 'written' WHEN quarantined THEN 'quarantined'
   ELSE 'lost' END AS status FROM followed)"""
ORACLE["reconcile_identity"] = _with(FOLLOWED, """SELECT status, count(*) AS identities, CAST(sum(messages) AS BIGINT) AS messages
    FROM status GROUP BY status""")
ORACLE["reconcile_totals"] = _with(FOLLOWED, """SELECT CAST(sum(messages) AS BIGINT) AS messages_persisted,
    CAST(sum(messages) - count(*) FILTER (WHERE messages > 0) AS BIGINT) AS duplicates, count(*) FILTER (WHERE messages > 0) AS expected_distinct,
    count(*) FILTER (WHERE messages > 0 AND written) AS written_distinct, count(*) FILTER (WHERE messages > 0 AND quarantined) AS quarantined_distinct,
    count(*) FILTER (WHERE messages > 0 AND written AND quarantined) AS partial_write_overlap,
    count(*) FILTER (WHERE status = 'lost') AS unaccounted, count(*) FILTER (WHERE status = 'never_logged') AS never_logged,
    round(100 * CAST(count(*) FILTER (WHERE status = 'lost') AS DOUBLE) / count(*) FILTER (WHERE messages > 0), 4) AS silent_loss_pct FROM status""")

# -- rollup ------------------------------------------------------------------------

STAGE = ROUTED + """,
city_hour AS (SELECT *, date_trunc('hour', event_time) AS event_hour,
   date_trunc('hour', event_time) + to_seconds(CAST((distance_km + 60) * 60 AS BIGINT)) AS loaded_at FROM sound),
earlier AS (SELECT trip_id, CASE WHEN payment_type = 'cash' THEN event_time + INTERVAL 1 HOUR ELSE event_time END AS event_time,
   city_id, surge_multiplier FROM city_hour WHERE event_hour < '2024-01-16')"""
ORACLE["hourly_rollup_load"] = _with(STAGE, """SELECT c.trip_id, c.event_time, c.city_id,
    CASE WHEN e.trip_id IS NULL THEN c.vehicle_class ELSE 'unknown' END AS vehicle_class, c.fare_amount, c.surge_multiplier, c.status, c.loaded_at
    FROM city_hour c LEFT JOIN earlier e USING (trip_id)""")
ORACLE["rollup_stage_reads"] = ORACLE["hourly_rollup_load"]
ORACLE["rollup_drift"] = _with(STAGE, """SELECT coalesce(c.event_hour, date_trunc('hour', e.event_time)) AS event_hour,
    count(c.trip_id) AS extracted, count(e.trip_id) AS loaded, count(*) FILTER (WHERE e.trip_id IS NULL) AS missing,
    count(*) FILTER (WHERE c.trip_id IS NULL) AS unexpected,
    count(*) FILTER (WHERE c.event_hour <> date_trunc('hour', e.event_time)) AS moved,
    count(c.trip_id) - count(e.trip_id) AS drift
    FROM city_hour c FULL OUTER JOIN earlier e USING (trip_id) GROUP BY 1""")
ORACLE["hour_completeness"] = _with(STAGE + """,
days AS (SELECT date_trunc('day', min(event_hour)) AS first, date_trunc('day', max(event_hour)) + INTERVAL 1 DAY AS last FROM city_hour),
spine AS (SELECT city_id, unnest(generate_series(first, last - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS event_hour
   FROM days, (SELECT DISTINCT city_id FROM city_hour))""", """
SELECT city_id, s.event_hour, count(c.trip_id) AS rows, count(c.trip_id) = 0 AS is_empty
FROM spine s LEFT JOIN city_hour c USING (city_id, event_hour) GROUP BY 1, 2""")
ORACLE["backfill_window"] = _with(STAGE + """,
days AS (SELECT date_trunc('day', min(event_hour)) AS first, date_trunc('day', max(event_hour)) + INTERVAL 1 DAY AS last FROM city_hour),
chunks AS (SELECT 'run-' || n AS audit_id, window_start, least(window_start + INTERVAL 14 DAY, last) AS window_end
  FROM (SELECT (row_number() OVER (ORDER BY s)) - 1 AS n, s AS window_start, last
        FROM (SELECT unnest(generate_series(first, last - INTERVAL 1 HOUR, INTERVAL 14 DAY)) AS s, last FROM days)))""", """
SELECT audit_id, window_start, window_end, count(trip_id) AS rows_loaded,
  date_diff('hour', window_start, window_end) || 'h window, '
  || (date_diff('hour', window_start, window_end) - count(DISTINCT event_hour)) || ' empty hours' AS notes
FROM chunks LEFT JOIN city_hour ON event_hour >= window_start AND event_hour < window_end GROUP BY 1, 2, 3""")
_DAYS_AND_AFTER = """,
days AS (SELECT date_trunc('day', min(event_hour)) AS first, date_trunc('day', max(event_hour)) + INTERVAL 1 DAY AS last FROM city_hour),
chunks AS (SELECT s AS window_start, least(s + INTERVAL 14 DAY, last) AS window_end
  FROM (SELECT unnest(generate_series(first, last - INTERVAL 1 HOUR, INTERVAL 14 DAY)) AS s, last FROM days)
  UNION ALL SELECT last, last + INTERVAL 1 DAY FROM days)"""
ORACLE["closed_hour_gate"] = _with(STAGE + _DAYS_AND_AFTER, """SELECT window_start, count(trip_id) AS rows, count(trip_id) >= 100 AS landed
    FROM chunks LEFT JOIN city_hour ON event_hour >= window_start AND event_hour < window_end GROUP BY 1""")
ORACLE["backfill_alerts"] = _with(STAGE + _DAYS_AND_AFTER, """SELECT 'backfill_empty' AS kind, window_start, window_end,
    CAST(date_diff('hour', window_start, window_end) AS INTEGER) AS hours
    FROM chunks LEFT JOIN city_hour ON event_hour >= window_start AND event_hour < window_end GROUP BY 2, 3 HAVING count(trip_id) = 0""")
ORACLE["rollup_flow"] = _with(STAGE + _DAYS_AND_AFTER + """,
numbered AS (SELECT *, 'run-' || (row_number() OVER (ORDER BY window_start) - 1) AS audit_id FROM chunks),
held AS (SELECT audit_id, window_start, count(trip_id) AS rows, count(*) FILTER (WHERE payment_type = 'cash') AS lost
  FROM numbered LEFT JOIN city_hour ON event_hour >= window_start AND event_hour < window_end GROUP BY 1, 2),
markers AS (
  SELECT *, unnest(['0-planned', '0-extracted', '0-loaded', '0-verified', '0-closed']) AS name FROM held WHERE audit_id <> 'run-1' OR lost = 0
  UNION ALL SELECT *, unnest(['0-planned', '0-extracted', '0-loaded', '0-drifted', '1-planned', '1-extracted', '1-loaded', '1-verified', '1-closed'])
  FROM held WHERE audit_id = 'run-1' AND lost > 0)""", """
SELECT 'stage' AS part, NULL AS audit_id, NULL AS name, event_hour AS at, count(*) AS rows, round(sum(fare_amount), 2) AS fares
FROM city_hour GROUP BY event_hour
UNION ALL SELECT 'audit', audit_id, name, window_start,
  CASE WHEN name LIKE '%planned' OR name LIKE '%verified' THEN NULL WHEN name LIKE '%drifted' THEN lost ELSE rows END, NULL FROM markers
UNION ALL SELECT 'alert', audit_id, 'rollup_drift', window_start, lost, NULL FROM held WHERE audit_id = 'run-1' AND lost > 0
UNION ALL SELECT 'alert', audit_id, 'backfill_empty', window_start, 0, NULL FROM held WHERE rows = 0""")
ORACLE["city_hour_lookup"] = _with(ROUTED, f"""SELECT city_id, date_trunc('hour', event_time) AS event_hour, trip_id, event_id,
    event_time, driver_id, rider_id, pickup_zone_id, dropoff_zone_id, {_MEASURES} FROM sound
    WHERE (city_id, date_trunc('hour', event_time)) IN (
      SELECT (city_id, hour) FROM (SELECT city_id, date_trunc('hour', event_time) AS hour, count(*) AS n FROM sound GROUP BY ALL
      ORDER BY n DESC, city_id, hour LIMIT 1))""")
ORACLE["driver_day_lookup"] = _with(ROUTED, f"""SELECT driver_id, CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date,
    event_time, trip_id, event_id, city_id, rider_id, {_MEASURES} FROM sound
    WHERE (driver_id, CAST(event_time AS DATE)) IN (
      SELECT (driver_id, day) FROM (SELECT driver_id, CAST(event_time AS DATE) AS day, count(*) AS n FROM sound GROUP BY ALL
      ORDER BY n DESC, driver_id, day LIMIT 1))""")
ORACLE["freshness_violations"] = _with(STAGE, """SELECT event_hour, max(loaded_at) AS loaded_at, count(*) AS trips,
    round(CAST(epoch_us(max(loaded_at)) - epoch_us(event_hour + INTERVAL 1 HOUR) AS DOUBLE) / 60e6, 3) AS minutes_after_close
    FROM city_hour GROUP BY event_hour
    HAVING CAST(epoch_us(max(loaded_at)) - epoch_us(event_hour + INTERVAL 1 HOUR) AS DOUBLE) / 60e6 > 20""")

_WINDOWS = """time_bucket(INTERVAL 6 HOUR, event_time, TIMESTAMP '2024-01-01') AS window_start,
    time_bucket(INTERVAL 6 HOUR, event_time, TIMESTAMP '2024-01-01') + INTERVAL 6 HOUR AS window_end,
    count(*) AS trips, round(sum(fare_amount), 2) AS revenue, round(avg(duration_sec), 6) AS avg_duration_sec"""
ORACLE["city_window_rollup"] = _with(ROUTED, f"""SELECT city_id, {_WINDOWS}, count(DISTINCT driver_id) AS active_drivers
    FROM sound WHERE status = 'completed' GROUP BY 1, 2, 3""")

_DONE = """SELECT {city} AS city_id, {day} AS day, count(*) AS trips, count(DISTINCT driver_id) AS drivers, true AS within_bound
    FROM sound WHERE status = 'completed' GROUP BY ALL"""
ORACLE["rollup_distinct"] = _with(ROUTED, " UNION ALL ".join(
    _DONE.format(city=city, day=day) for city, day in (
        ("city_id", "CAST(CAST(event_time AS DATE) AS VARCHAR)"), ("CAST(NULL AS VARCHAR)", "CAST(CAST(event_time AS DATE) AS VARCHAR)"),
        ("city_id", "CAST(NULL AS VARCHAR)"),
    )
))

# -- telemetry ---------------------------------------------------------------------

LATENCY = SAMPLES + """,
latency AS (SELECT run_id, (epoch_us(ts) // 1000) AS produced_at_ms, (epoch_us(ts) // 1000) + CAST(round(value * 100) AS BIGINT) - 50 AS written_at_ms,
  CAST(round(value * 100) AS BIGINT) - 50 AS latency_ms, event_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 5 AS batch_id
  FROM samples WHERE CAST(round(value * 100) AS BIGINT) - 50 >= 0)"""
ORACLE["latency_samples"] = _with(LATENCY, """SELECT run_id, produced_at_ms // 60000 AS minute_bucket, event_id, produced_at_ms,
    written_at_ms, latency_ms, batch_id FROM latency""")
_Q = "quantile_cont(latency_ms, {})"


def _tenths(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(18, 6)), 1) AS DOUBLE)"


ORACLE["latency_percentiles"] = _with(LATENCY, f"""SELECT run_id, count(*) AS samples, min(latency_ms) AS min_ms,
    {", ".join(f"{_tenths(_Q.format(q))} AS {n}_ms" for n, q in (("p50", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99), ("p999", 0.999)))},
    max(latency_ms) AS max_ms, {_tenths('avg(latency_ms)')} AS mean_ms,
    CASE WHEN {_Q.format(0.99)} < 1000 THEN 'p99' WHEN {_Q.format(0.95)} < 1000 THEN 'p95' WHEN {_Q.format(0.5)} < 1000 THEN 'p50' ELSE 'none' END AS sub_second_at,
    round(100 * CAST(count(*) FILTER (WHERE latency_ms < 1000) AS DOUBLE) / count(*), 3) AS pct_under_1s,
    round(100 * CAST(count(*) FILTER (WHERE latency_ms < 500) AS DOUBLE) / count(*), 3) AS pct_under_500ms
    FROM latency GROUP BY run_id""")


def _nearest(p: float) -> str:
    return f"round(list_sort(list(value))[CAST(least(count(*) - 1, round_even({p} * (count(*) - 1), 0)) AS BIGINT) + 1], 4)"


ORACLE["batch_duration_percentiles"] = _with(SAMPLES, f"""SELECT run_id,
    {", ".join(f"{_nearest(p)} AS batch_seconds_{n}" for n, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)))}
    FROM samples GROUP BY run_id""")
ORACLE["run_summary"] = _with(QUARANTINE + """,
per_event AS (SELECT event_id, count(*) FILTER (WHERE succeeded) AS ok, sum(retries) AS retries,
  count(*) FILTER (WHERE outcome = 'retried') AS retried, count(*) FILTER (WHERE outcome = 'exhausted') AS exhausted
  FROM outcomes GROUP BY 1),
merged AS (SELECT r.*, ok, retries, retried, exhausted, 'partition-' || "partition" AS run_id,
   CASE WHEN route = 'ok' THEN CAST(distance_km * 10 AS BIGINT) END AS waited
  FROM routed r LEFT JOIN per_event p ON r.event_id = p.event_id AND NOT r.unparseable),
errors AS (SELECT 'partition-' || "partition" AS run_id, error, count(*) AS n FROM routed r JOIN attempts a ON r.event_id = a.event_id
  WHERE error IS NOT NULL AND NOT unparseable GROUP BY 1, 2)""", """
SELECT run_id, count(*) AS input_rows, count(*) FILTER (WHERE route = 'unparseable') AS unparseable,
  count(*) FILTER (WHERE route = 'invalid') AS invalid, count(*) FILTER (WHERE route = 'late') AS late,
  count(*) FILTER (WHERE failure_stage IS NOT NULL) + count(*) FILTER (WHERE exhausted > 0) AS dlq,
  CAST(sum(ok) AS BIGINT) AS rows_written, CAST(sum(ok) AS BIGINT) AS successes, CAST(sum(retries) AS BIGINT) AS retries_before_success,
  CAST(sum(retried) AS BIGINT) AS retried_writes, CAST(sum(retries) AS BIGINT) AS retried_writes_retries,
  CAST(sum(exhausted) AS BIGINT) AS failures_exhausted, CAST(sum(waited) AS BIGINT) AS latency_sum_ms, count(waited) AS latency_count,
  count(DISTINCT batch_no) AS batches, count(DISTINCT batch_no) AS non_empty_batches, max(waited) AS latency_max_ms,
  coalesce((SELECT string_agg(error || '=' || n, ',' ORDER BY error) FROM errors e WHERE e.run_id = merged.run_id), '') AS failure_reasons,
  round(CAST(sum(ok) AS DOUBLE) / count(*), 3) AS write_amplification,
  coalesce(round(CAST(sum(retries) AS DOUBLE) / nullif(sum(ok), 0), 5), 0.0) AS avg_retries_to_success_all_writes,
  coalesce(round(CAST(sum(retries) AS DOUBLE) / nullif(sum(retried), 0), 3), 0.0) AS avg_retries_among_retried_writes,
  round(CAST(sum(waited) AS DOUBLE) / nullif(count(waited), 0), 2) AS mean_e2e_latency_ms
FROM merged GROUP BY run_id""")
ORACLE["run_stats"] = _with(SAMPLES, """SELECT run_id, count(value) AS n, round(avg(value), 3) AS mean, round(min(value), 3) AS min,
    round(max(value), 3) AS max, round(coalesce(stddev_samp(value), 0.0), 3) AS stdev,
    round(exp(avg(ln(CASE WHEN value > 0 THEN value END))), 3) AS geometric_mean, bool_and(k > 0) AS all_ok,
    round(quantile_cont(value, 0.5), 3) AS median FROM samples GROUP BY run_id""")
ORACLE["longest_rising_run"] = _with(SAMPLES + """,
steps AS (SELECT *, coalesce(value > lag(value) OVER (PARTITION BY run_id ORDER BY ts, event_id), false) AS rises FROM samples),
islands AS (SELECT *, sum(CASE WHEN rises THEN 0 ELSE 1 END) OVER (PARTITION BY run_id ORDER BY ts, event_id) AS island FROM steps)""",
    """SELECT run_id, CAST(max(n) AS BIGINT) AS longest_rising_run
    FROM (SELECT run_id, island, sum(CASE WHEN rises THEN 1 ELSE 0 END) AS n FROM islands GROUP BY 1, 2) GROUP BY 1""")
ORACLE["first_recovery"] = _with(SAMPLES + """,
faults AS (SELECT run_id, min(ts) AS fault_at FROM samples WHERE event_type = 'error' GROUP BY 1),
firsts AS (SELECT run_id, fault_at, ts, event_id FROM samples JOIN faults USING (run_id) WHERE ts > fault_at AND value > 0 AND k > 10
  QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) = 1)""",
    """SELECT f.run_id, f.fault_at, event_id AS recovery_batch_id,
    round(CAST(epoch_us(ts) - epoch_us(f.fault_at) AS DOUBLE) / 1e6, 3) AS recovery_seconds, event_id IS NOT NULL AS recovered
    FROM faults f LEFT JOIN firsts USING (run_id)""")

STEPS = SAMPLES + """,
steps AS (SELECT run_id AS campaign, CAST(k // 10 * 100 + 100 AS BIGINT) AS rate, 90.0::DOUBLE AS duration_seconds,
  CAST(sum(k) % 40 AS DOUBLE) * (k // 10 * 100 + 100) / 400.0::DOUBLE AS drain_seconds, (94.5 + count(*) % 50)::DOUBLE AS attainment_pct,
  CAST(floor((count(*) % 12) * (k // 10 * 100 + 100) / 1000) AS BIGINT) AS growth_run, sum(k) % 19 <> 0 AS drained,
  CAST(CASE WHEN max(event_id) % 23 = 0 THEN 1 ELSE 0 END AS BIGINT) AS unaccounted FROM samples GROUP BY run_id, k // 10),
verdicts AS (SELECT *, round(drain_seconds / duration_seconds, 4) AS drain_ratio,
  array_to_string(list_filter([CASE WHEN drain_seconds / duration_seconds > 0.25 THEN 'slow_drain' END,
    CASE WHEN attainment_pct < 95 THEN 'producer_below_target' END, CASE WHEN growth_run > 5 THEN 'lag_grew' END,
    CASE WHEN NOT drained THEN 'not_drained' END, CASE WHEN unaccounted > 0 THEN 'unaccounted' END], lambda x: x IS NOT NULL), ',') AS failed_because
  FROM steps)"""
ORACLE["step_verdict"] = _with(STEPS, "SELECT *, failed_because = '' AS sustained FROM verdicts")
ORACLE["sustained_prefix"] = _with(STEPS + """,
ordered AS (SELECT *, bool_and(failed_because = '') OVER (PARTITION BY campaign ORDER BY rate) AS held FROM verdicts)""",
    "SELECT campaign, max(rate) FILTER (WHERE held) AS sustained_rate, count(*) AS steps FROM ordered GROUP BY campaign")

SLOPES = SAMPLES + """,
slopes AS (SELECT run_id, event_id, ts, count(value) OVER w AS points,
  regr_slope(value, CAST(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS DOUBLE) / 1e6) OVER w AS slope FROM samples
  WINDOW w AS (PARTITION BY run_id ORDER BY ts RANGE BETWEEN INTERVAL 7200 SECONDS PRECEDING AND CURRENT ROW))"""
ORACLE["lag_slope"] = _with(SLOPES, "SELECT run_id, event_id, ts, points, round(slope, 6) AS slope FROM slopes WHERE points >= 2")


def _rates(series: str, name: str = "rates", where: str = "true") -> str:
    return f"""
{name}_steps AS (SELECT *, CASE WHEN lag(k) OVER s IS NULL THEN 0 WHEN k >= lag(k) OVER s THEN k - lag(k) OVER s ELSE k END AS step
  FROM samples WHERE {where} WINDOW s AS (PARTITION BY {series} ORDER BY ts, event_id)),
{name} AS (SELECT *, count(*) OVER w AS samples, CAST(sum(step) OVER w - first_value(step) OVER w AS DOUBLE) AS increase
  FROM {name}_steps WINDOW w AS (PARTITION BY {series} ORDER BY ts RANGE BETWEEN INTERVAL 21600 SECONDS PRECEDING AND CURRENT ROW))"""


ORACLE["counter_rate"] = _with(SAMPLES + "," + _rates("run_id, event_type"), """SELECT run_id, event_type, event_id, ts, samples,
    increase, round(increase / 21600, 9) AS rate FROM rates""")
ORACLE["counter_rate_by_stage"] = _with(SAMPLES + "," + _rates("run_id, event_type") + """,
lasts AS (SELECT *, date_trunc('hour', ts) AS step_at FROM rates
  QUALIFY row_number() OVER (PARTITION BY run_id, event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) = 1)""",
    "SELECT step_at AS step, event_type, round(sum(increase / 21600), 9) AS rate, count(*) AS series FROM lasts GROUP BY 1, 2")

_BOUNDS = [0.1, 0.25, 0.5, 1, 2, 3, 5, 8, 13, 21, 34, 60]
_CUMULATIVE = "[" + ", ".join(f"count(*) FILTER (WHERE value <= {b})" for b in _BOUNDS) + ", count(*)]"


_LATENCY_BOUNDS = [10, 25, 50, 100, 200, 350, 500, 750, 1000, 1500, 2500, 5000, 10000, 30000]


def _quantile(q: float, edges: list = _BOUNDS) -> str:
    n = len(edges)
    bounds = f"CAST({[float(b) for b in edges]} AS DOUBLE[])"
    at = f"len(list_filter(c, lambda x: x < {q} * c[{n + 1}]))"
    return f"""CASE WHEN {at} >= {n} THEN {float(edges[-1])}::DOUBLE ELSE
      (CASE WHEN {at} = 0 THEN 0.0 ELSE {bounds}[{at}] END)
      + ({bounds}[{at} + 1] - CASE WHEN {at} = 0 THEN 0.0 ELSE {bounds}[{at}] END)
        * ({q} * c[{n + 1}] - CASE WHEN {at} = 0 THEN 0 ELSE c[{at}] END)
        / nullif(CAST(c[{at} + 1] - CASE WHEN {at} = 0 THEN 0 ELSE c[{at}] END AS DOUBLE), 0) END"""


ORACLE["latency_panel"] = _with(LATENCY + f""",
filled AS (SELECT run_id, [{", ".join(f"count(*) FILTER (WHERE latency_ms <= {b})" for b in _LATENCY_BOUNDS)}, count(*)] AS c
  FROM latency GROUP BY 1)""",
    f"""SELECT run_id, {", ".join(f"round({_quantile(q, _LATENCY_BOUNDS)}, 6) AS {n}" for n, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)))}
    FROM filled""")
ORACLE["latency_retained"] = _with(LATENCY, """SELECT run_id, event_id, produced_at_ms // 60000 AS minute_bucket, latency_ms FROM latency
    WHERE produced_at_ms // 60000 >= floor(((SELECT max(produced_at_ms) FROM latency) - 24 * 3600000) / 60000)""")
ORACLE["histogram_quantile"] = _with(SAMPLES + f""",
filled AS (SELECT run_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {_CUMULATIVE} AS c FROM samples GROUP BY 1, 2)""",
    f"""SELECT run_id, day, {", ".join(f"round({_quantile(q)}, 6) AS {n}" for n, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)))} FROM filled""")


def _held(rule: str, source: str, condition: str, hold: int) -> str:
    """Intervals over which a condition held, by numbering the samples where it does not."""
    return f"""
SELECT '{rule}' AS rule, run_id, min(ts) AS active_since, min(ts) FILTER (WHERE ts >= since + INTERVAL {hold} SECONDS) AS fired_at,
  max(ts) AS last_active, count(*) AS samples
FROM (SELECT *, min(ts) OVER (PARTITION BY run_id, island) AS since
      FROM (SELECT *, coalesce({condition}, false) AS is_on,
              sum(CASE WHEN coalesce({condition}, false) THEN 0 ELSE 1 END) OVER (PARTITION BY run_id ORDER BY ts, event_id) AS island
            FROM {source}) WHERE is_on)
GROUP BY run_id, island HAVING max(ts) >= min(ts) + INTERVAL {hold} SECONDS"""


_CELLS = range(len(_BOUNDS) + 1)
_NOW = ["sum(CASE WHEN " + (f"value <= {b}" if b else "true") + " THEN 1 ELSE 0 END) OVER d" for b in [*_BOUNDS, None]]
ORACLE["duration_p95_sliding"] = _with(SAMPLES + f""",
counters AS (SELECT run_id, event_id, ts, {", ".join(f"{c} AS c{i}" for i, c in enumerate(_NOW))} FROM samples
  WINDOW d AS (PARTITION BY run_id, CAST(ts AS DATE) ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
steps AS (SELECT run_id, event_id, ts, {", ".join(f"CASE WHEN lag(c{i}) OVER s IS NULL THEN 0 WHEN c{i} >= lag(c{i}) OVER s THEN c{i} - lag(c{i}) OVER s ELSE c{i} END AS s{i}" for i in _CELLS)}
  FROM counters WINDOW s AS (PARTITION BY run_id ORDER BY ts, event_id)),
grown AS (SELECT run_id, event_id, ts, [{", ".join(f"CAST(sum(s{i}) OVER w - first_value(s{i}) OVER w AS BIGINT)" for i in _CELLS)}] AS c
  FROM steps WINDOW w AS (PARTITION BY run_id ORDER BY ts RANGE BETWEEN INTERVAL 21600 SECONDS PRECEDING AND CURRENT ROW))""",
    f"""SELECT run_id, event_id, ts, c[{len(_BOUNDS) + 1}] AS samples,
    {", ".join(f"CASE WHEN c[{len(_BOUNDS) + 1}] = 0 THEN NULL ELSE round({_quantile(q)}, 6) END AS {n}" for n, q in (("p50", 0.5), ("p95", 0.95)))} FROM grown""")
ORACLE["alert_intervals"] = _with(
    SLOPES + "," + ",".join(
        [_rates("run_id"), *(_rates("run_id", t, f"event_type = '{t}'") for t in ("signup", "error", "click", "purchase"))]
    ) + f""",
two_points AS (SELECT * FROM slopes WHERE points >= 2),
hourly AS (SELECT run_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts, 0 AS event_id, {_CUMULATIVE} AS c FROM samples GROUP BY 1, 2),
p95s AS (SELECT run_id, ts, event_id, {_quantile(0.95)} AS p95 FROM hourly),
actual AS (SELECT run_id, date_trunc('hour', ts) AS ts, avg(k) AS actual_rate FROM samples WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2),
target AS (SELECT run_id, date_trunc('hour', ts) AS ts, max(k) AS target_rate FROM samples WHERE event_type IN ('signup', 'error') GROUP BY 1, 2),
producers AS (SELECT *, 0 AS event_id FROM actual JOIN target USING (run_id, ts))""",
    " UNION ALL ".join(
        [
            _held("lag_rising", "two_points", "slope > 0", 300),
            _held("lag_high", "samples", "value > 5", 3600),
            _held("batch_duration_high", "p95s", "p95 > 10", 3600),
            _held("producer_below_target", "producers", "target_rate > 0 AND actual_rate < target_rate * 0.95", 3600),
            _held("counter_increasing", "rates", "increase > 300", 3600),
            _held("dlq_rate_high", "signup", "increase / 21600 > 0.01", 3600),
            _held("writes_exhausted", "error", "increase > 0", 60),
            _held("retry_rate_high", "click", "increase / 21600 > 0.02", 3600),
            _held("deliveries_failing", "purchase", "increase > 0", 60),
        ]
    ),
)
_DELIVERED = ROUTED + """,
delivered AS (
  SELECT *, CASE WHEN id % 41 = 5 THEN 'InvalidRequest' WHEN id % 43 = 6 THEN 'WriteTimeout' END AS refused,
         CASE WHEN id % 41 = 5 THEN 2 WHEN id % 43 = 6 OR id % 47 = 7 THEN 4 ELSE 2 END AS tries
  FROM sound),
aside AS (SELECT batch_no, count(*) AS input_rows, count(failure_stage) AS aside, count(*) FILTER (WHERE route = 'ok') AS ok
  FROM routed GROUP BY batch_no),
reasons AS (SELECT batch_no, string_agg(refused || '=' || n, ',' ORDER BY refused) AS failure_reasons
  FROM (SELECT batch_no, refused, count(*) AS n FROM delivered WHERE refused IS NOT NULL GROUP BY ALL) GROUP BY batch_no)"""
ORACLE["stream_delivery"] = _with(_DELIVERED, """SELECT CAST(batch_no AS BIGINT) AS batch_id, any_value(input_rows) AS input_rows,
    any_value(aside) + count(refused) AS dlq, any_value(ok) AS rows_written, count(refused) AS failures_exhausted,
    CAST(coalesce(sum(tries - 1) FILTER (WHERE refused IS NULL), 0) AS BIGINT) AS retries_before_success,
    count(d.id) FILTER (WHERE refused IS NULL) AS retried_writes, coalesce(any_value(failure_reasons), '') AS failure_reasons
    FROM aside LEFT JOIN delivered d USING (batch_no) LEFT JOIN reasons USING (batch_no) GROUP BY batch_no""")
ORACLE["stream_delivery_dlq"] = _with(_DELIVERED, """SELECT CAST(batch_no AS BIGINT) AS batch_id, event_id, CAST(tries AS INTEGER) AS retry_count,
    CASE WHEN refused = 'InvalidRequest' THEN 'InvalidRequest: refused' ELSE 'WriteTimeout: slow' END || ': external' AS failure_reason,
    "partition" AS source_partition, "offset" AS source_offset FROM delivered WHERE refused IS NOT NULL""")
ORACLE["stream_delivery_ledger"] = _with(_DELIVERED, """SELECT CAST(batch_no AS BIGINT) AS batch_id, count(*) AS outcomes, count(*) AS events,
    count(*) FILTER (WHERE refused IS NULL) AS succeeded, CAST(sum(tries) AS BIGINT) AS attempts, 0 AS last_try,
    true AS waits_not_below, true AS waits_not_above, true AS jittered FROM delivered GROUP BY batch_no""")
ORACLE["stream_lag"] = _with(LOG, """SELECT CAST(n AS BIGINT) AS batch_id, total AS slices_landed, n + 1 AS slices_taken, total - n - 1 AS slices_behind
    FROM (SELECT batch_no, row_number() OVER (ORDER BY batch_no) - 1 AS n, count(*) OVER () AS total FROM log GROUP BY batch_no)""")
ORACLE["lag_samples"] = _with(LOG + """,
counts AS (SELECT batch_no, "partition", count(*) AS n FROM log GROUP BY 1, 2),
behind AS (SELECT *, CAST(sum(n) OVER (PARTITION BY "partition") - sum(n) OVER (PARTITION BY "partition" ORDER BY batch_no) AS BIGINT) AS b FROM counts)""",
    """SELECT 'trips.raw' AS topic, batch_no AS batch_id, max(b) AS max_offsets_behind, min(b) AS min_offsets_behind,
    round(avg(b), 3) AS avg_offsets_behind FROM behind GROUP BY batch_no""")

# -- streams -----------------------------------------------------------------------

ORACLE["stream_ingest"] = _with(ROUTED, f"""SELECT trip_id, event_id, event_time, (epoch_us(ts) // 1000) AS produced_at_ms, city_id, driver_id,
    rider_id, pickup_zone_id, dropoff_zone_id, {_MEASURES}, 'producer-1' AS producer_id, 1 AS schema_version FROM sound""")
ORACLE["stream_late_quarantine"] = _with(ROUTED, """SELECT batch_no AS batch_id, event_id, "partition" AS source_partition,
    "offset" AS source_offset, failure_reason, payload AS original_payload FROM routed WHERE route = 'late'""")
ORACLE["stream_batch_report"] = _with(ROUTED, """
SELECT batch_no AS batch_id, count(*) AS input_rows, count(*) FILTER (WHERE unparseable) AS unparseable,
  count(*) FILTER (WHERE route = 'invalid') AS invalid, count(*) FILTER (WHERE route = 'late') AS late,
  count(*) FILTER (WHERE failure_stage IS NOT NULL) AS dlq, 3 * count(*) FILTER (WHERE route = 'ok') AS rows_written,
  max(max(event_time)) OVER (ORDER BY batch_no) AS max_event_time FROM routed GROUP BY batch_no""")
ORACLE["stream_restart"] = _with(ROUTED, """
SELECT unnest(['trips_by_id', 'trips_by_driver_day', 'trips_by_city_hour']) AS table_name, count(*) AS rows,
  count(DISTINCT event_id) AS events FROM sound
UNION ALL SELECT 'quarantine', count(*), count(DISTINCT CASE WHEN NOT unparseable THEN event_id END) FROM routed WHERE failure_stage IS NOT NULL""")
ORACLE["stream_dedup"] = _with(LOG, """SELECT DISTINCT event_id, trip_id, event_time, city_id, driver_id, fare_amount, status
    FROM parsed WHERE event_time IS NOT NULL""")
ORACLE["stream_city_rollup"] = _with(LOG, f"""SELECT city_id, {_WINDOWS}, count(DISTINCT driver_id) AS drivers, true AS within_bound FROM parsed
    WHERE event_time IS NOT NULL AND status = 'completed' GROUP BY 1, 2, 3""")
