"""Invariants of routing, serving tables, quarantine and drains."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tallyport.operators import fanout, parse, quarantine, reconcile, upsert
from tallyport.operators.retry import RetryPolicy
from tallyport.plans import drain as drains
from tallyport.plans import rollup
from tallyport.sources.raw_log import publish_files, read_raw, read_raw_stream
from tallyport.sources.schemas import RAW_SCHEMA, SERVING_TABLES
from tallyport.streaming.ingest import IngestJob

NOON = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)


def uid(n):
    return f"00000000-0000-4000-8000-{n:012x}"


def event(n, at=NOON, **changes):
    body = {
        "event_id": uid(n), "trip_id": uid(1000 + n), "event_time": at.strftime("%Y-%m-%dT%H:%M:%S.000Z"),
        "produced_at_ms": int(at.timestamp() * 1000), "city_id": "nyc", "driver_id": f"d-{n % 3:06d}",
        "rider_id": "r-1", "distance_km": 2.5, "duration_sec": 60, "fare_amount": 10.0, "surge_multiplier": 1.0,
        "status": "completed", "producer_id": "p", "schema_version": 1, "extra": "ignored",
    }
    return json.dumps({k: v for k, v in {**body, **changes}.items() if v is not ...})


def log(spark, values, first_offset=0):
    rows = [("k", v, "trips.raw", 0, first_offset + i, NOON, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def land(job, log_path, values, first_offset):
    publish_files(log(job.spark, values, first_offset).coalesce(1), log_path)
    job.run_available(read_raw_stream(job.spark, log_path))


def counts(spark, root):
    return {name: fanout.read_serving(spark, root, name).count() for name in SERVING_TABLES}


def routes(spark, values, cutoff=None, policy="dlq"):
    df = parse.classify(parse.parse(log(spark, values)), F.lit(cutoff).cast("timestamp"), policy)
    return {r["_offset"]: (r["route"], r["failure_reason"]) for r in df.collect()}


def test_each_record_has_one_route(spark):
    late = NOON - timedelta(hours=1)
    values = [
        event(0), event(1)[:40], "nonsense", None, event(2, at=late), event(3, event_time="yesterday"),
        event(4, fare_amount=None), event(5, event_id=...), event(6, trip_id=""), event(7, city_id=None),
        event(8, produced_at_ms="x"), event(9, trip_id="not-a-uuid"), event(10, driver_id=""),
    ]
    got = routes(spark, values, NOON - timedelta(minutes=2))
    assert len(got) == len(values)
    assert [got[i][0] for i in range(len(values))] == [
        "ok", "unparseable", "unparseable", "unparseable", "late", "invalid", "invalid", "unparseable", "invalid",
        "invalid", "invalid", "invalid", "invalid",
    ]
    assert got[5][1] == "PermanentDefect: missing required field 'event_time'"
    assert got[4][1].startswith("LateEvent: event_time older than watermark 2024-05-01T11:58:00")


def test_event_without_time_is_not_lost_beside_late_events(spark):
    values = [event(1, at=NOON - timedelta(hours=1)), event(2, event_time=None)]
    got = routes(spark, values, NOON)
    assert (got[0][0], got[1][0]) == ("late", "invalid")


@pytest.mark.parametrize("policy,route", [("process", "ok"), ("dlq", "late"), ("drop", "dropped")])
def test_late_policies(spark, policy, route):
    assert routes(spark, [event(1, at=NOON - timedelta(hours=1))], NOON, policy)[0][0] == route


def test_cutoff_is_strict(spark):
    assert routes(spark, [event(1)], NOON)[0][0] == "ok"
    assert routes(spark, [event(1)], NOON + timedelta(seconds=1))[0][0] == "late"


def test_replay_changes_nothing_and_a_new_event_adds_one_row(spark, folder):
    job, raw = IngestJob(spark, folder, sample_rate=1.0), f"{folder}/raw"
    values = [event(n, at=NOON + timedelta(seconds=n)) for n in range(20)]
    land(job, raw, values, 0)
    before = counts(spark, folder)
    assert set(before.values()) == {20}
    land(job, raw, values, 20)
    assert counts(spark, folder) == before
    land(job, raw, [event(99, at=NOON + timedelta(seconds=30))], 40)
    assert counts(spark, folder) == {name: 21 for name in before}
    assert [r["batch_id"] for r in job.reports().orderBy("batch_id").collect()] == [0, 1, 2]
    assert job.spark.read.parquet(job.path("latency_samples")).count() == 41


def test_last_write_wins(spark, folder):
    job, raw = IngestJob(spark, folder), f"{folder}/raw"
    land(job, raw, [event(1, fare_amount=1.0), event(1, fare_amount=2.0)], 0)
    assert fanout.read_serving(spark, folder, "trips_by_id").first()["fare_amount"] == 2.0
    land(job, raw, [event(1, fare_amount=3.0, trip_id=uid(1001).upper())], 2)
    rows = fanout.read_serving(spark, folder, "trips_by_id").collect()
    assert [r["fare_amount"] for r in rows] == [3.0]


def test_high_water_survives_a_restart(spark, folder):
    raw = f"{folder}/raw"
    land(IngestJob(spark, folder), raw, [event(1)], 0)
    again = IngestJob(spark, folder)
    land(again, raw, [event(2, at=NOON - timedelta(minutes=10)), event(3)], 1)
    reports = {r["batch_id"]: r for r in again.reports().collect()}
    assert (reports[1]["late"], reports[1]["dlq"], reports[1]["rows_written"]) == (1, 1, 3)
    again.process(log(spark, [event(2, at=NOON - timedelta(minutes=10)), event(3)], 1), 1)
    kept = quarantine.read_quarantine(spark, again.path("quarantine"))
    assert [(r["failure_stage"], r["event_id"]) for r in kept.collect()] == [("late_event", uid(2))]


def test_nothing_is_lost(spark, folder):
    job, raw = IngestJob(spark, folder), f"{folder}/raw"
    land(job, raw, [event(1), "broken", event(2, fare_amount=None), event(1)], 0)
    land(job, raw, [event(3, at=NOON - timedelta(hours=2)), event(4)], 4)
    parsed = parse.parse(read_raw(spark, raw))
    written = fanout.read_serving(spark, folder, "trips_by_id")
    held = quarantine.read_quarantine(spark, job.path("quarantine"))
    row = reconcile.reconcile_totals(reconcile.follow(parsed, written, held)).first()
    assert (row["messages_persisted"], row["duplicates"], row["expected_distinct"]) == (6, 1, 5)
    assert (row["written_distinct"], row["quarantined_distinct"], row["unaccounted"]) == (2, 3, 0)
    # A lost event shows even when another one is counted on both sides.
    less = written.where(F.col("event_id") != uid(1))
    twice = held.unionByName(held.where("failure_stage = 'late_event'").withColumn("event_id", F.lit(uid(4))))
    followed = reconcile.follow(parsed, less, twice)
    row = reconcile.reconcile_totals(followed).first()
    assert (row["unaccounted"], row["partial_write_overlap"]) == (1, 1)
    assert [r["identity"] for r in reconcile.lost(followed).collect()] == [uid(1)]


def test_external_store_failures_are_quarantined(spark, folder):
    def always_down(batch):
        return ["NoHostAvailable: down" if e.endswith("2") else None for e in batch["event_id"]]

    job = IngestJob(spark, folder, external_write=always_down, retry_policy=RetryPolicy(schedule_ms=()))
    land(job, f"{folder}/raw", [event(1), event(2), event(3)], 0)
    held = quarantine.read_quarantine(spark, job.path("quarantine")).collect()
    assert [(r["failure_stage"], r["event_id"], r["retry_count"]) for r in held] == [("cassandra_sink", uid(2), 4)]
    report = job.reports().first()
    assert report["failures_exhausted"] == 1


def envelope(spark, rows):
    df = spark.createDataFrame(rows, "payload string, reason string, stage string, retries int, off long, replays int")
    return quarantine.envelope(
        df, F.col("payload"), F.col("reason"), F.col("stage"), F.col("retries"), F.lit(0),
        topic=F.lit("trips.raw"), partition=F.lit(0), offset=F.col("off"), replay_count=F.col("replays"),
    )


def records(spark):
    return envelope(
        spark,
        [
            (event(1), "WriteTimeout: slow", "cassandra_sink", 4, 1, 0),
            (event(2), "KafkaException: gone", "producer", 4, 2, 1),
            (event(3), "LateEvent: old", "late_event", 0, 3, 0),
            ("broken", "JsonParseError: x", "parse", 0, 4, 0),
            (event(5), "WriteTimeout: slow", "cassandra_sink", 4, 5, 3),
            (event(6), "odd", "unknown_stage", 0, 6, 0),
        ],
    )


def run_drain(spark, folder, rows, drain_id, **options):
    return drains.drain(
        spark, rows, folder, drain_id, "trips.raw", f"{folder}/raw", folder, partitions=6, **options
    ).first()


def test_drain_accounts_for_everything_once(spark, folder):
    rows = records(spark)
    dry = run_drain(spark, folder, rows, 10_000, dry_run=True)
    assert (dry["records_read"], dry["reinjected"], dry["direct_written"], dry["parked"]) == (6, 2, 1, 3)
    done = run_drain(spark, folder, rows, 10_000)
    assert (done["records_read"], done["accounted_for"], done["unaccounted"]) == (6, 6, 0)
    sent = {r["key"]: (r["value"], r["replay_count"]) for r in read_raw(spark, f"{folder}/raw").collect()}
    assert sent == {uid(1001): (event(1), 1), uid(1002): (event(2), 2)}
    assert counts(spark, folder) == {name: 1 for name in SERVING_TABLES}
    parked = spark.read.json(f"{folder}/parked").select("why").collect()
    assert sorted(r[0] for r in parked) == [
        "replay_count >= 3", "stage 'parse' is not automatically recoverable",
        "stage 'unknown_stage' is not automatically recoverable",
    ]
    assert run_drain(spark, folder, rows, 10_001)["records_read"] == 0


def test_replays_end_at_the_ceiling(spark):
    one = envelope(spark, [(event(1), "r", "cassandra_sink", 4, 1, 2)])
    again = quarantine.reinject(quarantine.route(one), "trips.raw").first()
    assert again["replay_count"] == 3
    spent = envelope(spark, [(again["value"], "r", "cassandra_sink", 4, 9, again["replay_count"])])
    assert quarantine.route(spent).first()["action"] == "park"


def test_breaker(spark, folder):
    with pytest.raises(RuntimeError):
        run_drain(spark, folder, records(spark), 1, breaker=5)


def test_failed_records_are_parked_and_not_lost(spark, folder):
    late_without_fare = json.loads(event(5)) | {"fare_amount": None}
    rows = envelope(spark, [
        (json.dumps(late_without_fare), "r", "late_event", 0, 1, 0), ("junk", "r", "producer", 4, 2, 0),
        (event(6), "r", "late_event", 0, 3, 0),
    ])
    done = run_drain(spark, folder, rows, 0)
    assert (done["records_read"], done["direct_written"], done["direct_write_failed"], done["reinject_failed"]) == (3, 1, 1, 1)
    parked = {r["failure_stage"]: r["why"] for r in spark.read.json(f"{folder}/parked").collect()}
    assert parked == {"late_event": "PermanentDefect: fare_amount is null", "producer": "payload is not readable"}


def test_totals_of_nothing_are_zero(spark, folder):
    done = run_drain(spark, folder, records(spark).limit(0), 0)
    assert set(done.asDict().values()) == {0}


def test_drain_and_stream_do_not_share_folders(spark, folder):
    rows = envelope(spark, [(event(7), "r", "late_event", 0, 1, 0)])
    run_drain(spark, folder, rows, 0)
    first = fanout.read_serving(spark, folder, "trips_by_id").first()
    newer = quarantine.writable(quarantine.direct_events(quarantine.route(rows))).withColumn("fare_amount", F.lit(77.0))
    fanout.write_serving(fanout.fanout(newer, quarantine.now_ms(), latest=False), folder, 0)
    now = fanout.read_serving(spark, folder, "trips_by_id").collect()
    assert [r["trip_id"] for r in now] == [first["trip_id"]] and now[0]["fare_amount"] == 77.0


def test_reinjected_messages_continue_the_log(spark, folder):
    run_drain(spark, folder, envelope(spark, [(event(n), "r", "producer", 4, n, 0) for n in range(20)]), 0)
    run_drain(spark, folder, envelope(spark, [(event(n), "r", "producer", 4, n, 0) for n in range(20, 40)]), 1)
    sent = read_raw(spark, f"{folder}/raw").collect()
    places = [(r["partition"], r["offset"]) for r in sent]
    assert len(set(places)) == 40 and len({p for p, _ in places}) > 1 and None not in {o for _, o in places}


def test_high_water_after_reports_have_gone(spark, folder):
    job = IngestJob(spark, folder)
    report = spark.sql("SELECT 3L AS batch_id, timestamp'2024-01-08 12:00:00' AS max_event_time")
    report.write.json(f"{folder}/reports/batch_id=3")
    assert job.high_water(5000).timestamp() == job.high_water(3).timestamp()
    assert job.high_water(2) is None and job.high_water(-1) is None
    spark.createDataFrame([("broken {",)], "value string").write.text(f"{folder}/reports/batch_id=4")
    with pytest.raises(Exception):
        job.high_water(4)


def test_reasons_and_payloads_stay_whole(spark):
    row = envelope(spark, [("x" * 50_000, "r" * 3000, "parse", 0, 1, 0)]).first()
    assert (len(row["failure_reason"]), len(row["original_payload"])) == (3000, 50_000)


def test_envelope_reader_is_tolerant(spark):
    good = json.dumps({"original_payload": "p", "failure_stage": "parse", "unknown": 1})
    df = spark.createDataFrame([(good,), ("junk",)], "value string")
    got = {r["original_payload"]: r for r in quarantine.read_envelope_messages(df).collect()}
    assert (got["p"]["failure_stage"], got["p"]["retry_count"], got["p"]["replay_count"]) == ("parse", 0, 0)
    assert got["junk"]["failure_stage"] == "unreadable_dlq_record"


def test_upsert_partitions_touches_only_its_partitions(spark, folder):
    base = spark.createDataFrame([(1, "a", 0), (2, "a", 0), (3, "b", 0), (4, "c", 0)], "id int, part string, version int")
    path = f"{folder}/table"
    base.write.partitionBy("part").parquet(path)
    new = spark.createDataFrame([(2, "a", 1), (5, "c", 1)], "id int, part string, version int")
    for n in range(2):
        upsert.upsert_partitions(spark, path, f"{folder}/staged-{n}", new, ["id"], ["version"], "part")
        got = {tuple(r) for r in spark.read.parquet(path).select("id", "part", "version").collect()}
        assert got == {(1, "a", 0), (2, "a", 1), (3, "b", 0), (4, "c", 0), (5, "c", 1)}


def test_keyed_reads(spark, folder):
    land(IngestJob(spark, folder), f"{folder}/raw", [event(n, at=NOON + timedelta(minutes=40 * n)) for n in range(6)], 0)
    found = fanout.trip_lookup(spark, folder, spark.createDataFrame([(uid(1002),)], "trip_id string"))
    assert [r["event_id"] for r in found.collect()] == [uid(2)]
    one = fanout.trip_lookup(spark, folder, [uid(1004)])
    assert [r["event_id"] for r in one.collect()] == [uid(4)]
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "key_bucket#" in scan.split("PartitionFilters: [")[1].split("]")[0]
    mine = fanout.driver_day(spark, folder, "d-000000", "2024-05-01").collect()
    assert [r["event_id"] for r in mine] == [uid(3), uid(0)]
    hour = fanout.city_hour(spark, folder, "nyc", "2024-05-01 13:00:00").collect()
    assert [r["event_id"] for r in hour] == [uid(2)]


def test_backfill_plan():
    start = datetime(2024, 1, 1)
    assert rollup.plan_backfill(start, start + timedelta(hours=336)) == 336
    for end in (start, start + timedelta(hours=337)):
        with pytest.raises(ValueError):
            rollup.plan_backfill(start, end)


def test_rollup_defaults(spark):
    df = spark.createDataFrame(
        [(None, None, None, None), (1.0, 2, 3.0, 0.0)],
        "distance_km double, duration_sec int, fare_amount double, surge_multiplier double",
    )
    assert [tuple(r) for r in rollup.with_defaults(df).collect()] == [(0.0, 0, 0.0, 1.0), (1.0, 2, 3.0, 1.0)]


def test_a_second_failure_of_an_event_is_not_taken_for_drained(spark, folder):
    def failed(at):
        df = spark.createDataFrame([(event(2), "trips.raw")], "value string, topic string")
        return quarantine.from_producer(df, "KafkaException: gone", 4, F.lit(at))

    assert run_drain(spark, folder, failed(1), 10)["reinjected"] == 1
    assert run_drain(spark, folder, failed(1), 11)["records_read"] == 0
    assert run_drain(spark, folder, failed(2), 12)["reinjected"] == 1


def test_lag_counts_partitions_a_batch_left_alone(spark):
    from tallyport.operators.telemetry import lag_samples

    df = spark.createDataFrame(
        [("t", 0, 0, 5), ("t", 1, 1, 7), ("t", 0, 2, 1)], "topic string, partition int, batch_id long, rows long"
    )
    got = {r["batch_id"]: (r["max_offsets_behind"], r["min_offsets_behind"]) for r in lag_samples(df, ["topic"]).collect()}
    assert got == {0: (7, 1), 1: (1, 0), 2: (0, 0)}


def test_bad_report_lines_are_skipped(spark, folder):
    from tallyport.operators.telemetry import read_reports

    lines = ['{"run_id": "r", "batch_id": 0, "input_rows": 3, "failure_reasons": {"E": 2}}', "{oops", '{"batch_id": "x"}']
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(f"{folder}/reports")
    rows = read_reports(spark, f"{folder}/reports").select("run_id", "batch_id", "input_rows", "failure_reasons").collect()
    assert [tuple(r) for r in rows] == [("r", 0, 3, {"E": 2})]
