"""Serving tables that are compacted beside their stream."""

from datetime import datetime, timedelta

import pytest
from test_ingest import NOON, event, land, uid

from tallyport.operators import compaction, fanout
from tallyport.sources.files import Storage
from tallyport.sources.schemas import SERVING_TABLES
from tallyport.streaming.ingest import IngestJob

TABLE = "trips_by_id"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def fares(spark, root):
    return {r["event_id"]: r["fare_amount"] for r in fanout.read_serving(spark, root, TABLE).collect()}


def landed(spark, folder, batches, **options):
    """A stream of `batches` batches: one trip that each of them changes, and one of its own."""
    job, raw = IngestJob(spark, folder, **options), f"{folder}/raw"
    for n in range(batches):
        land(job, raw, [event(1, fare_amount=float(n)), event(10 + n)], 2 * n)
    return job


def test_levels(spark, folder):
    """Deltas go into runs and runs into higher ones; readers see the last write all the while."""
    job, seen = landed(spark, folder, 0), []
    for n in range(9):
        land(job, f"{folder}/raw", [event(1, fare_amount=float(n)), event(10 + n)], 2 * n)
        now = fanout.compact_serving(spark, folder, [TABLE], fan_in=2)[TABLE]
        seen.append(sorted(now.runs.values()))
        assert fares(spark, folder) == {uid(1): float(n), **{uid(10 + k): 10.0 for k in range(n + 1)}}
    assert seen == [[], [1], [1], [2], [2], [1, 2], [1, 2], [3], [3]]
    assert len(compaction.live(spark, f"{folder}/{TABLE}")) == 2


def test_stream_compacts_between_batches(spark, folder):
    job = landed(spark, folder, 6, compact_every=2, fan_in=2)
    for name in SERVING_TABLES:
        now = compaction.manifest(spark, job.path(name))
        assert len(now.replaced) == 6 and sorted(now.runs.values()) == [1, 2]
        assert fanout.read_serving(spark, folder, name).count() == 7
    assert fares(spark, folder)[uid(1)] == 5.0


def test_a_batch_run_again_changes_nothing(spark, folder):
    from test_ingest import log

    job = landed(spark, folder, 2, compact_every=2, fan_in=2)
    before = fares(spark, folder)
    job.process(log(spark, [event(1, fare_amount=1.0), event(11)], 2), 1)
    assert fares(spark, folder) == before
    # The batch counts again, as it may hold other rows than those that were merged.
    assert "writer=stream/write_id=1" in compaction.live(spark, job.path(TABLE))
    job.process(log(spark, [event(77)], 9), 1)
    assert set(fares(spark, folder)) == {*before, uid(77)}


def test_reader_of_before_a_swap_finishes(spark, folder):
    landed(spark, folder, 4)
    begun = fanout.read_serving(spark, folder, TABLE)
    fanout.compact_serving(spark, folder, fan_in=2)
    path = f"{folder}/{TABLE}"
    assert compaction.vacuum(spark, path, 0) == [] and begun.count() == 5
    gone = compaction.vacuum(spark, path, 2**62)
    assert [g for g in gone if g.startswith("writer=stream")] == [f"writer=stream/write_id={n}" for n in range(4)]
    assert fares(spark, folder) == {uid(1): 3.0, **{uid(10 + n): 10.0 for n in range(4)}}
    now = compaction.manifest(spark, path)
    assert now.replaced == {} and compaction.live(spark, path) == list(now.runs)
    assert compaction.vacuum(spark, path, 0) == []


def test_two_compactions_at_a_time(spark, folder, monkeypatch):
    """The second to publish starts again; its run is an orphan that the next clean-up takes."""
    landed(spark, folder, 4)
    path, inner = f"{folder}/{TABLE}", []
    whole = compaction.change

    def raced(spark, where, make):
        if where == path and not inner:
            inner.append(1)
            fanout.compact_serving(spark, folder, [TABLE], fan_in=4)
        return whole(spark, where, make)

    monkeypatch.setattr(compaction, "change", raced)
    fanout.compact_serving(spark, folder, [TABLE], fan_in=4)
    now = compaction.manifest(spark, path)
    assert list(now.runs.values()) == [1] and now.version == 1
    assert fares(spark, folder) == {uid(1): 3.0, **{uid(10 + n): 10.0 for n in range(4)}}
    assert len([g for g in compaction.vacuum(spark, path, 2**62) if "compacted" in g]) == 1


def test_versions_are_created_once(spark, folder):
    storage = Storage(spark, folder)
    assert storage.create("_manifest/v1.json", "a") and not storage.create("_manifest/v1.json", "b")
    assert storage.read("_manifest/v1.json") == "a" and list(storage.matching("_manifest/*")) == ["_manifest/v1.json"]


@pytest.mark.parametrize("later", [3, 64])
def test_bucket_number_is_the_tables(spark, folder, later):
    """Folders of several bucket numbers are read together, and lookups still leave folders out."""
    path = f"{folder}/{TABLE}"
    compaction.set_buckets(spark, path, 5)
    job = landed(spark, folder, 2)
    compaction.set_buckets(spark, path, later)
    land(job, f"{folder}/raw", [event(20), event(1, fare_amount=9.0)], 4)
    assert set(compaction.read_live(spark, path).select("buckets").distinct().toPandas()["buckets"]) == {5, later}
    one = fanout.trip_lookup(spark, folder, [uid(1001), uid(1020), uid(1999)])
    assert {r["event_id"]: r["fare_amount"] for r in one.collect()} == {uid(1): 9.0, uid(20): 10.0}
    assert "key_bucket#" in plan(one).split("PartitionFilters: [")[1].split("ReadSchema")[0].split("PushedFilters")[0]
    many = fanout.trip_lookup(spark, folder, spark.createDataFrame([(uid(1001),), (uid(1010),)], "trip_id string"))
    assert {r["event_id"] for r in many.collect()} == {uid(1), uid(10)}
    fanout.compact_serving(spark, folder, [TABLE], fan_in=2)
    assert set(compaction.read_live(spark, path).select("buckets").distinct().toPandas()["buckets"]) == {later}
    assert len(fares(spark, folder)) == 4


def test_hours_are_pruned(spark, folder):
    landed(spark, folder, 2)
    day = datetime(2024, 5, 1)
    rows = fanout.city_hours(spark, folder, day + timedelta(hours=12), day + timedelta(hours=13), ["nyc"])
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    text = plan(rows)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "event_date" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(event_hour" in text and "EqualTo(city_id,nyc)" in text
    assert rows.count() == 3 and NOON.hour == 12
    assert fanout.city_hours(spark, folder, day, day + timedelta(hours=12)).count() == 0


def test_nothing_to_compact(spark, folder):
    landed(spark, folder, 1)
    assert fanout.compact_serving(spark, folder, fan_in=2) == {name: compaction.Manifest() for name in SERVING_TABLES}
