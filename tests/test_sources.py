"""The views of the given tables: their rows are shared out by number, whatever the files."""

from datetime import datetime, timedelta

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tallyport.operators import parse, quarantine
from tallyport.plans import drain, star
from tallyport.registry import runs
from tallyport.sources import adapters, raw_log, tables
from tallyport.sources.schemas import RAW_SCHEMA


def write_events(spark, folder, rows):
    """Events in one file of one row group."""
    start = datetime(2024, 1, 1)
    made = [(n, start + timedelta(minutes=n), n % 7, "view", float(n), f'{{"k": {n % 90}}}') for n in range(rows)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(made, schema).coalesce(1).write.parquet(f"{folder}/events.parquet")


def test_one_row_group_is_worked_on_by_many_tasks(spark, folder, monkeypatch):
    write_events(spark, folder, 400)
    whole = adapters.raw_events(spark, folder)
    assert whole.rdd.getNumPartitions() == 1
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 50)
    dealt = adapters.raw_events(spark, folder, 0)
    each = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(each) == 8 and max(each) <= 70
    assert sorted(dealt.collect()) == sorted(whole.collect())
    assert adapters.write_attempts(spark, folder, ["a"]).rdd.getNumPartitions() == 8


def test_files_of_a_slice_grow_with_the_smallest_slice(spark, folder):
    assert runs.files_for([]) == runs.files_for([9, 10**9]) == runs.SLICE_FILES
    assert runs.files_for([500_000, 400_000]) == 8


def test_a_large_file_of_the_log_is_cut_into_row_groups(spark, folder, monkeypatch):
    monkeypatch.setattr(raw_log, "ROW_GROUP_BYTES", 64 << 10)
    text = F.concat_ws("-", *[F.sha2(F.col("id").cast("string"), 512)] * 4)
    rows = spark.range(4000).coalesce(1).select(
        F.col("id").cast("string").alias("key"), text.alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.col("id").alias("offset"), F.current_timestamp().alias("timestamp"), F.lit(0).alias("replay_count"),
    )
    raw_log.publish_files(rows, folder)
    (file,) = [f.removeprefix("file://").removeprefix("file:") for f in spark.read.parquet(folder).inputFiles()]
    assert pq.ParquetFile(file).num_row_groups > 3
    assert raw_log.read_raw(spark, folder).count() == 4000


def test_lines_are_moved_and_trips_made_of_them_where_they_are_written(spark, sf_dir):
    lines = adapters.trip_lines(spark, sf_dir)
    assert not {"trip_id", "event_id", "driver_id", "status"} & set(lines.columns)
    house = star.load(spark, lines, 1, star.TRIP_LABELS, "1992-01-01", "1999-01-01", "t", adapters.trip_time(), adapters.trip_columns())
    whole = adapters.trips(spark, sf_dir)
    wide = house.wide.select(*whole.columns)
    assert wide.columns == adapters.WIDE_COLUMNS and house.wide.columns[-1] == "period"
    assert wide.exceptAll(whole).count() == whole.exceptAll(wide).count() == 0


def test_messages_are_sorted_in_ranges_of_their_number(spark, monkeypatch):
    monkeypatch.setattr(drain, "ROWS_PER_RANGE", 20)
    rows = spark.range(200).select(
        F.concat(F.lit("k"), "id").alias("key"), F.lit("v").alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("replay_count")
    )
    placed = drain.next_messages(rows, spark.createDataFrame([], RAW_SCHEMA), 3)
    assert len(placed.inputFiles()) >= 8
    got = placed.orderBy("partition", "key").select("offset").collect()
    assert [r["offset"] for r in got] == list(range(200))


def test_rows_are_dealt_evenly_and_without_a_sort_whatever_their_ids(spark, folder, monkeypatch):
    spark.range(400).selectExpr("CAST(NULL AS BIGINT) AS event_id").coalesce(1).write.parquet(folder)
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 50)
    rows = tables.dealt(spark.read.parquet(folder))
    assert rows.columns == ["event_id"]
    assert "RoundRobin" not in rows._jdf.queryExecution().executedPlan().toString()
    each = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(each) == 400 and len(each) == 8 and max(each) <= 80


def test_a_log_is_parsed_once_for_its_cutoffs_and_its_routes(spark, folder, monkeypatch):
    write_events(spark, folder, 20_000)
    seen, batch_cutoffs = [], parse.batch_cutoffs

    def watched(rows, lateness):
        seen.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return batch_cutoffs(rows, lateness)

    monkeypatch.setattr(parse, "batch_cutoffs", watched)
    found = runs.classified(spark, folder)
    assert seen and not any("from_json" in plan for plan in seen)
    whole = parse.classify_log(runs.parsed(spark, folder))
    assert found.columns == whole.columns
    assert found.where("route = 'late'").count() > 0
    assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty()


def test_only_records_of_failed_writes_are_moved_for_their_first_one(spark, folder, monkeypatch):
    write_events(spark, folder, 20_000)
    seen, dedup = [], parse.dedup

    def watched(rows):
        seen.append(rows.count())
        return dedup(rows)

    monkeypatch.setattr(parse, "dedup", watched)
    sunk = runs.quarantined(spark, folder).where("failure_stage = 'cassandra_sink'")
    failed = {r["event_id"] for r in runs.exhausted(spark, folder).collect()}
    sound = runs.sound_events(spark, folder)
    wanted = sound.where(F.col("event_id").isin(*failed))
    assert failed and seen == [wanted.count()] and seen[0] < sound.count()
    kept = dedup(sound).where(F.col("event_id").isin(*failed)).select("event_id", F.col("_offset").alias("source_offset"))
    found = sunk.select("event_id", "source_offset")
    assert found.exceptAll(kept).isEmpty() and kept.exceptAll(found).isEmpty()
    monkeypatch.setattr(quarantine, "CONCERNED_ROWS", 1)
    assert quarantine.concerned(sound, runs.exhausted(spark, folder)).count() == seen[0]
