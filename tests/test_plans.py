"""Shape of the physical plans: what must and must not be in them."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tallyport.operators import latency, parse
from tallyport.plans import questions
from tallyport.registry import runs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


STREAMS = {n for n in queries() if n.startswith("stream_")}


@pytest.mark.parametrize("name", sorted(set(queries()) - STREAMS))
def test_no_cross_join_and_no_python(name, spark, sf_dir):
    text = plan(queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "RDDScan"):
        assert node not in text


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    house = runs.trip_house(spark, sf_dir)
    window = ("1997-01-01", "1998-01-01")
    wide = plan(questions.q1_wide(house.window("trips_wide", *window), *window))
    assert "PushedFilters: [IsNotNull(status), IsNotNull(event_time), EqualTo(status,completed)" in wide
    assert "PartitionFilters: [isnotnull(period" in wide
    assert "ReadSchema: struct<event_time:timestamp,region:string,fare_amount:decimal(12,2),status:string>" in wide
    star = plan(questions.q1_star(house.window("fact_trip", *window), house.dims(), *window))
    assert "GreaterThanOrEqual(date_key,19970101)" in star and "BroadcastHashJoin" in star


def test_latest_row_is_pruned_before_the_shuffle(spark, sf_dir):
    text = plan(queries()["rollup_partial_upsert"](spark, sf_dir))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_hot_series_is_not_one_window_partition(spark, sf_dir):
    text = plan(queries()["longest_rising_run"](spark, sf_dir))
    assert "hashpartitioning(run_id" in text and "_bucket" in text


def test_sampling_is_repeatable(spark):
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("event_id"))
    chosen = ids.where(latency.sampled(F.col("event_id"), F.lit("run"), 0.05))
    first = {r[0] for r in chosen.collect()}
    assert 800 < len(first) < 1200
    assert first == {r[0] for r in chosen.repartition(3).collect()}


def test_cutoffs_are_broadcast_only_when_small(spark, sf_dir):
    from tallyport import session

    small = parse.batch_cutoffs(runs.parsed(spark, sf_dir), 120)
    assert "broadcast" in session.small_side(small)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in session.small_side(small, 1)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in session.small_side(small, max_bytes=8)._jdf.queryExecution().logical().toString()
