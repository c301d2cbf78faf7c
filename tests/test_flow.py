"""The hourly load as one flow: resumed after any step, ended by a drift, never doubled."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_ingest import NOON, event, land
from test_plans import plan

from tallyport.operators import fanout
from tallyport.plans import flow as flows
from tallyport.plans import rollup
from tallyport.registry import runs
from tallyport.streaming.ingest import IngestJob

DAY = datetime(2024, 5, 1)
END = DAY + timedelta(days=1)


def later():
    return F.lit("2024-05-02").cast("timestamp")


class Died(Exception):
    pass


@pytest.fixture
def served(spark, folder):
    land(IngestJob(spark, folder), f"{folder}/raw", [event(n, at=NOON + timedelta(minutes=25 * n), fare_amount=float(n)) for n in range(8)], 0)
    return folder


def names(flow):
    return [(r["attempt"], r["name"]) for r in flow.markers().orderBy("attempt", "step").collect()]


def held(flow):
    return sorted((r["trip_id"][-3:], r["fare_amount"]) for r in flow.stage().collect())


@pytest.mark.parametrize("step", flows.STEPS[:4])
def test_resumes_after_its_last_marker(spark, served, step):
    made = []

    def write(rows, path, load_id):
        made.append(load_id)
        rollup.write_load(rows, path, load_id)

    def die(name):
        if name == step:
            raise Died

    with pytest.raises(Died):
        flows.RollupFlow(spark, served, f"{served}/rollup", write=write, after=die).run("a", DAY, END, later())
    assert names(flows.RollupFlow(spark, served, f"{served}/rollup"))[-1] == (0, step)
    flow = flows.RollupFlow(spark, served, f"{served}/rollup", write=write)
    assert flow.run("a", DAY, END, later()) == "closed"
    assert names(flow) == [(0, n) for n in ("planned", "extracted", "loaded", "verified", "closed")]
    assert made == [0] and len(held(flow)) == 8
    row = flow.audit().first()
    assert (row["state"], row["rows_loaded"], row["notes"]) == ("closed", 8, "24h window, 21 empty hours")
    assert flow.run("a", DAY, END, later()) == "closed" and made == [0] and flow.alerts().count() == 0


def test_a_drift_alerts_ends_the_flow_and_a_new_attempt_loads_again(spark, served):
    lossy = flows.RollupFlow(spark, served, f"{served}/rollup", write=lambda rows, *to: rollup.write_load(rows.where("fare_amount < 5"), *to))
    with pytest.raises(flows.RollupDrift, match="3 trips of 1 hours"):
        lossy.run("a", DAY, END, later())
    assert names(lossy)[-1] == (0, "drifted") and [(r["kind"], r["rows"]) for r in lossy.alerts().collect()] == [("rollup_drift", 3)]
    with pytest.raises(flows.RollupDrift):
        lossy.run("a", DAY, END, later())
    sound = flows.RollupFlow(spark, served, f"{served}/rollup")
    assert sound.run("a", DAY, END, later()) == "closed" and len(held(sound)) == 8
    assert [r["load_id"] for r in sound.markers().where("name = 'closed'").collect()] == [2]
    assert sound.alerts().count() == 2


def test_what_arrives_later_is_no_drift_and_comes_with_the_next_load(spark, served):
    flow, last = flows.RollupFlow(spark, served, f"{served}/rollup"), NOON + timedelta(minutes=175)

    def arrive(name):
        if name == flows.EXTRACTED:
            land(IngestJob(spark, served), f"{served}/raw", [event(20, at=last), event(7, at=last, fare_amount=99.0)], 8)

    flow.after = arrive
    assert flow.run("a", DAY, END, later()) == "closed" and len(held(flow)) == 8
    flow.after = lambda name: None
    assert flow.run("b", DAY, END, later()) == "closed" and len(held(flow)) == 9
    assert dict(held(flow))["3ef"] == 99.0


def test_waits_for_rows_and_says_when_there_are_none(spark, served):
    gated = flows.RollupFlow(spark, served, f"{served}/rollup", min_rows=9)
    assert gated.run("a", DAY, END, later()) == "waiting" and gated.markers().count() == 0
    flow = flows.RollupFlow(spark, served, f"{served}/rollup", min_rows=8)
    assert flow.run("a", DAY, END, later()) == "closed"
    empty = flows.RollupFlow(spark, served, f"{served}/rollup")
    assert empty.run("b", END, END + timedelta(hours=3), later()) == "closed"
    assert [(r["kind"], r["hours"], r["rows"]) for r in empty.alerts().collect()] == [("backfill_empty", 3, 0)]
    with pytest.raises(ValueError):
        empty.run("c", END, DAY, later())
    assert empty.markers().where("audit_id = 'c'").count() == 0


def test_closed_hours_are_read_with_folder_filters(spark, sf_dir):
    """The gate of all windows and a keyed city and hour read only the folders of their days."""
    windows = runs.backfill_windows(spark, sf_dir)
    root = runs.ingest_run(spark, sf_dir).job.root
    gate = plan(rollup.landed_windows(fanout.city_hours(spark, root, windows[0][0], windows[0][1]), windows[:1], 1))
    one = plan(fanout.city_hour(spark, root, "nyc", "2024-01-08 13:00:00"))
    for text in (gate, one):
        assert text.count("Scan parquet") == 1 or text.count("FileScan parquet") == 1
        assert "event_date#" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
