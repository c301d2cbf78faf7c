"""Headline benchmark: five question pairs, bulk load and ingest.

Follows the protocol of the published figures: equivalence first, then warm-ups, then
interleaved timed runs of both forms, median reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import math
import os
import statistics
import time

from tallyport.plans import questions
from tallyport.registry import runs
from tallyport.session import build_session, configure

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
WARMUPS = int(os.environ.get("BENCH_WARMUPS", "3"))
ITERATIONS = int(os.environ.get("BENCH_ITERATIONS", "9"))


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = configure(build_session("tallyport-bench", CPUS))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}

    seconds["load_trips_both_forms"] = timed(lambda: runs.trip_house(spark, SF_DIR))
    seconds["load_rides_both_forms"] = timed(lambda: runs.ride_house(spark, SF_DIR))
    trip_rows = runs.trip_house(spark, SF_DIR).wide.count()

    arms = {}
    for name, (wide, starred) in questions.PAIRS.items():
        house = (runs.ride_house if name == "q4" else runs.trip_house)(spark, SF_DIR)
        window = (runs.ride_window if name == "q4" else runs.trip_window)(spark, SF_DIR)
        arms[name] = (
            lambda w=wide, h=house, p=window: w(h.window("trips_wide", *p), *p),
            lambda s=starred, h=house, p=window: s(h.window("fact_trip", *p), h.dims(), *p),
        )

    mismatched = [n for n, (w, s) in arms.items() if not questions.compare(n, w(), s()).first()["equivalent"]]

    ratios = {}
    for name, (wide, starred) in arms.items():
        taken: dict[str, list[float]] = {"wide": [], "star": []}
        for i in range(WARMUPS + ITERATIONS):
            for arm, make in (("wide", wide), ("star", starred)):
                spent = timed(lambda: make().collect())
                if i >= WARMUPS:
                    taken[arm].append(spent)
        for arm, values in taken.items():
            seconds[f"{name}_{arm}"] = statistics.median(values)
        ratios[name] = seconds[f"{name}_wide"] / seconds[f"{name}_star"]

    seconds["stream_ingest"] = timed(lambda: runs.ingest_run(spark, SF_DIR))
    reports = runs.ingest_run(spark, SF_DIR).job.reports().collect()
    busy = sum(r["batch_seconds"] for r in reports)
    rows_in = sum(r["input_rows"] for r in reports)

    pairs = [f"{n}_{arm}" for n in arms for arm in ("wide", "star")]
    print(
        json.dumps(
            {
                "metric": "five question pairs, sum of medians",
                "value": round(sum(seconds[p] for p in pairs), 4),
                "unit": "sec",
                "queries": {k: round(v, 4) for k, v in seconds.items()},
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "cpus": CPUS,
                "trip_rows": trip_rows,
                "load_rows_per_sec": round(trip_rows / seconds["load_trips_both_forms"]),
                "mismatched": mismatched,
                "wide_over_star": {k: round(v, 3) for k, v in ratios.items()},
                "geometric_mean_wide_over_star": round(
                    math.exp(statistics.fmean(math.log(r) for r in ratios.values())), 3
                ),
                "stream_events_per_sec_in_batches": round(rows_in / busy) if busy else None,
                "stream_batch_seconds": [r["batch_seconds"] for r in sorted(reports, key=lambda r: r["batch_id"])],
            }
        )
    )


if __name__ == "__main__":
    main()
