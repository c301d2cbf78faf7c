"""Serving tables that are compacted while a stream writes them.

A table is a folder of batch deltas, `writer=<name>/write_id=<n>`. `compact` merges deltas
into runs of a first level, and as soon as `fan_in` runs of a level exist, those into one of
the next: a row is rewritten once a level, and a reader meets at most `fan_in` folders a
level. The last write of each key is picked by columns of its rows, so it does not matter
which folders are merged in which order.

A manifest names the runs that count and the deltas they replace. Its next version is created
whole and only if nobody else has created it; whoever comes second starts again from the new
one. Readers take the newest manifest and the deltas it does not replace, which is one
consistent set of folders, whatever happens beside them. A delta that is written again after
it was merged (a stream that lost its checkpoint) counts again, by the time of its commit.
Merged rows keep no write id: the order of writes must be in other columns.
Replaced folders stay until `vacuum` finds them older than its retention, so a reader that
began before a swap finishes on what it listed.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from tallyport.sources.files import Storage

FAN_IN = 8
RUNS = "writer=compacted"
# The committed deltas of a table; the marker is written when a write has ended.
COMMITS = ("write_id=*/_SUCCESS", "writer=*/write_id=*/_SUCCESS")


@dataclass(frozen=True)
class Manifest:
    """`runs`: level of each live run by folder. `replaced`: commit time of each merged delta. `buckets`: key buckets of new writes."""

    version: int = 0
    runs: dict[str, int] = field(default_factory=dict)
    replaced: dict[str, int] = field(default_factory=dict)
    buckets: int | None = None


def _file(version: int) -> str:
    return f"_manifest/v{version:012d}.json"


def manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest manifest of a table; an empty one before the first."""
    storage = Storage(spark, path)
    versions = storage.matching("_manifest/v*.json")
    return Manifest(**json.loads(storage.read(max(versions)))) if versions else Manifest()


def change(spark: SparkSession, path: str, make: Callable[[Manifest], Manifest | None]) -> Manifest:
    """Publish what `make` makes of the newest manifest; from the start if another writer was first."""
    storage = Storage(spark, path)
    while True:
        now = manifest(spark, path)
        after = make(now)
        if after is None:
            return now
        after = replace(after, version=now.version + 1)
        if storage.create(_file(after.version), json.dumps(asdict(after))):
            return after


def set_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    """Key buckets of writes and compactions from now on; folders that exist keep theirs."""
    change(spark, path, lambda now: None if now.buckets == buckets else replace(now, buckets=buckets))


def deltas(spark: SparkSession, path: str) -> dict[str, int]:
    """Commit time of every committed delta, by folder."""
    storage = Storage(spark, path)
    found = {k: v for pattern in COMMITS for k, v in storage.matching(pattern).items()}
    return {k.removesuffix("/_SUCCESS"): v for k, v in found.items() if not k.startswith(f"{RUNS}/")}


def live(spark: SparkSession, path: str) -> list[str]:
    """The folders that a reader of the table needs."""
    # Deltas first: one that is merged in between is then read twice rather than never.
    there = deltas(spark, path)
    now = manifest(spark, path)
    return [*now.runs, *sorted(d for d, at in there.items() if now.replaced.get(d) != at)]


def read_live(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the live folders; several writes of a key are not resolved."""
    folders = live(spark, path)
    reader = spark.read.option("basePath", path)
    return reader.parquet(*[f"{path}/{f}" for f in folders]) if folders else reader.parquet(path)


def compact(
    spark: SparkSession,
    path: str,
    resolve: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame, str], None],
    fan_in: int = FAN_IN,
) -> Manifest:
    """Merge deltas, then levels that are full, one manifest version each.

    `resolve` keeps one row of each key, `write` writes rows into a folder as the table's
    writers do. May run beside writers and readers; of two compactions at a time one starts again.
    """
    while True:
        now, there = manifest(spark, path), deltas(spark, path)
        fresh = {d: at for d, at in there.items() if now.replaced.get(d) != at}
        by_level = defaultdict(list)
        for folder, level in now.runs.items():
            by_level[level].append(folder)
        full = sorted(level for level, folders in by_level.items() if len(folders) >= fan_in)
        if len(fresh) >= fan_in:
            sources, level = sorted(fresh), 1
        elif full:
            sources, level, fresh = sorted(by_level[full[0]]), full[0] + 1, {}
        else:
            return now
        run = f"{RUNS}/write_id={uuid.uuid4().int >> 66}"
        rows = spark.read.option("basePath", path).parquet(*[f"{path}/{s}" for s in sources])
        write(resolve(rows).drop("writer", "write_id"), f"{path}/{run}")

        def swap(newest: Manifest) -> Manifest | None:
            if newest.version != now.version and (
                any(newest.replaced.get(d) == at for d, at in fresh.items())
                or not fresh and not set(sources) <= set(newest.runs)
            ):
                return None  # another compaction has merged some of these; the run is left for `vacuum`
            return replace(
                newest,
                runs={**{r: k for r, k in newest.runs.items() if r not in sources}, run: level},
                replaced={**newest.replaced, **fresh},
            )

        change(spark, path, swap)


def vacuum(spark: SparkSession, path: str, before_ms: int) -> list[str]:
    """Delete replaced deltas, runs that no manifest names any more and old manifests, changed before a time."""
    storage, now = Storage(spark, path), manifest(spark, path)
    runs = {k.removesuffix("/_SUCCESS"): v for k, v in storage.matching(f"{RUNS}/write_id=*/_SUCCESS").items()}
    there = deltas(spark, path)
    gone = [d for d, at in there.items() if now.replaced.get(d) == at and at < before_ms]
    gone += [r for r, at in runs.items() if r not in now.runs and at < before_ms]
    files = storage.matching("_manifest/v*.json")
    gone += [f for f, at in files.items() if f != max(files) and at < before_ms]
    for name in gone:
        storage.delete(name)
    # Folders go before their records: without its record a folder that is still there would count again.
    lost = {d for d in now.replaced if d in gone or d not in there}
    if lost:
        change(spark, path, lambda m: replace(m, replaced={d: at for d, at in m.replaced.items() if d not in lost}))
    return sorted(gone)
