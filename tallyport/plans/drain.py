"""Draining the quarantine: route, replay, park, and remember what was drained.

Every record ends in exactly one place: back in the raw log, in the serving tables, or
parked with its reason; only then is it entered in the ledger. A drain that dies before
that is repeated under the same id: it replaces what it had written and parked, and what
it had put into the log a second time is absorbed by its keys.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.functions.keys import log_partition
from tallyport.functions.sequences import numbered
from tallyport.operators import quarantine as q
from tallyport.operators.fanout import fanout, write_serving
from tallyport.session import together
from tallyport.sources.raw_log import RAW_COLUMNS, end_offsets, publish_files
from tallyport.sources.schemas import RAW_SCHEMA

LEDGER_SCHEMA = "_identity string, outcome string, drain_id bigint"
WRITER = "drain"
# Messages a task sorts at a time.
ROWS_PER_RANGE = 50_000


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows below `path`, none before anything was written there."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Drained identities so far; empty before the first drain."""
    return _read_or_empty(spark, path, LEDGER_SCHEMA)


def next_messages(messages: DataFrame, log: DataFrame, partitions: int) -> DataFrame:
    """Messages with the coordinates the log would give them: the key's partition, and
    offsets that follow all that the partition holds."""
    keyed = messages.withColumn("partition", log_partition(F.col("key"), partitions))
    ends = end_offsets(log).select("topic", "partition", "end_offset")
    placed = numbered(keyed, ["partition", "key", "value"], "_n", 0, max(1, -(-messages.count() // ROWS_PER_RANGE)))
    return (
        placed.join(ends, ["topic", "partition"], "left")
        .withColumn("offset", F.coalesce("end_offset", F.lit(0)) + F.col("_n"))
        .withColumn("timestamp", F.current_timestamp())
        .select(*RAW_COLUMNS)
    )


def drain(
    spark: SparkSession,
    envelopes: DataFrame,
    root: str,
    drain_id: int,
    topic: str,
    log_path: str,
    serving_root: str,
    partitions: int,
    max_replays: int = q.MAX_REPLAYS,
    breaker: int | None = None,
    dry_run: bool = False,
    budget: int | None = None,
) -> DataFrame:
    """One drain over the records no earlier drain has handled; returns its totals.

    With `breaker`, raises when there are more pending records than that. With `budget`,
    takes about so many and leaves the rest to the next drain. What was
    decided is stored below `root` first, so all writes and the totals follow from the
    same rows; the ledger is written last. Direct writes have folders of their own and
    are ordered against the stream by ingest time.
    """
    todo = q.pending(envelopes, read_ledger(spark, f"{root}/ledger"))
    if budget is not None:
        todo = q.within_budget(todo, budget)
    decided = f"{root}/decided/drain_id={drain_id}"
    q.settle(q.route(todo, max_replays)).write.mode("overwrite").parquet(decided)
    settled = spark.read.parquet(decided)
    if breaker is not None and (alert := q.breaker_alert(settled, breaker).first()):
        raise RuntimeError(f"{alert['records']} records to drain, more than {breaker}")
    if not dry_run:
        outcome = F.col("outcome")

        def publish() -> None:
            messages = q.reinject(settled.where(outcome == "reinjected"), topic)
            publish_files(next_messages(messages, _read_or_empty(spark, log_path, RAW_SCHEMA), partitions), log_path)

        def write() -> None:
            events = q.writable(q.direct_events(settled.where(outcome == "direct_written")))
            write_serving(fanout(events, q.now_ms(), latest=False), serving_root, drain_id, WRITER)

        def park() -> None:
            left = settled.where(~outcome.isin("reinjected", "direct_written"))
            left.write.mode("overwrite").json(f"{root}/parked/drain_id={drain_id}")

        together(spark, [publish, write, park])
        q.ledger_rows(settled).write.mode("overwrite").parquet(f"{root}/ledger/drain_id={drain_id}")
    return q.drain_totals(settled)
