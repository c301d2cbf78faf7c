"""Session settings, the shared work folder and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

# Rows and bytes a side may have at most before it is broadcast by hint.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20

_fallback_dirs: dict[str, str] = {}


def build_session(app: str = "tallyport", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings that results depend on, whoever built the session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by the cluster.

    Only a local session without the setting gets a temporary folder; on a
    cluster a missing setting is an error, because files on one machine would be
    lost with it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _fallback_dirs:
        _fallback_dirs[app] = tempfile.mkdtemp(prefix="tallyport-")
    return _fallback_dirs[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/tallyport/{app}/{name}-{uuid.uuid4().hex[:12]}"


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast `df` if its rows and their size prove it small; otherwise leave the join to AQE.

    Meant for per-batch or per-run aggregates. They are persisted, so the count and
    the join share one computation; with few rows all of them are then in the cache,
    whose size Spark knows.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    if kept.limit(max_rows + 1).count() <= max_rows:
        held = int(str(kept.select("*")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        if held <= max_bytes:
            return F.broadcast(kept)
    return kept


def together(spark: SparkSession, actions: list[Callable[[], None]]) -> None:
    """Submit independent actions side by side; raises the first error after all have ended."""
    with ThreadPoolExecutor(max(len(actions), 1)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
    for action in running:
        action.result()
