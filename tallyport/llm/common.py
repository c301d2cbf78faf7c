"""What several operators share: reading, Arrow mapping, written intermediates, bounded memos."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.session import new_folder

ROOT = str(Path(__file__).resolve().parents[2])
# Rows of an Arrow batch that are worked on at once: bounds what a task holds beside the batch.
SLICE_CHARS = 2_000_000
ASCII_SPACE = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` into the shared folder and read it back.

    Cuts the lineage and survives the loss of executors; nothing is computed twice.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_row_key(docs: DataFrame, name: str) -> DataFrame:
    """`docs`, stored, with a key `name` of its own for each row, which stays the same when it is read again."""
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "rows")


def map_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """`mapInArrow` whose workers find this package where the driver found it.

    On a cluster the package comes with the job (`--py-files`); locally, workers start in
    whatever folder the session was started in, so they are told the driver's path.
    """
    known = df.sparkSession.sparkContext.environment
    if ROOT not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [known.get("PYTHONPATH"), ROOT]))
    return df.mapInArrow(work, schema)


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `limit` characters together, one row at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def free_name(df_columns: Iterable[str], name: str) -> str:
    """`name`, lengthened until no column of the input has it in any case."""
    taken = {c.lower() for c in df_columns}
    while name.lower() in taken:
        name += "_"
    return name


class Memo:
    """Two generations of a mapping, so its size is bounded and what is in use stays."""

    def __init__(self, most: int):
        self.most = most
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[key] = value
