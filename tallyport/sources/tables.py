"""Readers of the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows a task gets where a long text is made of each.
ROWS_PER_TASK = 50_000


def dealt(rows: DataFrame) -> DataFrame:
    """The same rows, shared out over tasks by their number.

    A file of short rows is a few row groups, and a row group is read by one task, which would
    do all that follows as well: short rows are moved before long ones are made of them.
    They are dealt by the number their scan gives them, which is the same when a task is run
    again; dealt without a number, Spark sorts all rows of a task before it moves them.
    """
    tasks = -(-rows.count() // ROWS_PER_TASK)
    if tasks <= 1:
        return rows
    return rows.withColumn("_number", F.monotonically_increasing_id()).repartition(tasks, "_number").drop("_number")
