"""Connected components of a table of links, by alternating star steps.

Every step replaces links by links to the smallest neighbour, with grouped minima and
joins only; nothing is collected, and a hub's links are spread by the skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm.common import stored


def star_step(links: DataFrame) -> DataFrame:
    """Links (node, label), label < node, of the same components, each node nearer its smallest."""
    sym = links.select(F.col("node").alias("u"), F.col("label").alias("v")).unionByName(
        links.select(F.col("label").alias("u"), F.col("node").alias("v"))
    )
    least = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = sym.filter("v > u").join(least, "u").select(F.col("v").alias("node"), F.col("m").alias("label"))
    lowest = large.groupBy("node").agg(F.min("label").alias("m"))
    small = large.join(lowest, "node")
    return (
        small.filter("label <> m").select(F.col("label").alias("node"), F.col("m").alias("label"))
        .unionByName(lowest.select("node", F.col("m").alias("label")))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, label) with label the smallest node reachable, for each node that is not that itself."""
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("node", "label").cast("decimal(38,0)"))).first()
    before = None
    while True:
        links = stored(star_step(links), "components")
        if (now := mark(links)) == before:
            return links
        before = now
