"""Connected components of a link table by alternating large-star and small-star steps.

Each step sends the neighbours of a node to the smallest one it knows; the number of rounds grows with the logarithm
of the longest chain. The minimum per node is combined map-side and joined back in a form that AQE can split, so a node
with very many neighbours is no task's burden. Every round is written to the shared folder (a lineage cut).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete, durable_at, step_path
from .common import same_key


def star(links: DataFrame, large: bool) -> DataFrame:
    """One step over links ``a, b``; returns links ``a, b`` with b < a."""
    if large:
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("low"))
    joined = both.join(least, same_key("a", "node", "large" if large else "small"))
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        own = least.select(F.col("node").alias("a"), F.col("low").alias("b"))
        out = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(own)
    return out.filter("a <> b").distinct()


def fingerprint_of(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b`` long) that is not its component's smallest node itself.

    Links with a null end link nothing. Each round replaces the one before, which is deleted.
    """
    spark = links.sparkSession

    def step(frame: DataFrame) -> tuple[DataFrame, str]:
        path = step_path(spark, "llm-links")
        return durable_at(frame, path), path

    real = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, path = step(real.distinct())
    seen = fingerprint_of(now)
    while seen[0]:
        before = path
        now, path = step(star(star(now, True), False))
        delete(spark, before)
        new = fingerprint_of(now)
        if new == seen:
            break
        seen = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
