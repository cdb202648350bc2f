"""Connected components of a table of links by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstar.llm.common import stored


def _stars(links: DataFrame, smaller: bool) -> DataFrame:
    """Link each node's neighbours to its smallest one: those above it, or those below it."""
    if smaller:
        both = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.union(both.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    if smaller:
        found = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    else:
        found = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return found.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``comp`` (smallest node of its component) of all nodes of links (a, b).

    Each round writes its links to the shared checkpoint folder. Rounds grow with the
    logarithm of a component's diameter; they end when a round changes nothing.
    """
    links = links.select("a", "b").where("a <> b")
    seen = None
    while True:
        links = stored(_stars(_stars(links, False), True), "components")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("comp"))
        seen = tuple(now)
