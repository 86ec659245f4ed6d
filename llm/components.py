"""Connected components of links, by alternating large and small stars; nothing passes the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.session import pin


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Tie each node's neighbours to the least of them. Large: its larger neighbours; small: its smaller ones and itself."""
    if large:
        ends = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    else:
        ends = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = ends.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = ends.join(least, "u")
    if large:
        tied = tied.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        tied = tied.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return tied.where("a <> b").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).collect()[0])


def components(links: DataFrame) -> DataFrame:
    """doc_id, component_id (the least id reachable) of every end of ``links`` (a, b)."""
    links = pin(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while (now := _state(links)) != before:
        before = now
        links = pin(_stars(_stars(links, True), False), "links")
    stars = links.select(F.col("a").alias("doc_id"), F.col("b").alias("component_id"))
    return stars.union(stars.select("component_id", "component_id").distinct())
