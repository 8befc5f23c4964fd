"""Connected components of links by alternating large and small stars.

Every round turns each node's neighbours to the smallest node near them; rounds go on until
all are stars, which takes about the logarithm of the longest path.  Only links travel, a hub
sends one row per link, and every round is written to the shared folder, so neither lineage
nor a task grows with a component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.files import scratch_path


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and safe from lost
    executors."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge to a root, and no root an edge to another one."""
    ends = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
            )
        ).alias("end")
    ).select("end.*")
    moving = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return moving.filter((F.col("up") > 1) | (F.col("up") + F.col("down") > 1)).isEmpty()


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """From links (``u``, ``v``; any order, repeats allowed) the table ``node``, ``root``: the
    smallest node of its component, for every node that has a link to another one.  ``known``
    is what this gave for earlier links, which then need not be given again."""
    if known is not None:
        if links.isEmpty():
            return known
        links = links.unionByName(known.select(F.col("node").alias("u"), F.col("root").alias("v")))
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stage(edges.filter(F.col("u") != F.col("v")).distinct(), "links")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u")
            .filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(
                F.explode(
                    F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))
                ).alias("e")
            )
            .select("e.u", F.col("e.m").alias("v"))
            .filter(F.col("u") != F.col("v"))
            .distinct()
        )
        edges = stage(small, "small_star")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
