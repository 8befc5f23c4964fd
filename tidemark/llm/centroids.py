"""Centroid clustering (Lloyd's rounds) in Spark's own expressions.

Vectors become integers, so every distance and every centroid is exact and reruns agree.  The
centroids are a literal of ``k`` arrays in the plan: ``zip_with`` and ``aggregate`` give a
vector's squared distance to each, and ``array_min`` of structs (distance, number) the nearest,
the smaller number among ties.  A round is one scan and one aggregation, whose sums, one per
component, are taken in the scanning tasks: a task sends ``k`` rows, however many vectors a
cluster has.  The driver holds ``k * dimensions`` sums.

Defined results: a row whose vector is null, has another number of entries than ``dimensions``,
or holds a null, NaN or infinite entry is left out.  Integers beyond 2^27 count as 2^27, so that
distances fit a long.  The first centroids are those of the smallest hashes of ``<seed>:<id>``;
of equal hashes (one id on many rows) the smaller vector comes first, null ids come last.  With
fewer rows than ``k`` there are as many clusters as rows, two of them equal where rows are; an
empty table gives an empty result.  An empty cluster keeps its centroid.  Columns named in
``keep`` are carried, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import stage

CLUSTERS, ROUNDS, DIMENSIONS = 40, 5, 64
SEED, SCALE = 2, 256
_LIMIT = 2**27


@dataclass(frozen=True)
class Clusters:
    centroids: list[list[int]]
    inertia: list[int]  # distances summed, per cluster


def _literal(centroids: list[list[int]]) -> Column:
    arrays = (f"array({','.join(f'{c}L' for c in centroid)})" for centroid in centroids)
    return F.expr(f"array({','.join(arrays)})")


def distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two arrays of integers."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0).cast("long"), lambda total, s: total + s)


def nearest(x: Column, centroids: list[list[int]]) -> Column:
    """The struct ``distance, cluster`` of the nearest centroid."""
    return F.array_min(
        F.transform(
            _literal(centroids),
            lambda c, i: F.struct(distance(x, c).alias("distance"), i.alias("cluster")),
        )
    )


def usable(
    df: DataFrame, vec_col: str, id_col: str, dimensions: int, keep: Sequence[str] = ()
) -> DataFrame:
    """Rows that are clustered, as ``row`` (the columns to keep), ``id`` and ``x`` (integers)."""
    vector = F.col(f"`{vec_col}`").cast("array<double>")

    def unit(c: Column) -> Column:
        value = F.greatest(F.least(c * SCALE, F.lit(float(_LIMIT))), F.lit(-float(_LIMIT)))
        return F.floor(value).cast("long")

    good = ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    row = F.struct(*[F.col(f"`{c}`") for c in keep] or [F.lit(0).alias("none")])
    return df.filter((F.size(vector) == dimensions) & good).select(
        row.alias("row"), F.col(f"`{id_col}`").alias("id"), F.transform(vector, unit).alias("x")
    )


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = vectors.orderBy(hashed.asc_nulls_last(), "x").select("x").limit(k)
    return [list(row.x) for row in first.collect()]


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after a round: the floor of the mean of each cluster's vectors."""
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    found = (
        vectors.select("x", nearest(F.col("x"), centroids)["cluster"].alias("cluster"))
        .groupBy("cluster")
        .agg(F.count(F.lit(1)).alias("n"), *sums)
        .collect()
    )
    new = [list(c) for c in centroids]
    for cluster, n, *totals in found:
        new[cluster] = [total // n for total in totals]
    return new


def assign(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """The vectors' rows and ids with ``cluster`` and ``distance``."""
    if not centroids:
        near = F.lit(None).cast("struct<distance:bigint,cluster:int>")
    else:
        near = nearest(F.col("x"), centroids)
    return vectors.select("row", "id", near.alias("near")).select(
        "row",
        "id",
        F.col("near.cluster").cast("int").alias("cluster"),
        F.col("near.distance").alias("distance"),
    )


def cluster(
    df: DataFrame,
    vec_col: str = "embedding",
    id_col: str = "vec_id",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, Clusters]:
    """Per usable row ``row`` (a struct of the columns in ``keep``), ``id``, ``cluster`` and
    ``distance``; beside it the centroids these were measured to."""
    # The integers are made once; every round reads them, and nothing else.
    vectors = stage(usable(df, vec_col, id_col, dimensions, keep), "centroids")
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if centroids else 0):
        new = moved(vectors, centroids)
        if new == centroids:  # later rounds would change nothing either
            break
        centroids = new
    assigned = stage(assign(vectors, centroids), "clusters")
    inertia = [0] * len(centroids)
    for row in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect():
        inertia[row.cluster] = row.s
    return assigned, Clusters(centroids, inertia)


def centroid_sha256(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def described(assigned: DataFrame, clusters: Clusters) -> DataFrame:
    """Assigned rows with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    if not clusters.centroids:
        return assigned.select(
            "*",
            F.lit(None).cast("long").alias("cluster_inertia"),
            F.lit(None).cast("long").alias("inertia"),
            F.lit(None).cast("string").alias("centroid_sha256"),
        )
    inertia = F.array(*[F.lit(v).cast("long") for v in clusters.inertia])
    digests = F.array(*[F.lit(centroid_sha256(c)) for c in clusters.centroids])
    return assigned.select(
        "*",
        inertia[F.col("cluster")].alias("cluster_inertia"),
        F.lit(sum(clusters.inertia)).cast("long").alias("inertia"),
        digests[F.col("cluster")].alias("centroid_sha256"),
    )
