"""Clusters of vectors around centroids, by a distance matrix that is carried on.

Vectors and centroids are whole numbers, so all distances are exact. Each
vector keeps its dot product with every centroid. When centroids move, a dot
product changes by the vector's components times the change of the centroid's,
and only components that did change are multiplied. The nearest centroid is
then read from |x|^2 - 2 x.c + |c|^2. Sums of clusters are carried on the same
way, by the vectors that changed sides.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.workspace import discard, stored

CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
WIDTH = 64
SEED = 3
#: Components beyond this magnitude are refused: 64 of their squared differences fit in 64 bits.
MOST_COMPONENT = 1 << 27

_STATE = "vec_id bigint, x array<bigint>, norm bigint, dots array<bigint>, cluster int, before int, distance bigint"


def whole_vectors(vectors: DataFrame, scale: int = SCALE, width: int = WIDTH) -> DataFrame:
    """(vec_id, x): vectors of ``width`` components, none null or non-finite, as floor(scale * c).

    Fails where a component is too large for exact distances in 64 bits.
    """
    given = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), given.alias("given")).filter(
        (F.size("given") == width) & F.forall("given", is_finite)
    )
    scaled = F.transform("given", lambda c: F.floor(c * F.lit(float(scale))))
    small = F.forall("given", lambda c: F.abs(c) * scale < MOST_COMPONENT)
    message = F.concat(F.lit("a component is too large for exact distances: vec_id "), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    return rows.select("vec_id", F.when(small, scaled).otherwise(F.raise_error(message)).alias("x"))


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def starts(rows: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The vectors whose id has the smallest hash, ties by components; rows without an id come last."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select("x", order.alias("_hash")).orderBy(F.asc_nulls_last("_hash"), "x").limit(clusters)
    return [row.x for row in first.collect()]


def _carried_on(change: np.ndarray, centroids: np.ndarray):
    """Dot products after ``change`` of the centroids, and the nearest of ``centroids``."""
    lengths = (centroids * centroids).sum(axis=1)
    moved = [(number, np.flatnonzero(row)) for number, row in enumerate(change)]
    moved = [(number, places) for number, places in moved if len(places)]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch["x"].flatten().to_numpy().reshape(batch.num_rows, -1)
            dots = batch["dots"].flatten().to_numpy().reshape(batch.num_rows, -1).copy()
            for number, places in moved:
                dots[:, number] += x[:, places] @ change[number, places]
            distances = batch["norm"].to_numpy()[:, None] - 2 * dots + lengths
            nearest = distances.argmin(axis=1)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * dots.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["x"], batch["norm"], pa.ListArray.from_arrays(ends, dots.ravel()),
                 pa.array(nearest, pa.int32()), batch["cluster"], pa.array(distances.min(axis=1))],
                names=["vec_id", "x", "norm", "dots", "cluster", "before", "distance"],
            )

    return run


def _moves(state: DataFrame) -> dict[tuple[int, int], int]:
    """What each cluster's count (place -1) and sums (its places) changed by; a bounded table."""
    sides = F.array(
        F.struct(F.col("cluster").alias("of"), F.lit(1).cast("bigint").alias("sign")),
        F.struct(F.col("before").alias("of"), F.lit(-1).cast("bigint").alias("sign")),
    )
    changed = state.filter("cluster <> before").select("x", F.inline(sides)).filter("of >= 0")
    values = F.posexplode(F.concat("x", F.array(F.lit(1).cast("bigint")))).alias("place", "value")
    sums = changed.select("of", "sign", values).groupBy("of", "place").agg(
        F.sum((F.col("value") * F.col("sign")).cast("decimal(38,0)")).alias("change")
    )
    return {(row.of, row.place): int(row.change) for row in sums.collect()}


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, width: int = WIDTH,
    seed: int = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, x, cluster, distance) for the vectors (vec_id, embedding), and the final centroids.

    Each round assigns every vector to the nearest centroid, ties to the
    smaller number, and replaces every centroid that has vectors by the floor
    of their mean; at last vectors are assigned once more. Rounds that would
    change nothing are not run. Vectors that are null, of another width, or
    hold a null or non-finite component are left out; rows without an id and
    repeated rows take part like any other. With fewer vectors than
    ``clusters`` there are as many centroids as vectors, and an empty table
    gives an empty one.

    Each round writes its dot products as a table, from which the next goes on
    when executors are lost; the one before it is then removed, so two at most
    are kept. The driver holds the centroids and one sum per cluster and place.
    """
    spark = vectors.sparkSession
    norm = F.aggregate("x", F.lit(0).cast("bigint"), lambda total, c: total + c * c)
    rows, path = stored(whole_vectors(vectors, scale, width), "whole-vectors")
    first = starts(rows, clusters, seed)
    if not first:
        return spark.createDataFrame([], "vec_id bigint, x array<bigint>, cluster int, distance bigint"), []
    centroids = np.array(first, dtype=np.int64)
    change = centroids
    sums = np.zeros((len(first), width + 1), dtype=object)
    state = rows.select(
        "vec_id", "x", norm.alias("norm"), F.array_repeat(F.lit(0).cast("bigint"), len(first)).alias("dots"),
        F.lit(-1).alias("cluster"),
    )
    for step in range(rounds + 1):
        taken = state.select("vec_id", "x", "norm", "dots", "cluster")
        state, following = stored(taken.mapInArrow(_carried_on(change, centroids), _STATE), "distances")
        discard(spark, path)
        path = following
        if step == rounds:
            break
        for (of, place), value in _moves(state).items():
            sums[of, place] += value
        means = [
            [int(total) // int(held[-1]) for total in held[:-1]] if held[-1] else kept
            for held, kept in zip(sums.tolist(), centroids.tolist())
        ]
        change = np.array(means, dtype=np.int64) - centroids
        centroids = centroids + change
        if not change.any():
            break
    return state.select("vec_id", "x", "cluster", "distance"), centroids.tolist()


def cluster_digest(vectors: DataFrame) -> DataFrame:
    """Per vector: cluster, squared distance, its sums, and the hash of the final centroid."""
    assigned, centroids = cluster(vectors)
    spark = vectors.sparkSession
    totals = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"))
    inertia = {row.cluster: int(row.inertia) for row in totals.collect()}
    facts = [
        (number, inertia.get(number, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for number, c in enumerate(centroids)
    ]
    names = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    of_cluster = F.broadcast(spark.createDataFrame(facts, names))  # one row per centroid
    return assigned.join(of_cluster, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
