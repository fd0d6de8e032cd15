"""Clustering of integer vectors around centroids, in JVM expressions.

Components are scaled and floored to integers once, so distances, sums and new centroids are exact and do not
depend on the order of rows. A round is one aggregation: ``zip_with`` and ``aggregate`` give the squared distance
to each of the literal centroids, ``array_min`` of structs the nearest one (the smaller number on ties), and
sums per component, taken in each task before the shuffle, the new centroids. A round moves one row per
cluster and task, whatever a cluster holds; the driver sees the centroids and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtally.llm.common import stored
from logtally.operators.once import evaluate_once
from logtally.session import ensure_checkpoint_dir

CLUSTERS, ROUNDS, DIM, SCALE, SEED = 40, 5, 64, 256, "2"


@dataclass(frozen=True)
class Integers:
    """The SQL type of the arithmetic, and the largest size of a component in it."""

    kind: str
    most: int


#: Vectors of a task: a round takes half a millisecond each.
TASK_VECTORS = 4096
#: Squared distances of 64 and more such components fit: 2^6 * (2^28)^2 in 64 bits, 2^6 * (2^59)^2 in 38 digits.
LONG, DECIMAL = Integers("bigint", 1 << 27), Integers("decimal(38,0)", 1 << 58)

Centroids = list[list[int]]


def usable(vector: Column, dim: int = DIM) -> Column:
    """True for vectors of ``dim`` components of which none is null, infinite or not a number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dim) & finite, F.lit(False))


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component, in double precision; at most ``DECIMAL.most`` in size."""
    low, high = F.lit(-DECIMAL.most).cast("double"), F.lit(DECIMAL.most).cast("double")
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, high), low)))


def nearest(vector: Column, centroids: Centroids, numbers: Integers) -> Column:
    """``struct(distance, cluster)`` of the centroid with the smallest squared distance, then number."""
    rows = ", ".join(f"array({', '.join(map(str, c))})" for c in centroids)
    literals = F.expr(f"CAST(array({rows}) AS array<array<{numbers.kind}>>)")
    zero = F.lit(0).cast(numbers.kind)

    def to(centroid: Column, number: Column) -> Column:
        squares = F.zip_with(vector, centroid, lambda x, y: ((x - y) * (x - y)).cast(numbers.kind))
        distance = F.aggregate(squares, zero, lambda total, square: (total + square).cast(numbers.kind))
        return F.struct(distance.alias("distance"), number.alias("cluster"))

    return F.array_min(F.transform(literals, to))


def first_centroids(vectors: DataFrame, clusters: int, seed: str) -> Centroids:
    """The vectors whose ids have the smallest hashes; null ids come last, ties go by the vector."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = vectors.orderBy(digest.asc_nulls_last(), "vector").limit(clusters).select("vector")
    return [list(map(int, row["vector"])) for row in first.collect()]


def updated(vectors: DataFrame, centroids: Centroids, numbers: Integers) -> Centroids:
    """Each centroid replaced by the floored mean of its vectors; one without vectors stays."""
    dim = len(centroids[0])
    sums = [F.expr(f"sum(vector[{i}])").alias(f"s{i}") for i in range(dim)]
    cluster = nearest(F.col("vector"), centroids, numbers)["cluster"]
    new = list(centroids)
    for row in vectors.groupBy(cluster.alias("cluster")).agg(F.count("*").alias("n"), *sums).collect():
        new[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dim)]
    return new


def fit(vectors: DataFrame, numbers: Integers, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED) -> Centroids:
    """The centroids after ``rounds`` rounds; fewer than ``clusters`` if there are fewer vectors."""
    centroids = first_centroids(vectors, clusters, seed)
    for _ in range(rounds if centroids else 0):
        centroids = updated(vectors, centroids, numbers)
    return centroids


def _of_cluster(values: Sequence[str], kind: str) -> Column:
    """The value of a row's cluster, from one literal per cluster."""
    return F.get(F.expr(f"CAST(array({', '.join(values)}) AS array<{kind}>)"), F.col("cluster"))


def _long(value: int) -> str:
    return str(value) if value < 1 << 63 else "NULL"


def centroid_clustering(
    df: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dim: int = DIM,
    scale: int = SCALE,
    seed: str = SEED,
) -> DataFrame:
    """``(id_col, cluster, distance, cluster_inertia, inertia, centroid)``, one row per usable vector.

    Vectors that are null or have another length, or null or non-finite components, are left out. Rows of equal or
    null id are vectors of their own. ``centroid`` is that of the cluster, after the last round. Components
    beyond ``2^27`` once scaled are reckoned with as decimals of 38 digits, up to ``2^58``, where they are
    cut off; a distance or inertia beyond 64 bits is null. Other columns are ignored, whatever their
    names. An empty table gives an empty result.
    """
    ensure_checkpoint_dir(df.sparkSession)
    vectors = df.select(F.col(id_col).alias("id"), F.col(vector).alias("vector")).filter(usable(F.col("vector"), dim))
    tasks = max(1, -(-df.count() // TASK_VECTORS))
    vectors = vectors.select("id", scaled(F.col("vector"), scale).alias("vector")).repartition(tasks)
    vectors = stored(vectors, "integer-vectors")
    most = vectors.agg(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0] or 0
    numbers = LONG if most <= LONG.most else DECIMAL
    vectors = vectors.withColumn("vector", F.col("vector").cast(f"array<{numbers.kind}>"))
    centroids = fit(vectors, numbers, clusters, rounds, seed)
    if not centroids:
        names = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
        return df.sparkSession.createDataFrame([], f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, {names}")
    found = evaluate_once(vectors, "_nearest", nearest(F.col("vector"), centroids, numbers))
    found = stored(found.select("id", "_nearest.cluster", "_nearest.distance"), "clusters")
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    totals = {row["cluster"]: int(row["total"]) for row in found.groupBy("cluster").agg(total).collect()}
    return found.select(
        F.col("id").alias(id_col),
        "cluster",
        F.col("distance").try_cast("bigint").alias("distance"),
        _of_cluster([_long(totals.get(k, 0)) for k in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.expr(f"CAST({_long(sum(totals.values()))} AS bigint)").alias("inertia"),
        _of_cluster([f"array({', '.join(map(str, c))})" for c in centroids], "array<bigint>").alias("centroid"),
    )


def written(centroid: Column) -> Column:
    """The digest of a centroid's components in decimal, joined by commas."""
    return F.sha2(F.array_join(centroid.cast("array<string>"), ","), 256)


def digest(centroid: Sequence[int]) -> str:
    """:func:`written` of a list."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
