from __future__ import annotations

import hashlib
import math
import random

from logtally.llm.centroids import centroid_clustering, digest, written

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, distance int, id string, vector string"


def slow(rows, clusters, rounds, dim, scale=256):
    """``(id, cluster, distance)`` of each row that counts, the centroids and the sums, in plain Python."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(scale * x) for x in v]))
    hashes = {i: hashlib.sha256(f"2:{i}".encode()).hexdigest() for i, _ in kept if i is not None}
    order = sorted(kept, key=lambda r: (r[0] is None, hashes.get(r[0], ""), r[1]))
    centroids = [v for _, v in order[:clusters]]

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        of = [best(v)[1] for _, v in kept]
        for k in range(len(centroids)):
            mine = [v for (_, v), at in zip(kept, of, strict=True) if at == k]
            if mine:
                centroids[k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    out = [(i, *reversed(best(v))) for i, v in kept]
    inertia = {k: sum(d for _, c, d in out if c == k) for k in range(len(centroids))}
    return out, centroids, inertia


def check(spark, rows, clusters=5, rounds=3, dim=4, schema=SCHEMA, fits=lambda n: n):
    df = spark.createDataFrame([(*r, "clash", 7, "clash", "clash") for r in rows], schema)
    found = centroid_clustering(df, clusters=clusters, rounds=rounds, dim=dim)
    got = found.withColumn("sha", written(found.centroid)).collect()
    out, centroids, inertia = slow(rows, clusters, rounds, dim)
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    expected = [(i, k, fits(d), fits(inertia[k]), fits(sum(inertia.values())), centroids[k], digest(centroids[k])) for i, k, d in out]
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def vectors(number, dim=4, spread=1.0, seed=3):
    rng = random.Random(seed)
    # Quarters make many ties between centroids.
    return [(i, [rng.choice((-1, -0.5, -0.25, 0, 0.25, 0.5, 1)) * spread for _ in range(dim)]) for i in range(number)]


def test_clusters_are_those_of_plain_python(spark):
    check(spark, vectors(300))


def test_odd_rows(spark):
    rows = vectors(60)
    rows += [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 0.0, 0.0]), (104, [float("nan"), 0.0, 0.0, 0.0]), (105, [float("inf")] * 4)]
    rows += [(None, [0.25, 0.25, 0.0, 1.0]), (None, [0.5, 0.0, 0.0, 0.0]), (3, rows[3][1]), (3, rows[5][1])] + [(7, rows[7][1])] * 40
    check(spark, rows)


def test_fewer_vectors_than_clusters_and_clusters_that_go_empty(spark):
    check(spark, vectors(3))
    check(spark, [(i, [0.0, 0.0, 0.0, 0.0]) for i in range(12)])


def test_large_components_are_exact(spark):
    """Squares beyond 64 bits are reckoned with as decimals; what does not fit the result is null."""
    schema = SCHEMA.replace("array<float>", "array<double>")
    fits = lambda n: n if n < 1 << 63 else None
    check(spark, vectors(40, spread=2.0**40), schema=schema, fits=fits)
    near = [(i, [2.0**45 + (i % 7), 0.0, float(i % 3), 0.0]) for i in range(40)]
    check(spark, near, schema=schema, fits=fits)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    found = centroid_clustering(df)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert found.count() == 0
