from __future__ import annotations

import math

import numpy as np
import pytest

from logtally.llm import embedding_dedup, queries
from logtally.llm.embedding_dedup import calibrate, embedding_near_dedup
from logtally.llm.simhash import smallest_labels

SCHEMA = "vec_id bigint, embedding array<float>, label int, node string, copies int"


def valid(vector) -> bool:
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def slow(rows, threshold=0.98):
    n = len(rows)
    a, b = [], []
    links = np.zeros(n, int)
    for i in range(n):
        for j in range(n):
            x, y = rows[i], rows[j]
            if i != j and x[2] is not None and x[2] == y[2] and valid(x[1]) and valid(y[1]) and len(x[1]) == len(y[1]):
                u, v = np.array(x[1], np.float32).astype(float), np.array(y[1], np.float32).astype(float)
                u, v = u / np.abs(u).max(), v / np.abs(v).max()
                if u @ v / math.sqrt((u @ u) * (v @ v)) >= threshold:
                    links[i] += 1
                    a.append(i)
                    b.append(j)
    label = smallest_labels(n, np.array(a, int), np.array(b, int))
    out = []
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if label[j] == label[i] and rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((rows[i][0], int(links[i]), component, rows[i][0] is not None and rows[i][0] == component))
    return sorted(out, key=str)


def near(rng, vector, cosine):
    unit = vector / np.linalg.norm(vector)
    other = rng.normal(size=len(vector))
    other -= other @ unit * unit
    other /= np.linalg.norm(other)
    return cosine * unit + math.sqrt(1 - cosine**2) * other


@pytest.mark.parametrize("block", [8192, 16, 4])
def test_against_brute_force(spark, block):
    rng = np.random.default_rng(1)
    rows = []
    for label in (0, 1):
        centre = rng.normal(size=16)
        rows += [(len(rows) + k, near(rng, centre, 0.992).tolist(), label) for k in range(60)]  # one dense group
        rows += [(len(rows) + k, rng.normal(size=16).tolist(), label) for k in range(60)]
        for _ in range(20):
            base = rng.normal(size=16)
            rows += [(len(rows) + k, (3 * near(rng, base, c)).tolist(), label) for k, c in enumerate((1, 0.985, 0.975, 0.99))]
        rows += [(len(rows) + k, centre.tolist(), label) for k in range(7)]  # copies
    rows += [(9000, rows[0][1], 1), (9001, rows[0][1], None), (9002, None, 0), (9003, [], 0), (9004, [0.0] * 16, 0), (9005, [0.0] * 16, 0)]
    rows += [(9006, [float("nan")] * 16, 0), (9007, [float("inf")] + [1.0] * 15, 0), (9008, [None] + [1.0] * 15, 0), (9009, [1.0, 2.0], 0), (9010, [2.0, 4.0], 0)]
    rows += [(None, rows[0][1], 0), (None, [5.0, -1.0, 3.0], 0), (5, rows[5][1], 0), (9011, [1e-30, 2e-30], 0), (9012, [3e38, 3e38], 4), (9013, [1e38, 1e38], 4)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    found = sorted(map(tuple, embedding_near_dedup(df, block=block).collect()), key=str)
    assert found == slow(rows)


def test_calibration_keeps_its_recall():
    limits = calibrate(dim=32)
    rng = np.random.default_rng(5)
    hits = []
    for _ in range(3000):
        x = rng.normal(size=32)
        x /= np.linalg.norm(x)
        y = near(rng, x, 0.98)
        places = embedding_dedup.directions(32)
        hits.append((np.abs((x - y) @ places) <= limits.window).sum() >= limits.count)
    assert np.mean(hits) > 0.99
    assert limits.count > embedding_dedup.DIRECTIONS // 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert embedding_near_dedup(df).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_the_query(spark, folder):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = sorted(map(tuple, queries.op8_embedding_near_dedup(spark, folder).collect()), key=str)
    assert found == slow(rows)


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_every_near_pair_meets_once_in_each_list(spark, depth):
    """Cells by several projections: a pair is met where its lower member is at home, if its cells touch."""
    rng = np.random.default_rng(depth)
    cells = [[int(c) for c in rng.integers(-2, 3, depth)] for _ in range(150)]
    rows = [(0, 2, 0, cell, k, 1, [1.0, 0.0]) for k, cell in enumerate(cells)]
    placed = spark.createDataFrame(rows, "label int, dim int, list int, cell array<int>, node bigint, copies bigint, vector array<double>")
    tasks = {}
    for r in embedding_dedup.dealt_blocks(placed, 4).collect():
        homes, others = tasks.setdefault((tuple(r["cell"]), r["home_part"], r["other_part"]), ([], []))
        (homes if r["home"] else others).append(r["node"])
    met = [(a, b) for homes, others in tasks.values() for a in homes for b in others]
    touch = lambda a, b: b[0] - a[0] in (0, 1) and all(abs(x - y) <= 1 for x, y in zip(a, b, strict=True))
    assert sorted(met) == [(a, b) for a in range(150) for b in range(150) if touch(cells[a], cells[b])]


def test_rows_dealt_grow_with_the_vectors(spark):
    """One label of spread vectors, 128 a block: twice as many give about twice as many rows up to the last depth."""
    rng, dealt = np.random.default_rng(3), {}
    for n in (8000, 16_000):
        rows = [(0, 64, k, 1, v.tolist()) for k, v in enumerate(rng.normal(size=(n, 64)))]
        vectors = spark.createDataFrame(rows, "label int, dim int, node bigint, copies bigint, vector array<double>").repartition(4)
        cells = embedding_dedup.cells_of(vectors, calibrate().window).checkpoint()
        dealt[n] = embedding_dedup.dealt_blocks(embedding_dedup.placed_on_lists(cells, 128), 128).count()
    assert dealt[16_000] < 2.4 * dealt[8000] and dealt[16_000] < 60 * 16_000, dealt


def test_a_large_cell_above_a_small_one_is_dealt_out(spark):
    sizes, block = {0: 3, 1: 2000, 2: 40, 5: 1}, 100
    rows = [(0, 2, 0, [cell], 10_000 * cell + k, 1, [1.0, 0.0]) for cell, n in sizes.items() for k in range(n)]
    placed = spark.createDataFrame(rows, "label int, dim int, list int, cell array<int>, node bigint, copies bigint, vector array<double>")
    tasks, met = {}, {}
    for r in embedding_dedup.dealt_blocks(placed, block).collect():
        homes, others = tasks.setdefault((r["cell"][0], r["home_part"], r["other_part"]), ([], []))
        (homes if r["home"] else others).append(r["node"])
    assert max(max(len(homes), len(others)) for homes, others in tasks.values()) <= 3 * block
    for homes, others in tasks.values():
        for a in homes:
            if a < 10_000 or a >= 20_000:
                for b in others:
                    met[a, b] = met.get((a, b), 0) + 1
    small = [k for k, n in sizes.items() if n < 100 for k in range(10_000 * k, 10_000 * k + n)]
    every = [node for *_, node, _, _ in rows]
    assert met == {(a, b): 1 for a in small for b in every if b // 10_000 - a // 10_000 in (0, 1)}
