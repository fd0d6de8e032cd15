from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from logtally.llm import queries, simhash
from logtally.llm.components import connected_components
from logtally.llm.simhash import TopTree, fingerprint, shard_links, simhash_near_dedup, smallest_labels


def slow_fingerprint(text: str | None, words: int = 3) -> int:
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(fps: np.ndarray, radius: int = 3) -> np.ndarray:
    a, b = [], []
    for at in range(0, len(fps), 256):
        i, j = np.nonzero(np.bitwise_count(fps[at : at + 256, None] ^ fps[None, :]) <= radius)
        a.append(i + at)
        b.append(j)
    return smallest_labels(len(fps), np.concatenate(a), np.concatenate(b))


def clustered(rng: np.random.Generator, n: int) -> np.ndarray:
    """Random fingerprints, close pairs, chains, and a dense group of a third of all."""
    fps = list(rng.integers(0, 2**63, n // 3, dtype=np.uint64))
    for seed in fps[: n // 9]:
        at = seed
        for _ in range(3):
            for bit in rng.integers(0, 64, int(rng.integers(1, 6))):
                at = at ^ np.uint64(1 << int(bit))
            fps.append(at)
    centre = fps[0]
    for _ in range(n // 3):
        fps.append(centre ^ np.uint64(sum(1 << int(b) for b in set(rng.integers(0, 64, 4).tolist()))))
    return np.unique(np.array(fps, np.uint64))


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "One TWO", "a b c", "É a Ü b ß C d", "x " * 5000, "a\x85b c d", "a\x1fb c\x1c d e"])
def test_fingerprint(text):
    assert fingerprint(text) == slow_fingerprint(text)


def test_fingerprints_of_random_texts():
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choices(["ab", "C", "é", " ", "\n", "\x0b", "z z", "."], k=rng.randint(0, 60)))
        assert fingerprint(text) == slow_fingerprint(text), text


@pytest.mark.parametrize("seed", range(3))
def test_links_of_a_shard(seed):
    fps = clustered(np.random.default_rng(seed), 2400)
    a, b = shard_links(fps)
    label = smallest_labels(len(fps), np.searchsorted(fps, a), np.searchsorted(fps, b))
    assert np.array_equal(label, slow_components(fps))


def test_shards_keep_every_link_together():
    rng = np.random.default_rng(9)
    fps = clustered(rng, 3000)
    tree = TopTree(fps[rng.integers(0, len(fps), 600)], len(fps), shard_rows=150)
    assert tree.shards > 4
    a, b = [], []
    for _, part in tree.route(fps):
        x, y = shard_links(part)
        a.append(x)
        b.append(y)
    label = smallest_labels(len(fps), np.searchsorted(fps, np.concatenate(a)), np.searchsorted(fps, np.concatenate(b)))
    assert np.array_equal(label, slow_components(fps))


def test_distributed_search(spark):
    fps = clustered(np.random.default_rng(12), 2000)
    df = spark.createDataFrame([(int(v),) for v in fps.view(np.int64)], "fp bigint")
    linked = {r["node"]: r["root"] for r in simhash.near_fingerprints(df, shard_rows=300).collect()}
    roots = {}
    for value, group in zip(fps.view(np.int64).tolist(), slow_components(fps).tolist(), strict=True):
        roots.setdefault(group, []).append(value)
    for members in roots.values():
        assert len({linked.get(m, m) for m in members}) == 1
        assert len(members) > 1 or members[0] not in linked


def test_connected_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, k) for k in range(1001, 1200)] + [(rng.randint(2000, 2300), rng.randint(2000, 2300)) for _ in range(200)]
    edges += [(7, 7), (None, 4), (5, None)]
    out = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert {r["node"]: r["root"] for r in out.collect()} == {x: find(x) for x in list(parent)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_documents(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base, 1), (3, base.upper(), 2), (9, base + " tail", 3), (None, base, 4), (7, None, 5), (6, " ", 6), (6, " ", 6), (8, "other words here", 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, fp int")
    out = simhash_near_dedup(df).collect()
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[5]["component_id"] == by_id[3]["component_id"] == by_id[None]["component_id"] == 3
    assert by_id[7]["component_id"] == by_id[6]["component_id"] == 6
    assert by_id[7]["fingerprint"] == "0" * 16
    assert by_id[8]["component_id"] == 8
    assert by_id[5]["fingerprint"] == f"{slow_fingerprint(base):016x}"
    assert simhash_near_dedup(df.limit(0)).count() == 0


def test_the_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    out = {r["doc_id"]: r for r in queries.op4_simhash_near_dedup(spark, folder).collect()}
    fps = np.array([slow_fingerprint(r["text"]) for r in docs], np.uint64)
    label = slow_components(fps)
    ids = np.array([r["doc_id"] for r in docs])
    for k, row in enumerate(docs):
        assert out[row["doc_id"]]["fingerprint"] == f"{int(fps[k]):016x}"
        assert out[row["doc_id"]]["component_id"] == ids[label == label[k]].min()


def test_hash_is_that_of_spark(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first()
    assert row["h"] % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)
