"""SimHash fingerprints and their near-duplicates through vantage-point trees.

A fingerprint has one bit per bit of the shingles' hashes: 1 where over half of them have it. All
pairs of distinct fingerprints within a Hamming distance are found exactly:

- The top of a vantage-point tree is fitted on a bounded sample. A node has a vantage point ``v`` and a
  radius ``t``; its left side holds what is within ``t`` of ``v``, its right side what is further than
  ``t - r``, where ``r`` is the linking distance. By the triangle inequality two fingerprints within
  ``r`` are together on one side at least, so shards overlap at their boundary and nothing is lost.
- Each shard is worked through by itself in the same way, down to leaves that are compared in full.

Copies of a fingerprint are one row in all of this. A shard returns stars (fingerprint, smallest of its
local group), never pairs, so groups of any size stay linear.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.llm.common import join_hot, map_batches, slices, stored
from logtally.llm.components import connected_components

SHINGLE_WORDS, SEED, MAX_DISTANCE = 3, 42, 3
#: Fingerprints that the top of the tree is fitted on at most (8 bytes each).
TREE_SAMPLE = 8192
#: Distinct fingerprints that a shard should hold, overlap included.
SHARD_ROWS = 65_536
#: Fingerprints of a leaf that are compared in full.
LEAF = 192
LEAF_VANTAGES, TOP_VANTAGES = 12, 64
_CHUNK = 1 << 15


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The SimHash of a text: A-Z lower-cased, shingles of ``words`` words, repeats included.

    Fewer words are one shingle; none (or null) give 0.
    """
    # bytes.lower() and bytes.split() know ASCII letters and ASCII white space only.
    found = text.encode().lower().split() if text else []
    if not found:
        return 0
    joined = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        hashes = [digest(joined, seed)]
    else:
        ends = (np.cumsum([len(w) for w in found]) + np.arange(len(found))).tolist()
        starts = [0, *(e + 1 for e in ends)]
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1 :], strict=False)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        chunk = np.array(hashes[at : at + _CHUNK], "<u8")
        ones += np.unpackbits(chunk.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``(id_col, fp)``: one row per document, the fingerprint as a signed 64-bit number."""
    df = df.select(id_col, text)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                found = np.array([fingerprint(t, words) for t in part.column(text).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(found.view(np.int64))], [id_col, "fp"])

    return map_batches(df, run, f"`{id_col}` {kind}, fp bigint")


def distances(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _sides(sample: np.ndarray, v: np.uint64, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The share of a sample on either side of ``v``, for each radius 0 to 64 of the vantage point."""
    within = np.cumsum(np.bincount(distances(sample, v), minlength=65)) / len(sample)
    return within, 1 - np.r_[np.zeros(radius), within[:-radius]]


def _split(sample: np.ndarray, radius: int, rng: np.random.Generator) -> tuple[np.uint64, int, float, float] | None:
    """The vantage point and radius with the smallest larger side, and the shares of both sides."""
    best = None
    for v in rng.choice(sample, min(LEAF_VANTAGES, len(sample)), replace=False):
        left, right = _sides(sample, v, radius)
        t = int(np.argmin(np.maximum(left, right)))
        if best is None or max(left[t], right[t]) < best[0]:
            best = max(left[t], right[t]), v, t, left[t], right[t]
    if best is None or best[0] > 0.9:  # an overlap that large no longer pays
        return None
    return best[1:]


def _top_split(sample: np.ndarray, radius: int, rng: np.random.Generator) -> tuple[np.uint64, int, float, float] | None:
    """The split under which a whole tree of such splits would grow least.

    With sides of shares l and r the work on n fingerprints grows as n to the power a, where l^a + r^a = 1.
    """
    best = None
    for v in rng.choice(sample, min(TOP_VANTAGES, len(sample)), replace=False):
        left, right = _sides(sample, v, radius)
        usable = np.maximum(left, right) <= 0.9
        if not usable.any():
            continue
        low, high = np.ones(65), np.full(65, 16.0)
        for _ in range(20):
            middle = (low + high) / 2
            above = left**middle + right**middle > 1
            low, high = np.where(above, middle, low), np.where(above, high, middle)
        t = int(np.argmin(np.where(usable, high, np.inf)))
        if best is None or high[t] < best[0]:
            best = high[t], v, t, left[t], right[t]
    return None if best is None else best[1:]


class TopTree:
    """The part of the tree that deals fingerprints out to shards."""

    def __init__(self, sample: np.ndarray, rows: int, radius: int = MAX_DISTANCE, shard_rows: int = SHARD_ROWS) -> None:
        self.radius, self.shards = radius, 0
        rng = np.random.default_rng(7)

        def grow(part: np.ndarray, expected: float):
            split = _top_split(part, radius, rng) if expected > shard_rows and len(part) >= 32 else None
            if split is None:
                self.shards += 1
                return self.shards - 1
            v, t, left, right = split
            d = distances(part, v)
            return v, t, grow(part[d <= t], expected * left), grow(part[d > t - radius], expected * right)

        self.root = grow(np.unique(sample), float(rows))

    def route(self, fps: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each shard with the fingerprints that belong to it."""
        todo = [(self.root, fps)]
        while todo:
            node, part = todo.pop()
            if not len(part):
                continue
            if isinstance(node, int):
                yield node, part
                continue
            v, t, left, right = node
            d = distances(part, v)
            todo += [(left, part[d <= t]), (right, part[d > t - self.radius])]


def smallest_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 the smallest node reachable over the edges (a[i], b[i])."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        for end in (label[a], label[b], a, b):
            np.minimum.at(label, end, low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(before, label):
            break
    return label


def _groups(fps: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges among some fingerprints that connect what is linked: each to the seed that found it."""
    linked = np.zeros(len(fps), bool)
    for at in range(0, len(fps), LEAF):
        near = distances(fps[at : at + LEAF, None], fps[None, :]) <= radius
        linked[at : at + LEAF] = near.sum(axis=1) > 1
    rest = fps[linked]
    while len(rest):
        seed, rest = rest[:1], rest[1:]
        frontier = seed
        while len(frontier) and len(rest):
            near = (distances(frontier[:LEAF, None], rest[None, :]) <= radius).any(axis=0)
            new, rest = rest[near], rest[~near]
            frontier = np.r_[frontier[LEAF:], new]
            if len(new):
                yield new, np.full(len(new), seed[0])


def shard_links(fps: np.ndarray, radius: int = MAX_DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Stars (fingerprint, smallest of its group) over all links within ``radius`` among distinct ones."""
    fps = np.unique(fps)
    rng = np.random.default_rng(11)
    from_, to = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    todo = [fps]
    while todo:
        part = todo.pop()
        split = None
        if len(part) > LEAF:
            split = _split(part if len(part) <= 2048 else rng.choice(part, 2048, replace=False), radius, rng)
        if split is None:
            for a, b in _groups(part, radius):
                from_.append(a)
                to.append(b)
            continue
        v, t, _, _ = split
        d = distances(part, v)
        todo += [part[d <= t], part[d > t - radius]]
    a, b = np.searchsorted(fps, np.concatenate(from_)), np.searchsorted(fps, np.concatenate(to))
    label = smallest_labels(len(fps), a, b)
    moved = label != np.arange(len(fps))
    return fps[moved], fps[label[moved]]


def near_fingerprints(distinct: DataFrame, radius: int = MAX_DISTANCE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(node, root)`` over distinct fingerprints ``fp`` (bigint) linked within ``radius`` bits.

    The tree's top is fitted on the ``TREE_SAMPLE`` fingerprints of smallest hash; every one is routed.
    """
    spark = distinct.sparkSession
    rows = distinct.count()
    sample = distinct.orderBy(F.xxhash64("fp"), "fp").limit(TREE_SAMPLE).toPandas()["fp"].to_numpy(np.int64)
    tree = spark.sparkContext.broadcast(TopTree(sample.view(np.uint64), rows, radius, shard_rows))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, part in tree.value.route(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)):
                shards = np.full(len(part), shard, np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(shards), pa.array(part.view(np.int64))], ["shard", "fp"])

    def link(table: pa.Table) -> pa.Table:
        a, b = shard_links(table.column("fp").to_numpy().view(np.uint64), radius)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    dealt = map_batches(distinct.select("fp"), deal, "shard int, fp bigint")
    return connected_components(dealt.groupBy("shard").applyInArrow(link, "a bigint, b bigint"))


def simhash_near_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    radius: int = MAX_DISTANCE,
) -> DataFrame:
    """``(id_col, fingerprint, component_id)``, one row per document.

    ``component_id`` is the smallest id reachable over links of at most ``radius`` differing bits. Null
    and empty texts have the fingerprint 0 and are linked like any other; rows of equal id are
    kept; a null id never is the smallest (only if all ids of a component are null). Ties: none, all
    results are minima. An empty table gives an empty result.
    """
    docs = stored(fingerprints(df, id_col, text, words), "fingerprints")
    distinct = docs.groupBy("fp").agg(F.min(id_col).alias("least"), F.count("*").alias("n")).checkpoint()
    linked = near_fingerprints(distinct, radius).withColumnRenamed("node", "fp").join(distinct, "fp").checkpoint()
    groups = linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")).checkpoint()
    named = join_hot(linked.select("fp", "root"), groups.drop("n"), ["root"], groups, ["fp"]).select("fp", "component_id")
    classes = distinct.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return join_hot(docs, classes, ["fp"], distinct, [id_col]).select(
        id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
