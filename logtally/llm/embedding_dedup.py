"""Embedding near-duplicates by collision counting over one-dimensional projections.

Unit vectors are projected on many random directions. Two vectors of cosine ``threshold`` or more are at
most ``theta`` apart, so their projections on a Gaussian direction differ by about ``theta`` times a
normal number, and fall into a query-centred window of ``WIDTH * theta`` on nearly every direction; others
do so on few. Pairs that collide on at least ``count`` directions are verified in double precision. The
count is calibrated: the largest at which a stated share of made pairs of exactly the threshold passes.

``LISTS`` of the projections are kept as sorted lists, cut into cells of one window's width. Labels of very many
vectors key a list's cells by further projections too, its ``depth``, so that a cell holds about as many vectors
up to some hundred blocks a label; beyond that cells grow, and rows dealt with them. A pair belongs to the first list on which it collides in all of the depth. It is met in the
cell of its member that is lower on the list, where the other member is present as a neighbour. Cells that still hold many
vectors are dealt out in blocks, neighbours in blocks of their own cell, so a task has about three blocks at most whatever
a cell or the next holds, and returns link counts and stars, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtally.llm.common import join_hot, join_on, map_batches, stored
from logtally.llm.components import connected_components
from logtally.llm.simhash import smallest_labels
from logtally.session import ensure_checkpoint_dir

THRESHOLD = 0.98
#: Directions, sorted lists among them, the projections that may key a list, and half the window in units of the linking distance.
DIRECTIONS, LISTS, DEPTH, WIDTH = 16, 3, 3, 2.5
#: Share of a label's vectors that a cell may hold for one projection (a fifth of a normal number's spread is the densest window).
_DENSEST = 0.2
#: Share of pairs at the threshold that the collision count must pass in the calibration, and its pairs.
RECALL, TRIALS = 0.9999, 100_000
#: Distinct vectors of a block; a task holds a block at home and two of neighbours.
BLOCK = 8192
_STEP = 256


@dataclass(frozen=True)
class Calibration:
    """Window (half width) and the collisions that a pair needs."""

    window: float
    count: int


def directions(dim: int, number: int = DIRECTIONS) -> np.ndarray:
    """Gaussian directions for vectors of ``dim`` components, the same in every task."""
    return np.random.default_rng(1_000_003 + dim).normal(size=(dim, number))


def calibrate(threshold: float = THRESHOLD, number: int = DIRECTIONS, recall: float = RECALL, dim: int = 64) -> Calibration:
    """The largest count that ``recall`` of made pairs of cosine ``threshold`` reach, which must meet on a list of full depth.

    Their difference has length ``theta`` in a random direction, as the data's pairs have.
    """
    theta = math.sqrt(max(2 - 2 * threshold, 1e-12))
    rng = np.random.default_rng(17)
    apart = rng.normal(size=(TRIALS, dim))
    apart *= theta / np.linalg.norm(apart, axis=1, keepdims=True)
    near = np.abs(apart @ directions(dim, number)) <= WIDTH * theta
    met = np.logical_or.reduce([near[:, _of_list(k, DEPTH)].all(axis=1) for k in range(LISTS)])
    hits = np.where(met, near.sum(axis=1), -1)
    passing = [(hits >= c).mean() for c in range(number + 1)]
    return Calibration(WIDTH * theta, max((c for c in range(number + 1) if passing[c] >= recall), default=0))


def _of_list(which: int, depth: int) -> slice:
    """The directions that key a list: its own first."""
    return slice(which * DEPTH, which * DEPTH + depth)


def usable(vector: Column) -> Column:
    """True for vectors that can link: not null or empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    vectors = table.column("vector")
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def cells_of(distinct: DataFrame, window: float) -> DataFrame:
    """Add ``cells``: the vector's cell on each direction of each list, as wide as the window."""
    schema = distinct.schema

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = batch.column("dim").to_numpy()
            cells = np.zeros((batch.num_rows, LISTS * DEPTH), np.int32)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                unit = _unit(batch.take(pa.array(at)))
                cells[at] = np.floor(unit @ directions(int(dim))[:, : LISTS * DEPTH] / window)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.tolist(), pa.list_(pa.int32()))], [*schema.names, "cells"])

    return map_batches(distinct, run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", cells array<int>")


_CELL = ["label", "dim", "list", "cell"]


def depth_of(n: Column, block: int) -> Column:
    """The projections that key a label of ``n`` vectors: as few as leave about a block in its densest cell."""
    fits = [F.when(n * _DENSEST**depth <= block, depth) for depth in range(1, DEPTH)]
    return F.coalesce(*fits, F.lit(DEPTH)).cast("int")


def placed_on_lists(vectors: DataFrame, block: int) -> DataFrame:
    """A row per vector and list, with the ``cell`` as an array of the label's depth."""
    sizes = vectors.groupBy("label", "dim").agg(F.count("*").alias("n")).checkpoint()
    depths = sizes.select("label", "dim", depth_of(F.col("n"), block).alias("depth"))
    deep = join_hot(vectors, depths, ["label", "dim"], sizes, ["node"])
    lists = F.explode(F.array(*(F.struct(F.lit(k).alias("list"), F.slice("cells", k * DEPTH + 1, F.col("depth")).alias("cell")) for k in range(LISTS))))
    return deep.withColumn("at", lists).select("label", "dim", "node", "copies", "vector", "at.list", "at.cell")


def _homes(cell: Column) -> Column:
    """The cells in which a vector of ``cell`` is a neighbour: its own and the one below, on further projections also the one above."""
    near = F.array(cell)
    for place in range(DEPTH):
        moved = F.flatten(F.transform(near, _steps(place)))
        near = F.when(F.size(cell) > place, moved).otherwise(near)
    return near


def _steps(place: int) -> Callable[[Column], Column]:
    """A cell with the number at ``place`` moved by each step."""
    steps = F.array(*map(F.lit, (-1, 0) if place == 0 else (-1, 0, 1)))

    def moved(base: Column) -> Column:
        def by(step: Column) -> Column:
            return F.transform(base, lambda x, i: F.when(i == place, x + step).otherwise(x))

        return F.transform(steps, by)

    return moved


def dealt_blocks(placed: DataFrame, block: int) -> DataFrame:
    """The rows of each task, by cell, ``home_part`` and ``other_part``: a block at home and one of its cell or of one that is near.

    Each vector is at home in its cell and a neighbour there and in the cells whose windows reach it, if these are occupied. It is
    dealt out by the parts of its own cell everywhere, so what a task holds does not hang on the next cell's size.
    """
    parts = placed.groupBy(*_CELL).agg(F.ceil(F.count("*") / block).cast("int").alias("parts")).checkpoint()
    near = parts.withColumn("home_cell", F.explode(_homes(F.col("cell")))).withColumnRenamed("cell", "own_cell")
    home = parts.withColumnRenamed("parts", "home_parts")
    near = join_on(near.withColumnRenamed("home_cell", "cell"), home, _CELL).checkpoint()
    others = near.groupBy(*_CELL).agg(F.max("parts").alias("others"))
    # A cell is near 2 * 3 ** (DEPTH - 1) cells at most.
    homes = F.collect_list(F.struct(F.col("cell").alias("home_cell"), "home_parts")).alias("homes")
    homes = near.groupBy("label", "dim", "list", "own_cell", "parts").agg(homes).withColumnRenamed("own_cell", "cell")
    counts = placed.groupBy(*_CELL).agg(F.count("*").alias("n")).checkpoint()
    here = join_hot(placed, join_on(homes, others, _CELL), _CELL, counts, ["node"])
    here = here.withColumn("mine", F.pmod(F.xxhash64("node", F.lit("block")), F.col("parts")).cast("int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    at_home = here.withColumn("home_part", F.col("mine")).withColumn("other_part", every("others"))
    as_other = here.withColumn("near", F.explode("homes")).withColumn("cell", F.col("near.home_cell"))
    as_other = as_other.withColumn("other_part", F.col("mine")).withColumn("home_part", every("near.home_parts"))
    columns = [*_CELL, "home_part", "other_part", "node", "copies", "vector"]
    true, false = F.lit(True), F.lit(False)
    return at_home.select(*columns, true.alias("home"), false.alias("other")).unionByName(
        as_other.select(*columns, false.alias("home"), true.alias("other"))
    )


def block_links(table: pa.Table, calibration: Calibration, threshold: float = THRESHOLD) -> pa.Table:
    """The links between the home and the other vectors of one pair of blocks.

    Columns ``node, copies, vector, home, other, cell, list`` come in; ``a, b`` with a null ``n`` is an
    edge of a star, and ``a`` with ``n`` a number of links that the task has found for a node.
    """
    unit = _unit(table)
    node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
    home, other = table.column("home").to_numpy(), table.column("other").to_numpy()
    which, depth = table.column("list")[0].as_py(), len(table.column("cell")[0])
    places = unit @ directions(unit.shape[1])
    own = places[:, _of_list(which, 1).start]
    # A window's lower member is at home here; ties go by node.
    order = np.lexsort((node, own))
    homes, others = order[home[order]], order[other[order]]
    sort = own[others]
    found = np.zeros(len(node), np.int64)
    label = np.arange(len(node))
    for at in range(0, len(homes), _STEP):
        h = homes[at : at + _STEP]
        low, high = np.searchsorted(sort, own[h[0]]), np.searchsorted(sort, own[h[-1]] + calibration.window, side="right")
        for start in range(low, high, 16 * _STEP):
            o = others[start : min(start + 16 * _STEP, high)]
            gap = own[o][None, :] - own[h][:, None]
            pairs = (gap > 0) | ((gap == 0) & (node[o][None, :] > node[h][:, None]))
            pairs &= gap <= calibration.window
            hits, met = np.zeros(pairs.shape, np.int8), [np.ones(pairs.shape, bool) for _ in range(which + 1)]
            for k in range(places.shape[1]):
                near = np.abs(places[o, k][None, :] - places[h, k][:, None]) <= calibration.window
                hits += near
                if k // DEPTH <= which and k % DEPTH < depth:
                    met[k // DEPTH] &= near
            pairs &= met.pop()
            for earlier in met:  # a pair belongs to the first list on which it collides
                pairs &= ~earlier
            pairs &= hits >= calibration.count
            rows, columns = np.flatnonzero(pairs.any(axis=1)), np.flatnonzero(pairs.any(axis=0))
            if not len(rows):
                continue
            linked = pairs[np.ix_(rows, columns)] & (unit[h[rows]] @ unit[o[columns]].T >= threshold)
            i, j = np.nonzero(linked)
            if not len(i):
                continue
            a, b = h[rows[i]], o[columns[j]]
            np.add.at(found, a, copies[b])
            np.add.at(found, b, copies[a])
            # Joined with what earlier steps have found.
            roots, flat = np.unique(np.r_[label[a], label[b]], return_inverse=True)
            joined = smallest_labels(len(roots), flat[: len(a)], flat[len(a) :])
            become = np.arange(len(node))
            become[roots] = roots[joined]
            label = become[label]
    some, moved = np.flatnonzero(found), np.flatnonzero(label != np.arange(len(node)))
    a = pa.array(np.r_[node[some], node[moved]])
    b = pa.array(np.r_[np.zeros(len(some), np.int64), node[label[moved]]])
    n = pa.array(np.r_[found[some], np.zeros(len(moved), np.int64)])
    return pa.table({"a": a, "b": b, "n": n})


def embedding_near_dedup(
    df: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """``(id_col, n_links, component_id, kept)``, one row per vector.

    Vectors link if their labels are equal and not null, they have as many components, and their cosine in
    double precision is at least ``threshold``. ``n_links`` counts the other rows a row links with directly,
    ``component_id`` is the smallest id reachable, ``kept`` says whether that is the row's own id. Vectors
    that are null, empty or zero or hold null or non-finite components link with nothing, nor do rows with a
    null label. Equal vectors of a label are one in the search; every such copy counts as a link.
    """
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    links = usable(F.col("vector")) & F.col("label").isNotNull()
    rows = stored(rows.withColumn("node", F.when(links, F.xxhash64("label", F.size("vector"), "vector"))), "vectors")
    linkable = rows.filter(F.col("node").isNotNull())
    distinct = linkable.groupBy("label", "vector", "node").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    distinct = stored(distinct.withColumn("dim", F.size("vector")), "distinct-vectors")
    limits = calibrate(threshold)
    placed = cells_of(distinct.select("label", "dim", "node", "copies", "vector"), limits.window)
    placed = stored(placed_on_lists(stored(placed, "vector-cells"), block), "placed-vectors")
    dealt = dealt_blocks(placed, block)

    def link(table: pa.Table) -> pa.Table:
        return block_links(table, limits, threshold)

    found = dealt.groupBy(*_CELL, "home_part", "other_part").applyInArrow(link, "a bigint, b bigint, n bigint")
    found = stored(found, "links")
    counts = found.filter("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = connected_components(found.filter("n = 0").select("a", "b"))
    named = distinct.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = named.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("n")).checkpoint()
    nodes = join_hot(named.select("node", "copies", "root"), groups.drop("n"), ["root"], groups, ["node"])
    nodes = nodes.join(counts.withColumnRenamed("n", "found"), "node", "left")
    nodes = nodes.select("node", "component", (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    copies = distinct.select("node", F.col("copies").alias("n"))
    linked = join_hot(linkable.select("id", "node"), nodes, ["node"], copies, ["id"], "left")
    alone = rows.filter(F.col("node").isNull()).select("id")
    out = linked.select("id", "component", "n_links").unionByName(alone, allowMissingColumns=True)
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
