from __future__ import annotations

import collections
import re
import struct

import pytest
import xxhash

from logtally.llm import mixing, queries

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string"


def size_of(text: str | None) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def slow_targets(sizes: dict[str | None, int], share=1.5, most=2.0) -> dict[str | None, float]:
    """Share by weight, cap, share the excess among the others, until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total = share * sum(sizes.values())
    target, fixed = {}, set()
    while len(fixed) < len(order):
        rest = total - sum(target[s] for s in fixed)
        scale = sum(weight[s] for s in order if s not in fixed)
        now = {s: rest * weight[s] / scale for s in order if s not in fixed}
        over = {s for s in now if now[s] > most * sizes[s]}
        if not over:
            return {**{s: target[s] for s in fixed}, **now}
        for s in over:
            target[s] = most * sizes[s]
        fixed |= over
    return target


def slow_taken(docs, targets) -> dict[int, int]:
    """Go round each source's shuffled words until its rounded target is reached."""

    def order(doc_id, text):
        mixed = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
        mixed = xxhash.xxh64_intdigest(struct.pack("<Q", xxhash.xxh64_intdigest(text.encode(), 42)), mixed)
        mixed = xxhash.xxh64_intdigest(b"mixing order", mixed)
        return mixed - 2**64 if mixed >= 2**63 else mixed

    chunks = max(1, -(-len(docs) // mixing.CHUNK))
    streams = collections.defaultdict(list)
    for doc_id, source, text in docs:
        if size := size_of(text):
            streams[source].append((order(doc_id, text) % chunks, order(doc_id, text), doc_id, size))
    taken = collections.Counter({doc_id: 0 for doc_id, *_ in docs})
    for source, stream in streams.items():
        left = int(targets[source] + 0.5)
        while left > 0:
            for *_, doc_id, size in sorted(stream):
                taken[doc_id] += min(size, left)
                left -= min(size, left)
    return taken


def whole_times(taken: int, size: int) -> int:
    """How often a document is taken as a whole: once more if at least half of it is due."""
    return taken // size + (2 * (taken % size) >= size) if size else 0


def check(rows, docs):
    sizes = collections.Counter()
    for _, source, text in docs:
        sizes[source] += size_of(text)
    targets = slow_targets(sizes)
    taken = slow_taken(docs, targets)
    assert len(rows) == len(docs)
    for row in rows:
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(targets[row["source"]], rel=1e-9)
        assert row["taken"] == taken[row["doc_id"]] <= 2 * row["size"]
    return taken


def test_the_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["source"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = queries.op3_mixing(spark, folder).collect()
    check(rows, docs)
    assert sorted(map(tuple, queries.op3_mixing(spark, folder).collect())) == sorted(map(tuple, rows))


def test_small_blocks_and_uneven_sources(spark):
    docs = [(k, "big" if k % 3 else f"s{k % 30}", "w " * (k % 17 + (900 if k == 5 else 0))) for k in range(300)]
    docs += [(1000, None, "a b c"), (1001, "", "x"), (1002, "é", None), (1003, "zero", " \n")]
    df = spark.createDataFrame([(i, t, "en", s, len(t or ""), "clash") for i, s, t in docs], SCHEMA)
    rows = mixing.mixture(df, block=7).collect()
    taken = check(rows, docs)
    taken = {row["doc_id"]: row["taken"] for row in mixing.mixture(df).collect()}
    mixed = mixing.mix(df).collect()
    assert {r["size"] for r in mixed} == {"clash"} and {(r["doc_id"], r["text"]) for r in mixed} <= {(i, t) for i, _, t in docs}
    times = collections.Counter(row["doc_id"] for row in mixed)
    assert times == +collections.Counter({i: whole_times(taken[i], size_of(t)) for i, _, t in docs})
    assert len([i for i, _, t in docs if taken[i] % max(1, size_of(t))]) <= len({s for _, s, _ in docs})


def test_slots_follow_the_weights_everywhere(spark):
    goals = spark.createDataFrame([("a", 100_000, 50_000.0), ("b", 40_000, 30_000.0), ("c", 10_000, 20_000.0), ("d", 9, 3.0)], "source string, source_size bigint, target double")
    slots = sorted(mixing.schedule(goals, 50).collect())
    words = collections.Counter()
    for at, row in enumerate(slots):
        words[row["source"]] += row["words"]
        if at >= 100:
            for source, target in (("a", 50_000), ("b", 30_000), ("c", 20_000)):
                assert abs(words[source] - (at + 1) * 50 * target / 100_003) < 50 * 12
    assert words == {"a": 50_000, "b": 30_000, "c": 20_000, "d": 3}
    rounds = collections.Counter((r["source"], r["block"]) for r in slots)
    assert max(rounds.values()) == 2 and set(n for (s, _), n in rounds.items() if s == "c") == {2}


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, "a b c d", "en", "s", 7, "x")] * 3 + [(None, "e f", None, None, None, None)] * 2 + [(2, "g " * 50, "en", "t", 100, "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mixture(df).collect()
    assert len(out) == len(rows) and all(r["taken"] <= 2 * r["size"] for r in out)
    times = collections.Counter(r["text"] for r in mixing.mix(df).collect())
    taken = collections.Counter()
    for r in out:
        taken[r["size"]] += r["taken"]
    assert times == +collections.Counter({t: whole_times(taken[size_of(t)], size_of(t)) for t in {r[1] for r in rows}})


def test_rows_without_id_are_dealt_over_all_chunks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 64)
    rows = [(None, f"text number {k}", "en", "s", 1, "x") for k in range(1000)]
    chunks = mixing._streams(spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "source", "3L AS size", "xxhash64(text) AS digest"), 1000)
    assert sorted(r["start"] for r in chunks.collect()) == list(range(0, 3000, 3))
    dealt = spark.createDataFrame(rows, SCHEMA).selectExpr("pmod(xxhash64(doc_id, xxhash64(text), 'mixing order'), 16) AS chunk").groupBy("chunk").count().collect()
    assert len(dealt) == 16 and max(r["count"] for r in dealt) < 130


def test_empty_tables_and_blank_texts(spark):
    df = spark.createDataFrame([(1, "a", "en", "s", 1, "x")], SCHEMA)
    assert mixing.mixture(df.limit(0)).count() == 0
    assert mixing.mix(df.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, " ", "en", "s", 1, "x"), (2, None, "en", "s", 0, "x")], SCHEMA)
    assert [r["taken"] for r in mixing.mixture(blank).collect()] == [0, 0]
