from __future__ import annotations

import collections
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from logtally.llm import common, queries, substring_dedup
from logtally.llm.substring_dedup import GEAR, LEAST, MEAN, MOST, WINDOW, cuts, repeated_passages, rolling


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzé", k=rng.randint(2, 9))) for _ in range(n))


def slow_cuts(data: bytes) -> list[int]:
    out, last = [], 0
    for end in range(1, len(data) + 1):
        value = sum(int(GEAR[data[end - 1 - k]]) << k for k in range(min(WINDOW, end))) % 2**32
        if end - last >= LEAST and value < 2**32 // MEAN or end - last == MOST or end == len(data):
            out.append(end)
            last = end
    return out


def slow_passages(rows, min_words):
    firsts, chunks = {}, []
    order = sorted(set((i, t) for i, t in rows if t), key=lambda r: (r[0] is not None, r[0] or 0, xx(r[1])))
    for doc_id, text in order:
        raw = text.encode()
        start = 0
        for seq, end in enumerate(slow_cuts(raw)):
            piece = raw[start:end]
            chunks.append((doc_id, text, seq, start, end, piece))
            firsts.setdefault(piece, (doc_id, text, seq))
            start = end
    runs = collections.defaultdict(list)
    for doc_id, text, seq, start, end, piece in chunks:
        if firsts[piece] != (doc_id, text, seq):
            runs[doc_id, text].append((seq, start, end, firsts[piece][0]))
    out = []
    for (doc_id, text), found in runs.items():
        groups = collections.defaultdict(list)
        for rank, item in enumerate(found):
            groups[item[0] - rank].append(item)
        for group in groups.values():
            raw = text.encode()
            start, end = group[0][1], group[-1][2]
            blank = b" \t\n\x0b\x0c\r"
            words = sum(raw[k] not in blank and (k == 0 or raw[k - 1] in blank) for k in range(start, end))
            if words >= min_words:
                ids = [g[3] for g in group if g[3] is not None]
                out.append((doc_id, start, end, words, min(ids) if ids else None))
    return sorted(out, key=str)


def xx(text: str) -> int:
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - 2**64 if h >= 2**63 else h


def test_rolling_hash_and_cuts():
    rng = random.Random(1)
    for raw in (b"", b"a", b"a" * 3000, bytes(rng.randrange(256) for _ in range(3000)), prose(rng, 400).encode()):
        data = np.frombuffer(raw, np.uint8)
        if raw:
            at = len(raw) - 1
            assert rolling(data)[at] == sum(int(GEAR[raw[at - k]]) << k for k in range(min(WINDOW, at + 1))) % 2**32
        assert cuts(data) == slow_cuts(raw)
        assert all(LEAST <= b - a <= MOST for a, b in zip([0, *cuts(data)], cuts(data)[:-1], strict=False))


def test_an_insertion_moves_only_the_cuts_beside_it():
    rng = random.Random(2)
    text = prose(rng, 2000).encode()
    changed = text[:5000] + b"some words put in " + text[5000:]
    pieces = lambda raw: [raw[a:b] for a, b in zip([0, *cuts(np.frombuffer(raw, np.uint8))], cuts(np.frombuffer(raw, np.uint8)), strict=False)]
    assert len(set(pieces(changed)) - set(pieces(text))) <= 6


@pytest.mark.parametrize("words", [51, 80, 300])
def test_shared_passages_are_found_and_clean_texts_left_alone(spark, words):
    rng = random.Random(words)
    passage = prose(rng, words)
    rows = [(k, f"{prose(rng, 200)} {passage} {prose(rng, 150)}") for k in range(12)]
    rows += [(100 + k, prose(rng, 300)) for k in range(30)]
    df = spark.createDataFrame([(i, t, "clash", 3) for i, t in rows], "doc_id bigint, text string, digest string, row int")
    found = repeated_passages(df).collect()
    assert {r["doc_id"] for r in found} == set(range(1, 12))
    assert {r["first_id"] for r in found} == {0}
    texts = dict(rows)
    assert all(texts[r["doc_id"]].encode()[r["start"] : r["end"]].decode("utf-8", "ignore").strip() in passage for r in found)
    clean = {r["doc_id"]: r["text"] for r in substring_dedup.substring_dedup(df).collect()}
    assert len(clean) == len(rows) and clean[0] == texts[0] and clean[105] == texts[105]
    assert all(len(clean[k]) < len(texts[k]) - len(passage) // 3 for k in range(1, 12))


def test_against_brute_force_with_odd_rows(spark):
    rng = random.Random(5)
    shared = [prose(rng, 60) for _ in range(3)]
    rows = [(k, " ".join([prose(rng, rng.randint(0, 60)), *rng.choices(shared, k=rng.randint(0, 3)), prose(rng, 30)])) for k in range(40)]
    rows += [(50, None), (51, ""), (52, shared[0]), (52, shared[0]), (52, shared[0] + "!"), (None, shared[1]), (None, shared[1]), (53, "a" * 9000), (54, " \n" * 500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for least in (5, 25):
        found = [(r["doc_id"], r["start"], r["end"], r["n_words"], r["first_id"]) for r in repeated_passages(df, min_words=least).collect()]
        assert sorted(found, key=str) == slow_passages(rows, least)
    assert repeated_passages(df.limit(0)).count() == 0
    assert substring_dedup.substring_dedup(df.limit(0)).count() == 0


def test_the_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = [tuple(r) for r in queries.op2_substring_dedup(spark, folder).collect()]
    assert sorted(found, key=str) == slow_passages(rows, substring_dedup.MIN_WORDS)


def test_no_shared_passage_of_51_words_is_missed_for_its_cuts(spark):
    rng = random.Random(7)
    passages = [prose(rng, 51) for _ in range(120)]
    rows = [(2 * k + n, f"{prose(rng, 70)} {p} {prose(rng, 60)}") for k, p in enumerate(passages) for n in (0, 1)]
    texts = dict(rows)
    # A passage with a whole chunk of its own in both documents can be found; nearly all have one.
    ends = {i: set(cuts(np.frombuffer(t.encode(), np.uint8))) for i, t in rows}
    inside = {}
    for i, t in rows:
        at = t.encode().index(passages[i // 2].encode())
        inside[i] = {e - at for e in ends[i] if 0 <= e - at <= len(passages[i // 2].encode())}
    usable = {2 * k + 1 for k in range(len(passages)) if len(inside[2 * k] & inside[2 * k + 1]) > 1}
    assert len(usable) >= 0.95 * len(passages)
    found = repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"] for r in found} >= usable
    assert {r["doc_id"] % 2 for r in found} == {1}
    assert len(slow_passages(rows, substring_dedup.MIN_WORDS)) < len(usable)
    for r in found:
        piece = texts[r["doc_id"]].encode()[r["start"] : r["end"]]
        assert piece in texts[r["doc_id"] - 1].encode()
        assert len(piece.split()) - 1 <= r["n_words"] <= len(piece.split())


def test_places_beside_a_run_itself_are_not_joined(spark, monkeypatch):
    rng = random.Random(11)
    passages = [prose(rng, 51) for _ in range(30)]
    rows = [(100 * k + n, f"{prose(rng, 40)} {p} {prose(rng, 40)}") for k, p in enumerate(passages) for n in range(6)]
    rows += [rows[0], rows[1], (None, rows[2][1]), (None, rows[2][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = sorted(map(tuple, repeated_passages(df, min_words=45).collect()), key=str)
    seen, seeds = [], []

    def join_hot(left, right, keys, *others, **named):
        if "place" in keys:
            hot = others[0].filter(F.col("n") > common.HOT_ROWS).count()
            seen.append((left.count(), right.count(), others[0].count(), hot))
        return common.join_hot(left, right, keys, *others, **named)

    def extended(runs, *others):
        seeds.append(runs.count())
        return plain(runs, *others)

    plain = substring_dedup.extended
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    monkeypatch.setattr(substring_dedup, "join_hot", join_hot)
    monkeypatch.setattr(substring_dedup, "extended", extended)
    assert sorted(map(tuple, repeated_passages(df, min_words=45).collect()), key=str) == expected
    [(asked, found, places, hot)] = seen
    # Two places of first occurrences for each seed, and each of these places once, some of them asked for often.
    assert asked == 2 * seeds[0] > 0 and found == places < asked and hot > 0


def test_overlapping_passages_are_cut_once(spark, monkeypatch):
    spans = [(1, 0, 0, 10, 9, 0), (1, 0, 2, 5, 9, 0)]
    schema = "doc_id bigint, row bigint, start int, end int, n_words bigint, first_id bigint"
    df = spark.createDataFrame([(1, "0123456789abc")], "doc_id bigint, text string")
    row = df.selectExpr("xxhash64(text) AS h").first()["h"]
    made = spark.createDataFrame([(d, row, *rest) for d, _, *rest in spans], schema)
    monkeypatch.setattr(substring_dedup, "repeated_passages", lambda *_: made)
    assert [r["text"] for r in substring_dedup.substring_dedup(df).collect()] == ["abc"]
