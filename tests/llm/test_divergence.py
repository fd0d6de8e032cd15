from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from logtally.llm import divergence
from logtally.llm.divergence import Stripes, rates, source_divergences, stripes, term_counts

SCHEMA = "doc_id bigint, text string, lang string, source string, term string, part int, rank string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow(rows, least=3, top=200):
    of, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(LOWER))
        of[lang, source].update(terms)
        df[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in df[lang].items() if n >= least]
        sources = [s for other, s in groups if other == lang]

        def rate(counts):
            return {t: 1 + 1_000_000_000 * (counts[t] + 1) // (sum(counts[k] for k in kept) + len(kept)) for t in kept}

        p, whole = rate(of[lang, source]), Counter()
        for s in sources:
            whole.update(of[lang, s])
        q = rate(whole)
        pairs = []
        for s in sources:
            if s != source:
                other = rate(of[lang, s])
                pairs.append((s, sum((p[t] - other[t]) ** 2 // other[t] for t in kept)))
        terms = [(t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if of[lang, source][t] and p[t] > q[t]]
        for part, items in (("pair", pairs), ("term", terms)):
            items.sort(key=lambda i: (-i[1], i[0].encode()))
            out += [(lang, source, part, i, v, k) for k, (i, v) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def check(spark, rows, parts=3, **limits):
    df = spark.createDataFrame([(k, *r, "clash", 1, "clash") for k, r in enumerate(rows)], SCHEMA).repartition(parts)
    assert sorted(map(tuple, source_divergences(df, **limits).collect())) == slow(rows, **limits)


def corpus(number=200):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)] + ["Éa", "éa", "ß", "日本", "ABC"]
    rows = []
    for k in range(number):
        chosen = rng.choice(len(vocabulary), rng.integers(1, 40), p=np.arange(len(vocabulary), 0, -1) / (len(vocabulary) * (len(vocabulary) + 1) / 2))
        rows.append((" ".join(vocabulary[c] for c in chosen), ["en", "de", "xx"][k % 3], f"s{k % 4 if k % 2 else 0}"))
    return rows


def test_divergences_are_those_of_plain_python(spark):
    check(spark, corpus())


def test_odd_rows(spark):
    rows = corpus(40) + [(None, "en", "s1"), ("", None, None), ("!!! 12", "", "only"), ("a b c", None, ""), ("a b", "", None), ("A,B", "", "")]
    rows += [("same text Of words", "en", "hot")] * 60 + [("lone", "solo", "one")] * 3 + [(None, "void", "a"), (None, "void", "b")]
    check(spark, rows)


def test_many_shards_parts_and_small_ranks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD_ENTRIES", 37)
    monkeypatch.setattr(divergence, "TASK_PAIRS", 5)
    check(spark, corpus(), top=7)


def test_blocks_of_a_shard(spark, monkeypatch):
    rows = corpus(60)
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    found = divergence.merged_stripes(stripes(df)).filter("lang = 'en'").toArrow()
    names = sorted({r[2] for r in rows if r[1] == "en"})
    entry = list(zip(found.column("source").to_pylist(), found.column("count").to_pylist(), strict=True))
    totals = [sum(c for s, n in entry for k, c in zip(s, n, strict=True) if k == name) for name in names]
    import pyarrow as pa

    groups = pa.table({"lang": ["en"] * len(names), "source": names, "total": totals, "kept": [len(found)] * len(names), "mine": [True] * len(names)})
    whole = divergence.shard_divergences(found.select(["lang", "term", "source", "count"]), groups).to_pylist()
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 9)
    assert divergence.shard_divergences(found.select(["lang", "term", "source", "count"]), groups).to_pylist() == whole


def test_spilled_stripes_merge(spark):
    held = Stripes()
    for _ in range(3):
        held.fold("en", "a", b"one two two")
    first = [r for b in held.rows() for r in b.to_pylist()]
    held.fold("en", "b", b"two")
    second = [r for b in held.rows() for r in b.to_pylist()]
    assert held.number == 0 and list(held.rows()) == []
    df = spark.createDataFrame(first + second, "lang string, term string, df bigint, sources array<string>, counts array<bigint>")
    merged = {r["term"]: (r["df"], dict(zip(r["source"], r["count"], strict=True))) for r in divergence.merged_stripes(df).collect()}
    assert merged == {"one": (3, {"a": 3}), "two": (4, {"a": 6, "b": 1})}


def test_terms_of_long_texts(monkeypatch):
    monkeypatch.setattr(divergence, "_PIECE", 10)
    text = "Ab1cd É-é " * 500 + "x" * 1000
    expected = Counter(t.encode() for t in TERM.findall(text.translate(LOWER)))
    assert term_counts(text.encode()) == expected
    assert term_counts(None) == term_counts(b"") == Counter()


@pytest.mark.parametrize("total", [10, 10**9, 9 * 10**15])
def test_rates_do_not_overflow(total):
    counts = np.array([0, 1, total // 3, total - 1])
    assert rates(counts, total).tolist() == [1 + 10**9 * (c + 1) // total for c in counts.tolist()]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert source_divergences(df).count() == 0
