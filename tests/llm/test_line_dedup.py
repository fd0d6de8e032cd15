from __future__ import annotations

import collections
import re

from logtally.llm.line_dedup import boilerplate, line_dedup, near_margin, occurrences

BLANK = " \t\n\x0b\f\r"
SCHEMA = "doc_id bigint, text string, source string, removed string, id string, first int"


def slow(rows, min_sites=4, min_words=3):
    sites, first = collections.defaultdict(set), {}
    for doc_id, text, site in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        for pos, raw in enumerate((text or "").split("\n")):
            line = raw.strip(BLANK)
            if text is not None and len(re.findall(r"[^\x20\x09-\x0D]+", line)) >= min_words:
                sites[line].add(site or "")
                first.setdefault(line, (doc_id, text, pos))
    out = {}
    for doc_id, text, _ in rows:
        gone = []
        for pos, raw in enumerate((text or "").split("\n")):
            line = raw.strip(BLANK)
            if len(sites.get(line, ())) >= min_sites and first[line] != (doc_id, text, pos):
                gone.append(pos)
        out[doc_id, text] = gone
    return out


def check(spark, rows, **limits):
    df = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], SCHEMA)
    out = line_dedup(df, **limits).collect()
    gone = slow(rows, **limits)
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", tuple(r["removed_lines"])) for r in out)
    expected = []
    for doc_id, text, _ in rows:
        kept = "\n".join(line for pos, line in enumerate((text or "").split("\n")) if pos not in gone[doc_id, text])
        expected.append((doc_id is None, doc_id or 0, kept, tuple(gone[doc_id, text])))
    assert found == sorted(expected)
    assert {r["removed"] for r in out} == {"clash"}


def test_lines_on_many_sites_go(spark):
    rows = [(k, f"line {k} of its own\nAll rights reserved here. \nshort one\n\ntail {k} it is", f"site{k % 6}") for k in range(40)]
    rows += [(100, None, "site1"), (101, "", None), (102, "All rights reserved here.", None), (103, "\n\n", "x"), (None, "All rights reserved here.", "y")]
    rows += [(104, "the same line here\n" * 5, "z"), (105, "on three sites only\nx", "a"), (106, "on three sites only", "b"), (107, "on three sites only", "c")]
    check(spark, rows)


def test_repeated_rows_are_treated_alike(spark):
    rows = [(1, "one line of words\nother", "a")] * 3 + [(2, "one line of words", s) for s in "bcd"]
    check(spark, rows)


def test_counts_near_the_threshold_are_exact(spark):
    """With 16 registers an estimate is rough; lines on 30 to 50 sites are told apart all the same."""
    assert near_margin(40, 4) > 20
    rows = [(100 * n + k, f"spread over {n} sites", f"site{k}") for n in range(30, 51) for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    lines = occurrences(df, "doc_id", "text", "source", 3)
    found = {r["first"]["id"] // 100 for r in boilerplate(lines, 40, 4).collect()}
    assert found == set(range(40, 51))


def test_long_text_and_empty_table(spark):
    many = "\n".join(f"line number {k}" for k in range(20_000))
    check(spark, [(k, many, f"s{k}") for k in range(4)])
    df = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert line_dedup(df).count() == 0
