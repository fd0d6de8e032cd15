from __future__ import annotations

import collections
import hashlib

import numpy as np
import pytest
import sentencepiece

import corpus_pipeline
from logtally.llm import queries, toxicity
from logtally.llm.common import held_out
from tests.llm import test_line_dedup, test_mixing, test_simhash

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return [tuple(r[c] for c in COLUMNS) for r in df.collect()]


def slow_line_dedup(docs):
    gone = test_line_dedup.slow([(i, t, s) for i, t, _, s, _ in docs])
    out = []
    for i, t, lang, s, n in docs:
        kept = "\n".join(line for k, line in enumerate((t or "").split("\n")) if k not in gone[i, t])
        out.append((i, t if t is None else kept, lang, s, len(kept) if gone[i, t] else n))
    return out


def slow_near_copies(docs):
    fps = np.array([test_simhash.slow_fingerprint(t) for _, t, *_ in docs], np.uint64)
    label = test_simhash.slow_components(fps)
    least = collections.defaultdict(list)
    for row, group in zip(docs, label.tolist(), strict=True):
        least[group].append(row[0])
    return [row for row, group in zip(docs, label.tolist(), strict=True) if row[0] == min(least[group])]


def slow_mix(docs):
    sizes = collections.Counter()
    for _, t, _, s, _ in docs:
        sizes[s] += test_mixing.size_of(t)
    taken = test_mixing.slow_taken([(i, s, t) for i, t, _, s, _ in docs], test_mixing.slow_targets(sizes))
    return [row for row in docs for _ in range(test_mixing.whole_times(taken[row[0]], test_mixing.size_of(row[1])))]


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage takes and makes, the stages run one by one as ``run`` does."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        made = corpus_pipeline.stored(stage(spark, docs, SF), name)
        out.append((name, docs, made))
        docs = made
    return out


def test_each_stage_returns_the_columns_of_documents(stages):
    assert [name for name, *_ in stages] == ["toxicity", "line_dedup", "simhash_near_dedup", "mixing", "sentencepiece"]
    for _, given, made in stages[:-1]:
        assert made.dtypes == given.dtypes


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    _, given, made = stages[0]
    model = toxicity.train(given.filter(~held_out("doc_id")), queries.table(spark, SF, "labels"))
    scorer = model.scorer()
    before = rows_of(given)
    keep = scorer([t for _, t, *_ in before]) < 0.5
    assert sorted(rows_of(made)) == sorted(row for row, ok in zip(before, keep, strict=True) if ok)
    assert 0.7 * len(before) < keep.sum() < len(before)


def test_boilerplate_lines_go(stages):
    _, given, made = stages[1]
    expected = slow_line_dedup(rows_of(given))
    assert sorted(rows_of(made)) == sorted(expected)
    assert expected != rows_of(given)


def test_one_of_each_group_stays(stages):
    _, given, made = stages[2]
    assert sorted(rows_of(made)) == sorted(slow_near_copies(rows_of(given)))
    assert made.count() < given.count()


def test_sources_are_mixed(stages):
    _, given, made = stages[3]
    assert sorted(rows_of(made)) == sorted(slow_mix(rows_of(given)))


def test_tokens(stages):
    _, given, made = stages[4]
    library = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path())
    expected = []
    for i, t, lang, s, _ in rows_of(given):
        ids = library.encode(t or "", add_eos=True)
        expected.append((i, lang, s, ids, len(ids), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted((r["doc_id"], r["lang"], r["source"], list(r["ids"]), r["n_tokens"], r["decoded_sha256"]) for r in made.collect()) == sorted(expected)


def test_the_whole(spark, stages):
    made = sorted(map(tuple, stages[-1][2].select("doc_id", "n_tokens", "decoded_sha256").collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "decoded_sha256").collect())) == made


def test_odd_rows_pass_through_every_stage(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    words = " ".join(f"w{k}" for k in range(300))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, words, "en", "a", len(words)), (3, words, "en", "a", len(words))]
    rows += [(4, words + " more", "en", None, 1), (None, "text of no id", "en", "b", 13), (5, "long " * 30_000, "en", "b", 150_000)]
    folder = str(tmp_path / "tables")
    for name, data in (("odd", rows), ("none", [])):
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/{name}/labels.parquet")
    out = corpus_pipeline.run(spark, f"{folder}/odd").collect()
    assert {r["doc_id"] for r in out} >= {3, 5}
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0


def test_each_group_of_null_or_repeated_ids_keeps_one_row(spark):
    text = lambda k: " ".join(f"w{k}x{n}" for n in range(200))
    rows = [(None, text(k), "en", "a", 1) for k in range(20)] + [(7, text(100 + k), "en", "b", 2) for k in range(20)]
    rows += [(8, text(200), "en", "a", 3), (None, text(200), "en", "a", 3), (9, text(200), "de", "a", 3)]  # near copies: the least id stays
    rows += [(5, text(300), None, "a", 4), (5, text(300), "a", None, 4), (5, text(300), "a", None, 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = [rows_of(corpus_pipeline.drop_near_copies(spark, df.repartition(n), "")) for n in (1, 3)]
    assert sorted(map(str, kept[0])) == sorted(map(str, kept[1]))
    assert sorted(t for _, t, *_ in kept[0]) == sorted({t for _, t, *_ in rows})
    assert [i for i, t, *_ in kept[0] if t == text(200)] == [8]
