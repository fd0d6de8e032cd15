from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from logtally.llm import language_id, queries

WORDS = {
    "xx": ["kalo", "mirat", "sebu", "tolan", "dike", "ruma"],
    "yy": ["schtrum", "verpfel", "grotz", "unge", "zwicht", "brack"],
    "zz": ["éloui", "çava", "nêtre", "oiseau", "queau", "ré"],
}


def text(rng: random.Random, lang: str, n: int) -> str:
    return " ".join(rng.choices(WORDS[lang], k=n)).capitalize() + "."


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = [(k, text(rng, lang, rng.randint(3, 60)), lang) for k, lang in enumerate(rng.choices([*WORDS], [8, 2, 2], k=600))]
    rows += [(None, "kalo kalo", "xx"), (9001, None, "xx"), (9002, "123", "yy"), (9003, "kalo", None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


@pytest.fixture(scope="module")
def model(labelled):
    return language_id.train(labelled, per_language=100)


def test_subwords_of_a_batch_are_those_of_each_text():
    texts = ["Ab c", "", None, "ÉÀ!", "  x", "a-b", "1 2 3", "日本", "word " * 40]
    together, counts = language_id.subwords(texts)
    alone = [language_id.subwords([t]) for t in texts]
    assert counts.tolist() == [int(c[0]) for _, c in alone]
    assert np.array_equal(together, np.concatenate([b for b, _ in alone]))
    # "x": two bigrams and the trigram with both marks.
    assert counts[4] == 3 and counts[6] == 0


def test_unseen_texts_are_identified(spark, model):
    rng = random.Random(2)
    rows = [(k, text(rng, lang, 6), lang, "clash") for k, lang in enumerate([*WORDS] * 60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, truth string, score string")
    out = language_id.identify(df, model).collect()
    assert np.mean([r["lang_pred"] == r["truth"] for r in out]) == 1
    assert all(0 < r["score"] <= 1 for r in out)
    assert np.mean([r["accepted"] for r in out]) > 0.9


def test_texts_without_letters_and_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, "a"), (4, "a"), (None, "kalo mirat"), (5, "kalo " * 60_000), (6, "\U0001f600 \x00")]
    out = language_id.identify(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()
    assert len(out) == len(rows)
    none = [r for r in out if r["lang_pred"] == "und"]
    assert {r["doc_id"] for r in none} == {1, 2, 3, 6} and all(r["score"] == 0 and not r["accepted"] for r in none)
    assert {r["lang_pred"] for r in out if r["doc_id"] in (None, 5)} == {"xx"}


def test_nothing_learned(spark, labelled):
    empty = language_id.train(labelled.limit(0))
    assert {r["lang_pred"] for r in language_id.identify(labelled, empty).collect()} == {"und"}
    assert language_id.identify(labelled.limit(0), empty).count() == 0
    one = language_id.train(labelled.filter("lang = 'xx'"))
    out = language_id.identify(labelled.filter("lang = 'yy' and text != '123'"), one).collect()
    assert {r["lang_pred"] for r in out} == {"xx"} and {r["score"] for r in out} == {1.0}


def test_training_is_repeatable(labelled):
    a, b = (language_id.train(labelled.repartition(n), per_language=80) for n in (2, 5))
    assert np.array_equal(a.logits, b.logits) and a.threshold == b.threshold


def test_any_number_of_languages(spark):
    rng = random.Random(8)
    own = {f"l{k:03d}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzéüñøß", k=5)) for _ in range(4)] for k in range(300)}
    rows = [(k, " ".join(rng.choices(own[lang], k=8)), lang) for k, lang in enumerate([*own] * 12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.train(df)
    assert len(model.languages) == 300 and model.table.shape[0] == language_id.DIM
    bucket, counts = language_id.subwords(["kalo"])
    _, score = model.scores(["kalo"])
    assert score[0] == pytest.approx(language_id.softmax((model.logits[bucket].mean(axis=0) + model.bias)[None] / model.temperature).max(), rel=1e-4)
    out = language_id.identify(df, model).collect()
    assert len({r["lang_pred"] for r in out}) > 256
    # Ten rows of eight words teach each of them.
    assert np.mean([r["lang_pred"] == r["lang"] for r in out]) > 0.75


def test_repeated_rows_are_one_in_the_sample(spark):
    rows = [(1, "kalo mirat", "xx")] * 3000 + [(None, "verpfel grotz", "yy")] * 2000 + [(k, f"oiseau n{k}", "zz") for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    sample = language_id.training_sample(df, "doc_id", "text", "lang", 300, 10).groupBy("lang").count().collect()
    found = {r["lang"]: r["count"] for r in sample}
    assert found.get("xx", 0) <= 1 and found.get("yy", 0) <= 1 and 200 < found["zz"] < 400


def test_strange_texts_are_rejected_more_often(spark, model):
    rng = random.Random(3)
    rows = [(k, " ".join("".join(rng.choices("bcdfghjklmnpqrstvwxz", k=6)) for _ in range(2))) for k in range(200)]
    out = language_id.identify(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()
    assert np.mean([r["accepted"] for r in out]) < 0.7


def test_the_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = queries.op1_language_id(spark, folder).collect()
    assert len(out) == len(truth)
    for row in out:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
    kept = [r for r in out if r["held_out"] and truth[r["doc_id"]][0]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]][0] for r in kept]) > 0.97
