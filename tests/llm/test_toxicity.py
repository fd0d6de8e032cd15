from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from logtally.llm import queries, toxicity
from logtally.llm.toxicity import ToxicityModel, feature_set, fit, swaps, words

FILLER = [f"word{k}" for k in range(60)]


def sentence(rng: random.Random, *more: str) -> str:
    found = [*rng.choices(FILLER, k=rng.randint(4, 30)), *more]
    rng.shuffle(found)
    return " ".join(found).capitalize() + "."


def corpus(rng: random.Random, n: int, rare: float = 0.0) -> list[tuple[str, int]]:
    """Insults make a text toxic; one group is mentioned mostly in toxic texts, another in neutral ones.

    A share of ``rare`` of the toxic texts has insults that occur only once.
    """
    rows = []
    for k in range(n):
        if k % 3 == 0:
            known = rng.choice(["fool", "vermin", "grolma", "grolti", "groles"])
            insult = f"{rng.randint(0, 10**9)}once" if rng.random() < rare else known
            rows.append((sentence(rng, insult, *["muslim"] * (rng.random() < 0.8)), 1))
        else:
            rows.append((sentence(rng, *["christian"] * (rng.random() < 0.5), *["muslim"] * (rng.random() < 0.05)), 0))
    return rows


def trained(rows, strength: float) -> ToxicityModel:
    pairs = [([*a], [*b]) for t, _ in rows for a, b in swaps(t)]
    return fit([sorted(feature_set(words(t))) for t, _ in rows], [y for _, y in rows], pairs, counterfactual=strength, sparsity=1e-3)


def test_swaps_are_feature_changes_of_one_sentence():
    found = swaps("A man came. Nothing here. MUSLIM neighbours")
    before = feature_set({"a", "man", "came"})
    expected = feature_set({"a", "woman", "came"})
    assert (frozenset(expected - before), frozenset(before - expected)) in found
    assert len(found) == 4 + 7
    assert swaps(None) == swaps("no such word") == []


def test_neutral_mentions_score_less_with_the_counterfactual_penalty():
    rng = random.Random(1)
    rows = corpus(rng, 900, rare=0.4)
    plain, regular = trained(rows, 0.0), trained(rows, 20.0)
    neutral = [sentence(rng, "muslim") for _ in range(200)]
    other = [t.replace("muslim", "buddhist").replace("Muslim", "Buddhist") for t in neutral]
    toxic = [sentence(rng, "vermin") for _ in range(200)]
    assert regular.scorer()(neutral).mean() < plain.scorer()(neutral).mean() - 0.2
    gap = lambda m: np.abs(m.scorer()(neutral) - m.scorer()(other)).mean()
    assert gap(regular) < 0.5 * gap(plain)
    assert (regular.scorer()(toxic) >= 0.5).mean() > 0.95
    assert (regular.scorer()(neutral) >= 0.5).mean() < 0.05


def test_unseen_forms_of_a_stem_are_found():
    rng = random.Random(2)
    model = trained(corpus(rng, 900), 1.0)
    assert (model.scorer()([sentence(rng, "grolnew") for _ in range(100)]) >= 0.5).mean() > 0.9


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    rows = corpus(rng, 600)
    docs = spark.createDataFrame([(k, t, "clash", 1) for k, (t, _) in enumerate(rows)], "doc_id bigint, text string, score string, label int")
    labels = [(k, y) for k, (_, y) in enumerate(rows)] + [(0, 0), (1, None), (None, 1), (77_777, 1), (5, 7)]
    return docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), rows


def test_train_and_classify(spark, tables):
    docs, labels, rows = tables
    model = toxicity.train(docs, labels, per_class=150)
    out = {r["doc_id"]: r for r in toxicity.classify(docs, model).collect()}
    assert np.mean([out[k]["predicted"] == y for k, (_, y) in enumerate(rows)]) > 0.97
    odd = [(1, None), (2, ""), (2, ""), (None, "vermin"), (3, "word1 " * 100_000 + "vermin")]
    found = toxicity.classify(spark.createDataFrame(odd, "doc_id bigint, text string"), model).collect()
    scores = {r["doc_id"]: r["score"] for r in found}
    assert len(found) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    assert scores[None] > 0.5 and scores[1] == scores[2] < 0.5
    again = toxicity.train(docs.repartition(5), labels.repartition(3), per_class=150)
    assert again.weights == model.weights
    assert toxicity.classify(docs.limit(0), model).count() == 0


def test_without_both_classes(tables):
    docs, labels, _ = tables
    none = toxicity.train(docs, labels.limit(0))
    assert toxicity.classify(docs, none).filter("predicted = 1").count() == 0
    every = toxicity.train(docs, labels.filter("toxic = 1"))
    assert toxicity.classify(docs, every).filter("predicted = 0").count() == 0


def test_the_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    out = queries.op5_toxicity(spark, folder).collect()
    held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["doc_id"] in labels]
    assert all(r["held_out"] for r in held)
    toxic = [r["predicted"] for r in held if labels[r["doc_id"]] == 1]
    clean = [r["predicted"] for r in held if labels[r["doc_id"]] == 0]
    # 350 toxic rows to learn from, some of them without any insult.
    assert np.mean(toxic) > 0.88 and np.mean(clean) < 0.02


@pytest.mark.parametrize("language", sorted(toxicity.IDENTITY_GROUPS))
def test_false_positives_on_neutral_mentions_in_each_language(spark, language):
    """The penalty learns from labelled rows that hold a term, whatever its language; toxic mentions are still found."""
    rng = random.Random(language)
    term, other = toxicity.IDENTITY_GROUPS[language][1][:2]
    rows = [(t.replace("muslim", term).replace("Muslim", term).replace("christian", other), y) for t, y in corpus(rng, 900, rare=0.4)]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, y) for k, (_, y) in enumerate(rows)], "doc_id bigint, toxic int")
    neutral = [sentence(rng, term) for _ in range(200)]
    toxic = [sentence(rng, term, "vermin") for _ in range(200)]
    rate = {}
    for strength in (0.0, 20.0):
        score = toxicity.train(docs, labels, counterfactual=strength).scorer()
        rate[strength] = (score(neutral) >= 0.5).mean(), (score(toxic) >= 0.5).mean()
    assert rate[0.0][0] > 0.5 and rate[20.0][0] < 0.05, rate
    assert rate[20.0][1] > 0.95, rate


def test_a_repeated_id_gives_one_row_of_the_sample(spark):
    docs = spark.createDataFrame([(1, f"text number {k % 9}") for k in range(300)] + [(2, "another text")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int")
    sample = [toxicity.training_sample(docs.repartition(n), labels, per_class=2).filter("kind = 0").collect() for n in (1, 4)]
    assert sorted(r["label"] for r in sample[0]) == [0, 1]
    assert sorted(map(str, sample[0])) == sorted(map(str, sample[1]))


def test_swaps_of_a_long_text_are_of_all_its_sentences():
    early, late = (" ".join(f"A {term} came." for k in groups for term in toxicity.IDENTITY_GROUPS["en"][k]) for groups in ((0, 1), (6, 7)))
    for limit in (10, 30):
        found = swaps(f"{early} {late}", limit)
        assert len(found) == limit and set(found) <= set(swaps(f"{early} {late}", 10_000))
        assert set(found) - set(swaps(early, 10_000)) and set(found) - set(swaps(late, 10_000))
        assert set(swaps(f"{late} {early}", limit)) == set(found)
