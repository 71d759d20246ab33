"""Held-out accuracy, unseen misspellings, one training step against plain derivatives, odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spikewatch.llm import toxicity
from spikewatch.llm.toxicity import calibrate, fit, places, word_scores, worst_stretch

INSULTS = ["blockhead", "dimwitted", "lumpish", "mudbrain"]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    parts = "an er on th ti re in st ha le no ka mi".split()

    def text(toxic):
        words = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(12, 300))]
        for _ in range(1 + len(words) // 60 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(INSULTS) + rng.choice(["", ".", "s", "!"])
        return " ".join(words)

    return [(n, text(n % 8 == 0), int(n % 8 == 0)) for n in range(1600)]


@pytest.fixture(scope="module")
def model(spark, corpus):
    rows = [r for r in corpus if r[0] % 5]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    return fit(docs, labels, per_label=600)


def scores(spark, texts, model):
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n long, text string")
    found = docs.select("n", toxicity.toxicity(F.col("text"), model).alias("t")).orderBy("n")
    return [(r.t.score, r.t.predicted) for r in found.collect()]


def test_held_out_accuracy(spark, corpus, model):
    held = [r for r in corpus if r[0] % 5 == 0]
    found = scores(spark, [r[1] for r in held], model)
    wrong = sum(p != r[2] for (_, p), r in zip(found, held))
    assert wrong <= 0.02 * len(held)
    assert all(0 <= s <= 1 and p == int(s >= 0.5) for s, p in found)


def test_unseen_misspellings_and_long_texts(spark, model):
    clean = "thaner onre inst " * 40
    slips = "blockheadd onre dimmwitted "
    texts = [clean, clean + slips, clean * 500 + "mudbrain " + clean * 500, clean + "blockheadd"]
    found = scores(spark, texts, model)
    assert [p for _, p in found[:3]] == [0, 1, 1]
    assert found[3][0] > 5 * found[0][0]
    # The neighbourhood of a word, not the length of its text, decides.
    assert scores(spark, [clean * 1000], model)[0][1] == 0


def test_rows_without_words_and_repeated_rows(spark, model):
    found = scores(spark, [None, "", " \n", "!!", "blockhead", "blockhead"], model)
    assert len(set(found[:4])) == 1 and found[0][1] == 0
    assert found[4] == found[5] and found[4][1] == 1
    assert scores(spark, [], model) == []


def test_fit_is_repeatable_whatever_the_order(spark, corpus, model):
    rows = [r for r in corpus if r[0] % 5][::-1]
    docs = spark.createDataFrame([(*r[:2], "x", 1) for r in rows + rows[:50]], "doc_id long, text string, label string, toxic int")
    labels = spark.createDataFrame([(r[0], r[2], "y") for r in rows], "doc_id long, toxic int, text string")
    again = fit(docs.repartition(5), labels.repartition(3), per_label=600)
    assert (again.values == model.values).all() and again.shift == model.shift


@pytest.mark.parametrize("toxic, expected", [([0, 0], 0.0), ([1, 1], 1.0), ([None, 2], 0.0), ([], 0.0)])
def test_one_label_or_none(spark, toxic, expected):
    docs = spark.createDataFrame([(n, "a b") for n in range(2)], "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    assert scores(spark, ["a b", None, "c"], fit(docs, labels)) == [(expected, int(expected))] * 3


def test_sample_is_bounded(spark, corpus, monkeypatch):
    real = toxicity.fit_rows
    docs = spark.createDataFrame([(r[0] % 7, r[1]) for r in corpus], "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(7)], "doc_id long, toxic int")

    def measured(texts, labels, weights):
        assert len(texts) < 200 and sum(map(len, texts)) < 120_000
        return real(texts, labels, weights)

    monkeypatch.setattr(toxicity, "fit_rows", measured)
    fit(docs, labels, per_label=60, most_bytes=100_000)


def test_places_are_those_of_each_word_alone():
    words = ["a", "ab", "hello", "été", "x" * 50]
    every, counts = places(words)
    alone = [places([w])[0].tolist() for w in words]
    assert every.tolist() == [p for own in alone for p in own]
    marked = [len(w) + 2 for w in words]
    assert counts.tolist() == [1 + sum(max(m - n + 1, 0) for n in (3, 4, 5)) for m in marked]
    shared = set(places(["stupid"])[0].tolist()) & set(places(["stupidd"])[0].tolist())
    assert len(shared) >= 12


def test_worst_stretch():
    rng = np.random.default_rng(1)
    values = rng.normal(size=50)
    assert worst_stretch(values) == pytest.approx(max(values[i : i + 8].mean() for i in range(43)))
    assert worst_stretch(values[:3]) == pytest.approx(values[:3].mean())
    assert worst_stretch(values[:0]) is None


def test_word_scores_are_averages():
    values = np.random.default_rng(2).normal(size=toxicity.BUCKETS)
    for word, score in zip(["tree", "house"], word_scores(["tree", "house"], values)):
        assert score == pytest.approx(values[places([word])[0]].mean())


def test_calibration_meets_the_shares():
    """At the optimum the weighted mean chance equals the weighted share of label 1."""
    rng = np.random.default_rng(3)
    odds = rng.normal(size=500) * 3
    labels = (rng.random(500) < 1 / (1 + np.exp(-(2 * odds - 1)))).astype(int)
    weights = rng.random(500) + 0.1
    slope, shift = calibrate(odds, labels, weights)
    chance = 1 / (1 + np.exp(-(slope * odds + shift)))
    assert np.average(chance, weights=weights) == pytest.approx(np.average(labels, weights=weights), abs=1e-3)
    assert 1.2 < slope < 3 and -2 < shift < 0


def test_training_separates_by_gradient_steps():
    """A stretch with a telling word ends up with odds above one without."""
    words = ["good", "fine", "nasty", "calm"]
    numbers = np.array([0, 1, 3, 2, 1, 0] * 20)
    starts = np.arange(0, 121, 3)
    labels = np.tile([0, 1], 20)
    values, bias = toxicity.train(words, numbers, starts, labels)
    scores = word_scores(words, values)
    assert scores[[2, 1, 0]].mean() + bias > 0 > scores[[0, 1, 3]].mean() + bias
