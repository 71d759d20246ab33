"""Held-out accuracy, and the cases without an answer."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spikewatch.llm import language

LETTERS = {
    "en": "the and of ing tion er",
    "de": "der und sch ung ein ich",
    "fr": "les que eau oir une est",
    "es": "los que cion ado las el",
    "fi": "ja on inen ssa kaa yy",
}


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(1)
    rows = []
    for n in range(400):
        lang = list(LETTERS)[n % 5]
        parts = LETTERS[lang].split()
        words = ["".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(rng.integers(8, 60))]
        rows.append((n, " ".join(words), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(docs):
    held = F.col("doc_id") % 4 == 2
    model = language.fit(docs.filter(~held), per_language=50)
    assert model.languages == sorted(LETTERS)
    assert set(model.pairs) == {("de", "en"), ("es", "fr")}
    assert set(model.families) == {("germanic",), ("romance",), ("uralic",)}
    rows = docs.filter(held).select("lang", language.predict(F.col("text"), model).alias("p")).collect()
    assert sum(r.lang == r.p.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.p.score <= 1 for r in rows)


def test_no_letters_no_language(spark, docs):
    model = language.fit(docs)
    texts = [(None,), ("",), (" 12 !? \n",), ("x",), ("the and " * 50_000,)]
    odd = spark.createDataFrame(texts, "text string")
    rows = odd.select("text", language.predict(F.col("text"), model).alias("p")).collect()
    assert [(r.p.lang_pred, r.p.score) for r in rows[:3]] == [("und", 0.0)] * 3
    assert rows[3].p.lang_pred in LETTERS and rows[4].p.lang_pred == "en"


def test_little_to_learn_from(spark, docs):
    one = language.fit(docs.filter("lang = 'fr'"))
    assert one.predict("anything") == ("fr", 1.0)
    nothing = language.fit(docs.filter("lang IS NULL"))
    assert nothing.predict("anything") == ("und", 0.0)
    assert docs.limit(0).select(language.predict(F.col("text"), one)).collect() == []


def test_fit_is_repeatable_and_separates():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(60, 20)).astype(np.float32)
    signs = np.where(vectors[:, 0] > 0, 1.0, -1.0)
    vectors[:, 0] += signs
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    weights = language.fit_machine(vectors, signs)
    assert (weights == language.fit_machine(vectors, signs)).all()
    assert (np.sign(vectors @ weights[:-1] + weights[-1]) == signs).all()
