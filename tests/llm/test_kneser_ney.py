"""The model against plain dictionaries, and verdicts on planted texts."""

import math
from collections import Counter

import pytest

from spikewatch.llm import kneser_ney
from spikewatch.llm.kneser_ney import shrunk, widened, BITS, ORDER, classes, judge_documents


def grams(text):
    own = classes(text).tolist()
    return [tuple(own[i : i + ORDER]) for i in range(len(own) - ORDER + 1)]


class Plain:
    """Interpolated modified Kneser-Ney over dictionaries."""

    def __init__(self, texts):
        self.counts = {ORDER: Counter(g for t in texts for g in grams(t))}
        for n in range(ORDER - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.even = 1 / (len(self.counts[1]) + 1)
        self.off = {}
        for n, counts in self.counts.items():
            few = Counter(counts.values())
            a, b, c, d = (max(few[i], 1) for i in (1, 2, 3, 4))
            y = a / (a + 2 * b)
            raw = (1 - 2 * y * b / a, 2 - 3 * y * c / b, 3 - 4 * y * d / c)
            self.off[n] = [min(max(x, 0.1), i) for i, x in enumerate(raw, 1)]
        self.followers = {}
        for counts in self.counts.values():
            for g, c in counts.items():
                self.followers.setdefault((len(g), g[:-1]), []).append(c)

    def chance(self, g):
        if not g:
            return self.even
        n = len(g)
        off = self.off[n]
        after = self.followers.get((n, g[:-1]))
        if after is None:
            return self.chance(g[1:])
        weight = sum(off[min(c, 3) - 1] for c in after) / sum(after)
        c = self.counts[n].get(g, 0)
        own = (c - off[min(c, 3) - 1]) / sum(after) if c else 0.0
        return own + weight * self.chance(g[1:])

    def nats(self, text):
        return sum(-math.log(self.chance(g)) for g in grams(text)), len(grams(text))


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_against_plain_model(spark, make_docs, prose, monkeypatch):
    texts = [prose(1, 30 + n) for n in range(40)] + ["中文 😀 abc", None, " ", prose(1, 31)]
    docs = make_docs(list(enumerate(texts)))
    labels = labelled(spark, [(n, 1, 0) for n in range(30)] + [(30, 1, 1), (31, 0, 0), (5, 1, 0)])
    monkeypatch.setattr(kneser_ney, "PRIOR", 0)
    monkeypatch.setattr(kneser_ney, "CHUNK_BYTES", 900)
    held = {
        r[0] for r in docs.selectExpr("doc_id", "pmod(xxhash64(doc_id), 5) = 0 AS h").collect() if r[1]
    }
    model = Plain([texts[n] for n in range(30) if n not in held])
    rows = judge_documents(docs, labels).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id]
        if text is None or text.isspace():
            assert row.perplexity is None and not row.accepted
            continue
        total, n = model.nats(text)
        assert row.perplexity == pytest.approx(math.exp(total / n), rel=1e-4)
        assert row.accepted == (row.perplexity <= row.threshold)
        assert row.kept == "y" and row.chunk == "x"


def test_chances_sum_to_one(prose):
    model = Plain([prose(1, 200)])
    context = grams(prose(1, 200))[50][:-1]
    letters = [g[0] for g in model.counts[1]]
    # What is left is the share of characters never seen.
    total = sum(model.chance((*context, c)) for c in letters)
    assert 0.9 < total < 1


def test_junk_is_rejected(spark, make_docs, prose):
    good = [prose(1, 80 + n % 60) + "." for n in range(150)]
    junk = [" | ".join(good[0].upper().split()), "%$& " * 60, "#".join(good[1].split())]
    docs = make_docs(list(enumerate(good + junk)))
    labels = labelled(spark, [(n, 1, 0) for n in range(120)])
    rows = judge_documents(docs, labels).orderBy("doc_id").collect()
    assert [r.accepted for r in rows[150:]] == [False] * 3
    assert sum(r.accepted for r in rows[:150]) >= 147


def test_without_labels_or_rows(spark, make_docs, prose):
    none = labelled(spark, [])
    rows = judge_documents(make_docs([(1, prose(1, 30)), (2, None)]), none).orderBy("doc_id").collect()
    assert [r.accepted for r in rows] == [True, False]
    assert judge_documents(make_docs([]), none).collect() == []


def test_grams_fit_a_long():
    assert ORDER * BITS < 64


def test_threshold_is_the_quantile(spark, make_docs, prose):
    docs = make_docs([(n, prose(1, 40 + n % 50)) for n in range(700)])
    rows = judge_documents(docs, labelled(spark, [(n, 1, 0) for n in range(700)]))
    rows = rows.selectExpr("*", "pmod(xxhash64(doc_id), 5) = 0 AS held").collect()
    held = sorted(r.perplexity for r in rows if r.held)
    assert len(held) > 100
    assert rows[0].threshold == pytest.approx(held[math.ceil(0.99 * len(held)) - 1], rel=1e-9)
    assert sum(r.accepted for r in rows) >= 0.96 * len(rows)


def test_foreign_words_are_not_averaged_away(spark, make_docs, prose):
    good = [prose(1, 300) + "."] + [prose(1, 60 + n) + "." for n in range(240)]
    words = good[0].split()
    planted = [" ".join([*words[:n], "qzxwvkjq", *words[n:]]) for n in (3, 150, 290)]
    docs = make_docs(list(enumerate(good + planted)))
    rows = judge_documents(docs, labelled(spark, [(n, 1, 0) for n in range(241)]))
    rows = rows.orderBy("doc_id").collect()
    assert all(r.perplexity <= r.threshold and not r.accepted for r in rows[241:])
    assert sum(r.accepted for r in rows[:241]) >= 235


def test_thresholds_move_smoothly_with_the_number_of_texts():
    """No number of held-out texts at which a rule sets in."""
    every = (1000, 2.0, 3.0, 30.0)
    sizes = [1, 2, 5, 18, 19, 20, 21, 22, 99, 100, 101, 200, 5000]
    wide = {n: widened(n, 2.0, 3.0, 20) for n in sizes}
    assert wide[100] == wide[5000] == 3.0 and list(wide.values()) == sorted(wide.values(), reverse=True)
    drawn = {n: shrunk((n, 1.0, 1.5, 10.0), every) for n in sizes}
    for values in zip(*drawn.values()):
        assert list(values) == sorted(values, reverse=True)
    for a, b in ((19, 20), (20, 21), (99, 100), (100, 101)):
        assert wide[a] - wide[b] < 0.1 and drawn[a][1] - drawn[b][1] < 0.04
    assert shrunk(None, every) == every[1:]
    assert drawn[5000][0] == pytest.approx(1.0, abs=0.01)
