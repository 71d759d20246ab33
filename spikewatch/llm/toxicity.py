"""Toxicity of texts: word vectors made of character n-grams, averaged into a linear softmax.

A word (letters and digits in a row, lower-cased) is set between two marks and stands for
itself and its runs of ``SHORTEST`` to ``LONGEST`` characters, hashed into ``BUCKETS`` places
with a vector of ``WIDTH`` numbers each. A word is the average of its places, a stretch of
``SPAN`` words the average of its words, and two output vectors turn that into a softmax over
the labels 0 and 1. Vectors and outputs are trained together on all stretches, each with the
label of its text. A misspelling never seen still shares most places with the word it stands
for. A text is as toxic as its worst stretch, since a few words among thousands would vanish in
an average over all; the odds of the worst stretch become those of a text by a slope and a
shift, fitted last on whole texts, in which each sampled row stands for as many rows as it was
picked from.

Training takes a bounded sample of the labelled rows: about ``per_label`` rows of each label
and ``most_bytes`` of text in all, picked by hashes. It runs as one group of a Spark job. As
everything before the softmax is linear, what is left is one number per place, a slope and a
shift: that reaches the driver and every task. The labels' picked numbers are broadcast (about
``per_label`` each), so that texts are neither shuffled nor collected. Scoring reads whole
texts and nothing but the text, each row on its own.

A text without a word (null, empty, only white space) scores as if its odds were those of the
training texts' median. If the labelled rows hold no label or only one, every text scores the
share of label 1 among them, 0 if there are none. Repeated rows score the same, and count once
in training. Rows labelled twice count with both labels. Labels other than 0 and 1, null ones
and rows without a number are not learned from. Other columns do not matter, whatever their
names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikewatch.llm.batches import offsets_of, pieces, ragged, text_sizes
from spikewatch.llm.tables import keep

BUCKETS = 1 << 16
WIDTH = 8
SHORTEST, LONGEST = 3, 5
SPAN = 8
EPOCHS = 3
BATCH = 512
RATE = 0.5
WORD = re.compile(r"\w+")
# Words a task remembers the scores of. Beyond it the memory starts afresh.
MOST_WORDS = 300_000
# Odd factors of the rolling hash and of its final mixing.
FACTOR = np.uint32(0x9E3779B1)
MIX = np.uint32(0x85EBCA77)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _placed(hashes: np.ndarray, n: int) -> np.ndarray:
    """Places of hashes of ``n`` characters, zero for whole words."""
    hashes = (hashes ^ (hashes >> np.uint32(16))) * MIX
    hashes = (hashes ^ (hashes >> np.uint32(13)) ^ np.uint32(n)) * FACTOR
    return (hashes >> np.uint32(16)).astype(np.int64) & (BUCKETS - 1)


def places(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The places of all words one after the other, and how many each word has."""
    marked = [f"<{w}>" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(words)), lengths)
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    at = np.arange(len(codes))
    found, owners = [], []
    rolled = np.zeros(len(codes), np.uint32)
    for n in range(1, LONGEST + 1):
        rolled = rolled * FACTOR
        rolled[: max(len(codes) - n + 1, 0)] += codes[n - 1 :]
        if n >= SHORTEST:
            fits = at + n <= ends
            found.append(_placed(rolled[fits], n))
            owners.append(owner[fits])
    # The word itself: the sum over its characters, each mixed with its place in the word.
    mixed = (codes + (at - starts).astype(np.uint32) * MIX) * FACTOR
    whole = np.zeros(len(words), np.uint32)
    np.add.at(whole, owner, mixed ^ (mixed >> np.uint32(15)))
    found.append(_placed(whole, 0))
    owners.append(np.arange(len(words)))
    every, owner = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return every[order], np.bincount(owner, minlength=len(words))


def _sums(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows with the same index."""
    return np.stack([np.bincount(index, column, size) for column in rows.T], axis=1)


def train(words: list[str], numbers: np.ndarray, starts: np.ndarray, labels: np.ndarray):
    """One number per place and a bias: the log odds of label 1 for a stretch are its average.

    ``numbers`` are the words of all texts, ``starts`` where each begins, and the end of the
    last. Steps shrink with the squared gradients met so far. The same rows in the same order
    give the same bits.
    """
    rng = np.random.default_rng(0)
    place, n_places = places(words)
    first = offsets_of(n_places)
    sizes = np.diff(starts)
    n_spans = -(-sizes // SPAN)
    begin = np.repeat(starts[:-1], n_spans) + SPAN * ragged(np.zeros(len(sizes), np.int64), n_spans)
    length = np.minimum(begin + SPAN, np.repeat(starts[1:], n_spans)) - begin
    label = np.repeat(labels, n_spans)
    vectors = (rng.uniform(-0.1, 0.1, (BUCKETS, WIDTH)) / WIDTH).astype(np.float32)
    outputs = (rng.normal(0, 1, (WIDTH, 2)) / np.sqrt(WIDTH)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    squares, out_squares, bias_squares = np.full(BUCKETS, 1e-8, np.float32), 1e-8, 1e-8
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(len(begin)), max(len(begin) // BATCH, 1)):
            count = length[part]
            # Words of the batch, each once, and their places.
            own, word = np.unique(numbers[ragged(begin[part], count)], return_inverse=True)
            spread = n_places[own]
            touched, hit = np.unique(place[ragged(first[own], spread)], return_inverse=True)
            met = vectors[touched][hit]
            word_vectors = np.add.reduceat(met, offsets_of(spread)[:-1], axis=0) / spread[:, None]
            hidden = np.add.reduceat(word_vectors[word], offsets_of(count)[:-1], axis=0)
            hidden /= count[:, None]
            logits = hidden @ outputs + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            slope = odds / odds.sum(axis=1, keepdims=True)
            slope[np.arange(len(part)), label[part]] -= 1
            down = np.repeat((slope @ outputs.T) / count[:, None], count, axis=0)
            down = _sums(word, down, len(own)) / spread[:, None]
            step = _sums(hit, np.repeat(down, spread, axis=0), len(touched)).astype(np.float32)
            squares[touched] += (step**2).mean(axis=1)
            vectors[touched] -= RATE * step / np.sqrt(squares[touched])[:, None]
            step = hidden.T @ slope
            out_squares += float((step**2).mean())
            outputs -= (0.1 * RATE / np.sqrt(out_squares) * step).astype(np.float32)
            step = slope.sum(axis=0)
            bias_squares += float((step**2).mean())
            bias -= (RATE / np.sqrt(bias_squares) * step).astype(np.float32)
    apart = (outputs[:, 1] - outputs[:, 0]).astype(np.float64)
    return vectors.astype(np.float64) @ apart, float(bias[1] - bias[0])


def word_scores(words: list[str], values: np.ndarray) -> np.ndarray:
    """The average of each word's places."""
    if not words:
        return np.zeros(0)
    place, lengths = places(words)
    return np.add.reduceat(values[place], offsets_of(lengths)[:-1]) / lengths


def worst_stretch(scores: np.ndarray) -> float | None:
    """The highest average of ``SPAN`` words in a row, of all words if they are fewer."""
    if not len(scores):
        return None
    span = min(SPAN, len(scores))
    sums = np.concatenate([np.zeros(1), np.cumsum(scores)])
    return float((sums[span:] - sums[:-span]).max() / span)


def calibrate(odds: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the weighted logistic regression of labels on odds, by Newton steps.

    A little weight towards a slope of zero keeps it finite when the labels fall apart.
    """
    rows = np.stack([odds, np.ones(len(odds))], axis=1)
    share, weights = np.zeros(2), weights / weights.sum()
    ridge = np.diag([1e-4, 1e-6])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(rows @ share, -50, 50)))
        slope = rows.T @ (weights * (chance - labels)) + ridge @ share
        curve = (rows * (weights * np.maximum(chance * (1 - chance), 1e-9))[:, None]).T @ rows + ridge
        step = np.linalg.solve(curve, slope)
        # Far from the optimum whole steps may overshoot.
        share -= step * min(1.0, 4 / max(float(np.abs(step).max()), 1e-12))
    return float(share[0]), float(share[1])


@dataclass
class Model:
    """``values`` per place; the log odds of a text are ``slope`` times its worst stretch plus
    ``shift``, with ``usual`` for texts without a word."""

    values: np.ndarray
    slope: float
    shift: float
    usual: float

    def score(self, worst: float | None) -> float:
        odds = self.slope * (self.usual if worst is None else worst) + self.shift
        # Beyond this the odds are all or nothing in double precision.
        return float(odds > 0) if abs(odds) > 700 else float(1 / (1 + np.exp(-odds)))


class _Scores(dict):
    """Scores of words, remembering those met before; new ones are numbered and scored later."""

    def __init__(self, values: np.ndarray):
        super().__init__()
        self.values, self.table, self.new = values, np.zeros(0), []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number

    def of(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self) > MOST_WORDS:
            self.clear()
            self.table = np.zeros(0)
        found = [np.fromiter(map(self.__getitem__, words), np.int64, len(words)) for words in texts]
        new, self.new = self.new, []
        self.table = np.concatenate([self.table, word_scores(new, self.values)])
        return [self.table[numbers] for numbers in found]


def fit_rows(texts: list[str], labels: np.ndarray, weights: np.ndarray) -> Model:
    """The model of these texts, both labels being among them."""
    numbers: dict[str, int] = {}
    own = [
        np.array([numbers.setdefault(w, len(numbers)) for w in words_of(t)], np.int64) for t in texts
    ]
    words, starts = list(numbers), offsets_of(np.array([len(n) for n in own], np.int64))
    if not words:
        return constant(float(np.average(labels, weights=weights)))
    values, bias = train(words, np.concatenate(own), starts, labels)
    scores = word_scores(words, values)
    worst = [worst_stretch(scores[n]) for n in own]
    given = np.array([n for n, w in enumerate(worst) if w is not None])
    odds = np.array([worst[n] for n in given]) + bias
    slope, shift = calibrate(odds, labels[given], weights[given])
    return Model(values, slope, slope * bias + shift, float(np.median(odds)) - bias)


def constant(share: float) -> Model:
    """Every text scores ``share``."""
    shift = float(np.log(share / (1 - share))) if 0 < share < 1 else (1e9 if share else -1e9)
    return Model(np.zeros(BUCKETS), 0.0, shift, 0.0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_label: int = 4000,
    most_bytes: int = 24 << 20,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model:
    """Fit on a sample of ``docs`` that ``labels`` knows, about ``per_label`` rows each.

    A sampled text longer than its label's part of ``most_bytes`` may come in whole.
    """
    marks = labels.select(F.col(doc_id).alias("number"), F.col(label).cast("int").alias("label"))
    marks = marks.filter("number IS NOT NULL AND label IN (0, 1)").distinct()
    pick = F.pmod(F.xxhash64("number"), F.lit(1 << 30))
    totals = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0).cast("long")
    for name, total in totals.items():
        part = min(1.0, per_label / total)
        share = F.when(F.col("label") == name, F.lit(int(part * (1 << 30)))).otherwise(share)
    # About ``per_label`` numbers of each label.
    picked = F.broadcast(marks.filter(pick < share))
    given = docs.select(F.col(doc_id).alias("number"), F.col(text).alias("text"))
    sample = given.filter("text IS NOT NULL").join(picked, "number").distinct()
    sample = keep(sample, "toxic-sample")
    sizes = sample.groupBy("label").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")
    )
    sizes = {r["label"]: r for r in sizes.collect()}
    if set(sizes) != {0, 1}:
        return constant(float(1 in sizes))
    # Many rows may bear one number, and a few rows may be very long.
    part = {
        name: min(1.0, per_label / row["n"], most_bytes / 2 / max(row["size"], 1))
        for name, row in sizes.items()
    }
    again = F.pmod(F.xxhash64("text", "number"), F.lit(1 << 30))
    below = F.when(F.col("label") == 0, int(part[0] * (1 << 30))).otherwise(int(part[1] * (1 << 30)))
    chosen = sample.filter(again < below).withColumn("all", F.lit(0))
    stands_for = {name: totals[name] / max(sizes[name]["n"] * part[name], 1) for name in part}

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["number", "label", "text"])
        own = group["label"].to_numpy()
        if len(set(own.tolist())) < 2:
            model = constant(float(own[0]))
        else:
            weights = np.array([stands_for[n] for n in own.tolist()])
            model = fit_rows(group["text"].tolist(), own, weights)
        return pd.DataFrame(
            {
                "numbers": [model.values.tobytes()],
                "slope": [model.slope],
                "shift": [model.shift],
                "usual": [model.usual],
            }
        )

    fitted = chosen.groupBy("all").applyInPandas(
        run, "numbers binary, slope double, shift double, usual double"
    )
    row = fitted.first()
    if row is None:
        return constant(0.0)
    return Model(np.frombuffer(row["numbers"]), row["slope"], row["shift"], row["usual"])


def toxicity(text: Column, model: Model) -> Column:
    """``score`` and ``predicted`` of a text column as a struct."""

    @F.arrow_udf("score double, predicted int")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _Scores(model.values)
        for texts in batches:
            found = []
            for a, b in pieces(text_sizes(texts)):
                words = [words_of(t) for t in texts[a:b].to_pylist()]
                found += [model.score(worst_stretch(s)) for s in known.of(words)]
            scores = pa.array(found, pa.float64())
            predicted = pa.array([int(s >= 0.5) for s in found], pa.int32())
            yield pa.StructArray.from_arrays([scores, predicted], names=["score", "predicted"])

    return run(text)
