"""Language identification in two steps: the family first, then the language within it.

Texts become letter n-gram counts (one to three letters, words bounded by blanks), hashed
into ``DIMENSIONS`` places, as square roots scaled to length one. Linear support vector
machines with squared hinge loss separate each family from the others, and within a family
each pair of languages. A text's family is the one with the largest margin; its language
wins most of the family's pairs, ties broken by the summed margins and then by name.

The models are fitted on a sample of the given labelled rows, about ``per_language`` for
each language whatever the input's size; all machines are fitted as groups of one Spark job,
each on the sample rows it needs. What reaches the driver is one weight vector per machine.
Prediction reads whole texts and nothing else.

Null texts and texts without a letter are ``und`` with score 0, and so is everything when
there is nothing to learn from. Rows are independent: repeated rows get the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikewatch.llm.batches import pieces, text_sizes

DIMENSIONS = 4096
UNDETERMINED = "und"
# Language codes by family. Other codes are families of their own.
FAMILIES = {
    "germanic": "da de en is nl no sv",
    "romance": "ca es fr gl it pt ro",
    "slavic": "bg cs hr pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk tr uz",
}
FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
# Multipliers that spread one, two and three letters over the places.
SPREAD = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
STEPS = 300
PENALTY = 1e-4
# Margin at which a machine is about 95 % sure.
SHARPNESS = 3.0


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang, f"only {lang}")


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a blank."""
    table = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def features(text: str) -> np.ndarray | None:
    """The text's vector, nothing if it has no letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    letters = _letters()[codes]
    letters = np.r_[np.uint32(32), letters, np.uint32(32)]
    blank = letters == 32
    letters = letters[~(blank & np.r_[False, blank[:-1]])]
    if len(letters) < 2:
        return None
    one = letters * SPREAD[0]
    two = one[:-1] ^ (letters[1:] * SPREAD[1])
    three = two[:-1] ^ (letters[2:] * SPREAD[2])
    shift = np.uint32(32 - (DIMENSIONS - 1).bit_length())
    counts = sum(
        np.bincount((part * SPREAD[0]) >> shift, minlength=DIMENSIONS) for part in (one, two, three)
    )
    vector = np.sqrt(counts).astype(np.float32)
    return vector / np.float32(np.linalg.norm(vector))


def fit_machine(vectors: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Weights, with the bias last, of least squared hinge loss; both signs weigh the same.

    Accelerated gradient descent from zero, with fixed step and count: the same rows in the
    same order give the same bits.
    """
    rows = np.concatenate([vectors, np.ones((len(vectors), 1), np.float32)], axis=1)
    share = np.where(signs > 0, 0.5 / max((signs > 0).sum(), 1), 0.5 / max((signs < 0).sum(), 1))
    # Rows have squared length 2, so the gradient changes by no more than this per step.
    rate = 1 / (2 * 2 + PENALTY)
    weights = ahead = np.zeros(rows.shape[1])
    for step in range(STEPS):
        slack = np.maximum(1 - signs * (rows @ ahead), 0)
        gradient = PENALTY * ahead - 2 * ((share * signs * slack) @ rows)
        new = ahead - rate * gradient
        ahead = new + step / (step + 3) * (new - weights)
        weights = new
    return weights


@dataclass
class Model:
    """Machines by name: ``(family,)`` against the rest, ``(a, b)`` within a family."""

    languages: list[str]
    families: dict[tuple[str], np.ndarray] = field(default_factory=dict)
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, text: str | None) -> tuple[str, float]:
        vector = features(text) if text and self.languages else None
        if vector is None:
            return UNDETERMINED, 0.0
        names = sorted({family_of(lang) for lang in self.languages})
        margins = np.array([self._margin(self.families.get((n,)), vector) for n in names])
        odds = np.exp(SHARPNESS * (margins - margins.max()))
        at = int(margins.argmax())
        lang, sure = self._within(names[at], vector)
        return lang, float(min(max(odds[at] / odds.sum() * sure, 0.0), 1.0))

    @staticmethod
    def _margin(weights: np.ndarray | None, vector: np.ndarray) -> float:
        return 0.0 if weights is None else float(weights[:-1] @ vector + weights[-1])

    def _within(self, family: str, vector: np.ndarray) -> tuple[str, float]:
        members = [lang for lang in self.languages if family_of(lang) == family]
        wins, sums = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
        sure = dict.fromkeys(members, 1.0)
        for a, b in combinations(members, 2):
            margin = self._margin(self.pairs[a, b], vector)
            wins[a if margin >= 0 else b] += 1
            sums[a] += margin
            sums[b] -= margin
            chance = 1 / (1 + np.exp(-SHARPNESS * np.clip(margin, -50, 50)))
            sure[a] *= chance
            sure[b] *= 1 - chance
        best = min(members, key=lambda lang: (-wins[lang], -sums[lang], lang))
        return best, float(sure[best])


def _vectors(text: Column) -> Column:
    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = [features(t) if t else None for t in texts.to_pylist()]
            yield pa.array([None if r is None else r.tobytes() for r in rows], pa.binary())

    return run(text)


def sample_rows(
    rows: DataFrame, per_language: int, doc_id: str, text: str, lang: str
) -> DataFrame:
    """About ``per_language`` rows of each language, picked by a hash of their number."""
    given = rows.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in given.groupBy(lang).count().collect()}
    pick = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(1 << 30))
    below = F.lit(None).cast("long")
    for name in sorted(counts):
        share = min(1.0, per_language / counts[name])
        below = F.when(F.col(lang) == name, F.lit(int(share * (1 << 30)))).otherwise(below)
    return given.filter(pick < below).select(
        F.col(lang).alias("lang"), F.col(doc_id).alias("number"), _vectors(F.col(text)).alias("v")
    )


def fit(
    rows: DataFrame,
    per_language: int = 600,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> Model:
    """Fit on a sample of labelled rows, about ``per_language`` for each language.

    The languages are taken to be few, at most some hundreds: one machine per family and
    per pair within a family.
    """
    sample = sample_rows(rows, per_language, doc_id, text, lang).filter("v IS NOT NULL")
    languages = sorted(r[0] for r in sample.select("lang").distinct().collect())
    model = Model(languages)
    names = sorted({family_of(name) for name in languages})
    machines = [(name, "") for name in names if len(names) > 1]
    machines += [p for p in combinations(languages, 2) if family_of(p[0]) == family_of(p[1])]
    if not machines:
        return model
    # A row takes part in all families' machines and in the pairs of its language.
    part_of = F.create_map(
        *(
            x
            for name in languages
            for x in (
                F.lit(name),
                F.array(*(F.lit(n) for n, m in enumerate(machines) if not m[1] or name in m)),
            )
        )
    )
    rows_of = sample.select(F.explode(part_of[F.col("lang")]).alias("machine"), "*")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["lang", "number", "v"])
        number = int(group["machine"].iloc[0])
        a, b = machines[number]
        vectors = np.frombuffer(b"".join(group["v"]), np.float32).reshape(len(group), -1)
        first = group["lang"] == a if b else group["lang"].map(family_of) == a
        weights = fit_machine(vectors, np.where(first, 1.0, -1.0))
        return pd.DataFrame({"machine": [number], "weights": [weights.tobytes()]})

    fitted = rows_of.groupBy("machine").applyInPandas(run, "machine int, weights binary")
    for number, weights in fitted.collect():
        a, b = machines[number]
        target = model.pairs if b else model.families
        target[(a, b) if b else (a,)] = np.frombuffer(weights)
    return model


def predict(text: Column, model: Model) -> Column:
    """``lang_pred`` and ``score`` of a text column as a struct."""

    @F.arrow_udf("lang_pred string, score double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = []
            for a, b in pieces(text_sizes(texts)):
                found += [model.predict(t) for t in texts[a:b].to_pylist()]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                names=["lang_pred", "score"],
            )

    return run(text)
