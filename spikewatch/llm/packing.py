"""Packing documents into training sequences of bounded length, in order.

Each task packs the documents of its partition one after the other. A sequence is a window
of the running token stream; its cuts lie at ends of documents or sentences, or, inside
longer sentences, every full sequence length. Dynamic programming picks the cuts with the
least padding plus penalties for documents cut in two. Since padding is a difference of
positions, the best predecessor of a cut is a sliding-window minimum, which a monotone queue
gives in constant time; windows whose length is a power of two need no padding and are
transitions of their own. A sequence still left with more padding than cuts would cost
(the last of a partition) is divided at powers of two.

Documents are packed in the order of the given rows; nothing is shuffled. Decisions are made
over ``HORIZON`` tokens at a time and all but their last windows are settled, which bounds
memory. Null text counts as empty: such a document is its closing token alone. Repeated rows
are packed each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spikewatch.llm.batches import binaries, pieces, text_sizes
from spikewatch.llm.bpe import encoder

# Cost of a cut inside a document, in tokens of padding.
AT_SENTENCE = 8
ANYWHERE = 48
# Tokens decided on at once, and the sequences at their end that are decided on again.
HORIZON = 96
REDONE = 6
# Sequences a task can number.
NUMBERS = 1 << 33

PIECES = (
    "doc_id long, start long, length long, token_ids binary, doc_tokens long, "
    "sequence_id long, offset long"
)


def is_power(n: np.ndarray | int) -> np.ndarray | bool:
    return (n & (n - 1)) == 0


def best_cuts(at: np.ndarray, penalty: np.ndarray, size: int) -> list[int]:
    """Positions where sequences end, from the cuts allowed.

    ``at`` is rising, starts with the stream's beginning, ends with its end, and has no gap
    above ``size``.
    """
    places, costs = at.tolist(), penalty.tolist()
    equal: dict[int, list[int]] = {}
    power = 1
    while power < size:
        before = np.searchsorted(at, at - power)
        for end in np.flatnonzero((at[before] == at - power) & (at >= at[0] + power)).tolist():
            equal.setdefault(end, []).append(int(before[end]))
        power *= 2
    best, came = [0] * len(places), [0] * len(places)
    queue: deque[tuple[int, int]] = deque([(places[0], 0)])
    for end in range(1, len(places)):
        place = places[end]
        while places[queue[0][1]] < place - size:
            queue.popleft()
        least, source = queue[0]
        least += size - place
        for begin in equal.get(end, ()):
            if best[begin] < least:
                least, source = best[begin], begin
        best[end], came[end] = least + costs[end], source
        value = best[end] + place
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, end))
    out, end = [], len(places) - 1
    while end:
        out.append(places[end])
        end = came[end]
    return out[::-1]


def allowed_cuts(
    ends: np.ndarray, sentences: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """All positions to cut at with their penalties, from ends of documents and sentences."""
    at = np.unique(np.concatenate([[0], sentences, ends]))
    penalty = np.where(np.isin(at, ends), 0, AT_SENTENCE)
    gaps = np.diff(at)
    wide = np.flatnonzero(gaps > size)
    extra = [np.arange(at[n] + size, at[n + 1], size) for n in wide]
    if extra:
        more = np.concatenate(extra)
        at, penalty = np.r_[at, more], np.r_[penalty, np.full(len(more), ANYWHERE)]
        order = np.argsort(at, kind="stable")
        at, penalty = at[order], penalty[order]
    return at, penalty


def divide(cuts: list[int], size: int) -> list[int]:
    """Cut sequences at powers of two where that costs less than their padding."""
    out, begin = [], 0
    for end in cuts:
        length = end - begin
        if not is_power(length) and (bin(length).count("1") - 1) * ANYWHERE < size - length:
            for bit in range(length.bit_length() - 1, -1, -1):
                if length >> bit & 1:
                    begin += 1 << bit
                    out.append(begin)
        else:
            out.append(end)
        begin = end
    return out


class Packer:
    """Documents waiting to be packed, and the sequences made of them."""

    def __init__(self, size: int, first_number: int):
        self.size, self.number = size, first_number
        self.ids = np.zeros(0, np.uint32)
        self.sentences = np.zeros(0, np.int64)
        # Of each waiting document: id, number of tokens in all, and of those packed before.
        self.docs: list[object] = []
        self.totals = np.zeros(0, np.int64)
        self.packed = np.zeros(0, np.int64)

    def add(
        self, docs: list[object], ids: np.ndarray, totals: np.ndarray, sentences: np.ndarray
    ) -> None:
        self.sentences = np.r_[self.sentences, sentences + len(self.ids)]
        self.ids = np.r_[self.ids, ids]
        self.docs += docs
        self.totals = np.r_[self.totals, totals]
        self.packed = np.r_[self.packed, np.zeros(len(docs), np.int64)]

    def take(self, last: bool) -> pa.RecordBatch | None:
        """Pieces of the sequences that are settled; of all at the end."""
        if not len(self.ids) or not last and len(self.ids) < HORIZON * self.size:
            return None
        ends = np.cumsum(self.totals - self.packed)
        cuts = best_cuts(*allowed_cuts(ends, self.sentences, self.size), self.size)
        if not last:
            # The end so far is no end of the stream: windows before it may still move.
            cuts = cuts[:-REDONE]
        cuts = divide(cuts, self.size)
        if not cuts:
            return None
        out = self._pieces(np.array(cuts), ends)
        self._drop(cuts[-1], ends)
        self.number += len(cuts)
        return out

    def _pieces(self, cuts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        begins = np.r_[0, ends[:-1]]
        starts = np.union1d(begins[begins < cuts[-1]], np.r_[0, cuts[:-1]])
        lengths = np.diff(np.r_[starts, cuts[-1]])
        doc = np.searchsorted(begins, starts, "right") - 1
        sequence = np.searchsorted(cuts, starts, "right")
        opening = np.r_[0, cuts[:-1]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.docs[n] for n in doc.tolist()], pa.int64()),
                pa.array(starts - begins[doc] + self.packed[doc]),
                pa.array(lengths),
                binaries(self.ids[: cuts[-1]].astype("<u4"), lengths),
                pa.array(self.totals[doc]),
                pa.array(self.number + sequence),
                pa.array(starts - opening[sequence]),
            ],
            names=[field.split(" ")[0] for field in PIECES.split(", ")],
        )

    def _drop(self, end: int, ends: np.ndarray) -> None:
        first = int(np.searchsorted(ends, end, "right"))
        if first < len(ends):
            inside = end - (int(ends[first - 1]) if first else 0)
            self.packed[first] += inside
        self.docs = self.docs[first:]
        self.totals, self.packed = self.totals[first:], self.packed[first:]
        self.ids = self.ids[end:].copy()
        self.sentences = self.sentences[self.sentences > end] - end


def with_closing(
    ids: np.ndarray, lengths: np.ndarray, sentences: np.ndarray, closing: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same tokens with a closing one after each document."""
    ends = np.cumsum(lengths)
    moved = sentences + np.searchsorted(ends, sentences, "left")
    return np.insert(ids, ends, closing), lengths + 1, moved


def pack(
    docs: DataFrame,
    path: str,
    size: int = 4096,
    closing: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of documents and where they lie in the sequences; ``token_ids`` is packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        packer = Packer(size, TaskContext.get().partitionId() * NUMBERS)
        for batch in batches:
            ids, texts = batch.columns
            for a, b in pieces(text_sizes(texts)):
                part = [t or "" for t in texts[a:b].to_pylist()]
                packer.add(ids[a:b].to_pylist(), *with_closing(*own.encode(part), closing))
                if (out := packer.take(last=False)) is not None:
                    yield out
        if (out := packer.take(last=True)) is not None:
            yield out

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(run, PIECES)
