"""Runs: stretches of words that repeat themselves several times over.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are
equal), of at least ``TIMES`` periods and ``LEAST`` words, that no neighbouring word extends.

Runs are found as maximal pairs. Two places ``i < j`` of a text form one if the words that
follow them agree for ``l`` words and no further, and the words to their left differ. Then
``[i, j + l)`` has period ``j - i`` and no neighbour extends it: if ``l`` is at least
``TIMES - 1`` distances, and the whole at least ``LEAST`` words, it is a run, and nothing is
extended afterwards. Every run comes up this way; where several distances give the same
stretch, the smallest is its period.

The pairs are enumerated bottom-up in the tree of LCP intervals of the text's suffixes. An
interval holds the places whose suffixes share ``l`` words, as a list in order of place; the
word to the left of a place is its class. When the lists of two children are merged, the
smaller into the larger, each place of one is set against its nearest places in the other and
counts with those of another class that are close enough. That is enough: a place of the
interval between the two of a pair would lie less than ``l / 3`` from both, and so give a
period that divides theirs, with the same stretch. Each place is merged at most log(n) times,
so the pairs looked at are n log n, however often a text repeats itself.

Only suffixes that share ``SHARED`` words with another of the same text get into the tree, as
many as the places of the shortest run's pair share. Suffixes are ranked by doubling for many texts at once in numpy,
the ranks of each round being kept for the common prefixes; texts of which no rank is shared
any more leave early, which most prose does after a few words.

Each row is judged on its own and nothing is shuffled. A null or empty text has no words and
no runs, and its collapsed text is empty. Words are runs of anything but ASCII white space and
equal if their bytes are. Repeated rows give the same result; other columns do not matter.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from spikewatch.llm.batches import offsets_of, pieces, ragged, text_sizes

LEAST = 6
TIMES = 4
# Words that the places of a pair share at least: a run of period 1 has LEAST words, of period
# 2 it has 8 and so on.
SHARED = min(max(LEAST - q, (TIMES - 1) * q) for q in range(1, LEAST + 1))

FOUND = (
    "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
    "collapsed string"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _ranked(major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs of ranks."""
    _, ranks = np.unique(major.astype(np.int64) << 32 | minor, return_inverse=True)
    return ranks.astype(np.int32)


def suffix_order(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their texts and suffixes, and the words each shares with the next.

    ``ids`` are the words of all texts, ``starts`` where each text begins, and the end of the
    last. Only places that share ``SHARED`` words with another of their text are given; the
    last of a text shares none with the next.
    """
    n = len(ids)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    # Zero stands beyond the end of a text; a rank tells texts apart, so that none are shared.
    levels = [_ranked(owner, ids) + np.int32(1)]
    place, end = np.arange(n), np.repeat(starts[1:], np.diff(starts))
    width = 1
    while n:
        last = levels[-1]
        beyond = np.zeros(n, np.int32)
        inside = place + width < end
        beyond[inside] = last[place[inside] + width]
        shared = np.bincount(last)[last] > 1
        # Where a prefix occurs once its rank is final; ranks below and above stay in order.
        if not shared.any():
            break
        levels.append(_ranked(last, np.where(shared, beyond, 0)) + np.int32(1))
        width *= 2
        if width > n:
            break
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(levels[-1], kind="stable")
    left, right = order[:-1], order[1:]
    common = np.zeros(len(left), np.int64)
    # From the widest ranks down: equal ranks are equal words, unless a text ends within.
    for n_words, ranks in reversed([(1 << k, ranks) for k, ranks in enumerate(levels)]):
        a, b = left + common, right + common
        ok = (a + n_words <= end[left]) & (b + n_words <= end[right])
        a, b = np.minimum(a, n - 1), np.minimum(b, n - 1)
        common += n_words * (ok & (ranks[a] == ranks[b]))
    with_next = np.append(common, 0)
    with_next[with_next < SHARED] = 0
    shown = (with_next > 0) | np.append(False, with_next[:-1] > 0)
    return order[shown], with_next[shown]


def _merged(
    one: list[int], two: list[int], shared: int, left: list[int], found: dict[tuple[int, int], int]
) -> list[int]:
    """The places of two children of an interval, with the runs that pairs of them are."""
    large, small = (one, two) if len(one) >= len(two) else (two, one)
    reach = shared // (TIMES - 1)
    for place in small:
        at = bisect_left(large, place)
        for other in large[max(at - 1, 0) : at + 1]:
            period = abs(other - place)
            if period > reach or period + shared < LEAST or left[place] == left[other]:
                continue
            start = min(place, other)
            stretch = (start, start + period + shared)
            if period < found.get(stretch, period + 1):
                found[stretch] = period
    if 8 * len(small) < len(large):
        for place in small:
            insort(large, place)
    else:
        large += small
        large.sort()
    return large


def maximal_pairs(order: list[int], shared: list[int], left: list[int]) -> dict[tuple[int, int], int]:
    """Runs as ``(start, end)`` with their period, from suffixes in order.

    ``shared`` are the words each suffix shares with the next, ``left`` the class of every
    place: the word to its left.
    """
    found: dict[tuple[int, int], int] = {}
    # Open intervals from the widest to the narrowest: shared words and places so far.
    path: list[tuple[int, list[int]]] = []
    for place, common in zip(order, shared, strict=True):
        child = [place]
        while path and path[-1][0] > common:
            words, places = path.pop()
            child = _merged(places, child, words, left, found)
        if path and path[-1][0] == common:
            path[-1] = (common, _merged(path[-1][1], child, common, left, found))
        elif common:
            path.append((common, child))
    return found


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs ``(start, length, period)`` of each list of words, in order."""
    numbers = _Numbers()
    flat = [w for words in texts for w in words]
    ids = np.fromiter(map(numbers.__getitem__, flat), np.int64, len(flat))
    del flat
    starts = offsets_of(np.fromiter(map(len, texts), np.int64, len(texts)))
    own = _repetitive(ids, starts)
    starts_of = offsets_of(np.diff(starts)[own])
    ids = ids[ragged(starts[:-1][own], np.diff(starts)[own])]
    order, shared = suffix_order(ids, starts_of)
    # No word is to the left of a text's first.
    left = np.append(np.int64(-1), ids[:-1])
    if len(ids):
        left[starts_of[:-1][np.diff(starts_of) > 0]] = -1
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = maximal_pairs(order.tolist(), shared.tolist(), left.tolist())
    text_of = np.searchsorted(starts_of, [start for start, _ in found], side="right") - 1
    for ((start, end), period), n in zip(found.items(), text_of.tolist(), strict=True):
        out[own[n]].append((start - int(starts_of[n]), end - start, period))
    return [sorted(runs, key=lambda run: (run[0], run[2])) for runs in out]


def _repetitive(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Numbers of the texts in which ``SHARED`` words in a row occur again, by doubling ranks."""
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    end = np.repeat(starts[1:], np.diff(starts))
    place = np.arange(len(ids))
    rank, width = _ranked(owner, ids), 1
    while len(place):
        # Windows that occur once can be part of no longer window that occurs twice.
        again = (np.bincount(rank)[rank] > 1) & (place + width <= end[place])
        rank, place = rank[again], place[again]
        if width == SHARED or not len(place):
            break
        step = min(width, SHARED - width)
        known = np.full(len(ids) + 1, -1, np.int64)
        known[place] = rank
        beyond = known[np.minimum(place + step, len(ids))]
        keep = (beyond >= 0) & (owner[np.minimum(place + step, len(ids) - 1)] == owner[place])
        place, rank = place[keep], _ranked(rank[keep], beyond[keep])
        width += step
    return np.unique(owner[place])


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run has after its first period."""
    if not runs:
        return words
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    inside = np.cumsum(steps[:-1]) > 0
    return [word for word, gone in zip(words, inside.tolist(), strict=True) if not gone]


def find_runs(text: Column) -> Column:
    """``n_words``, ``runs`` by start and period, and the ``collapsed`` text of a text column."""

    @F.arrow_udf(FOUND)
    def run(texts: pa.Array) -> pa.Array:
        data, parts = texts.cast(pa.binary()), []
        for a, b in pieces(text_sizes(texts)):
            words = [(t or b"").split() for t in data[a:b].to_pylist()]
            runs = runs_of(words)
            # Not one element per run, but columns: most texts have none.
            flat = [r for rs in runs for r in rs]
            columns = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
            offsets = pa.array(offsets_of(np.array([len(r) for r in runs], np.int64)), pa.int32())
            values = pa.StructArray.from_arrays(columns, fields=list(_RUN))
            short = [b" ".join(collapsed(w, r)) for w, r in zip(words, runs, strict=True)]
            parts.append(
                pa.StructArray.from_arrays(
                    [
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.ListArray.from_arrays(offsets, values),
                        pa.array(short, pa.binary()).cast(pa.string()),
                    ],
                    names=["n_words", "runs", "collapsed"],
                )
            )
        kind = pa.struct(
            [("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())]
        )
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return run(text)


def repeating_tail(words: list[bytes], number: str | None) -> list[bytes]:
    """Some texts, told by the checksum of their number, with a tail that repeats itself."""
    code = zlib.crc32((number or "").encode())
    group, n = code // 10, len(words)
    if number is None or code % 10 or not n:
        return words
    start = group % n
    period = 1 + (n - start) // (3 + group % 8)
    return [*words[:start], *(words[start + k % period] for k in range(n - start))]


def with_repeating_tails(text: Column, number: Column) -> Column:
    """The text, with a repeating tail where the row's number says so (a null number never
    does). For tests and queries: real texts seldom hold long periods."""

    @F.arrow_udf("string")
    def run(texts: pa.Array, numbers: pa.Array) -> pa.Array:
        out = []
        data = texts.cast(pa.binary())
        for a, b in pieces(text_sizes(texts)):
            for t, number in zip(data[a:b].to_pylist(), numbers[a:b].to_pylist(), strict=True):
                words = (t or b"").split()
                new = repeating_tail(words, number)
                out.append(t if new is words else b" ".join(new))
        return pa.array(out, pa.binary()).cast(pa.string())

    return run(text, number.cast("string"))
