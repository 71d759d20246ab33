"""Window counts and baseline in one ordered pass over a key's panes.

The result is that of ``window_counts`` followed by ``ema_baseline``. The average has to
be folded in Python in any case; forming the windows on the way means that only pane
rows are sorted and sent there, not the several times as many window rows, and that no
second aggregation is needed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spikewatch.config import SurgeConfig
from spikewatch.operators.baseline import (
    classified,
    evaluation_schema,
    fold_counts,
    in_batches,
    run_starts,
)

# Rows sent back from Python at a time.
OUTPUT_ROWS = 65536


class PaneWindows:
    """Windows of one key, fed its panes in ascending pieces.

    Between pieces only the panes of the last window are kept.
    """

    def __init__(self, cfg: SurgeConfig, first_pane: int) -> None:
        self.cfg = cfg
        self.panes = np.empty(0, np.int64)
        self.counts = np.empty(0, np.int64)
        self.inside = np.empty(0, bool)
        self.average: float | None = None
        # The same limit whichever instant of its pane the first event has.
        self.warm_until = first_pane + cfg.window_ms
        # Windows ending here or earlier are done.
        self.done = first_pane

    def feed(
        self, panes: np.ndarray, counts: np.ndarray, inside: np.ndarray, last: bool
    ) -> tuple[np.ndarray, np.ndarray, list[float], int]:
        """Ends, counts and baselines of the windows that later panes cannot change, and how
        many of them are warming up. ``last`` closes all that are left."""
        cfg, window, slide = self.cfg, self.cfg.window_ms, self.cfg.slide_ms
        panes = np.concatenate([self.panes, panes])
        counts = np.concatenate([self.counts, counts])
        inside = np.concatenate([self.inside, inside])
        settled = int(panes[-1]) + cfg.pane_ms

        # Each window is listed once, by the latest pane in it.
        first = panes - panes % slide + slide
        final = panes + window - (panes + window) % slide
        final[:-1] = np.minimum(final[:-1], first[1:] - slide)
        if not last:
            final[-1] = min(final[-1], settled)
        begin = np.maximum(first, self.done - self.done % slide + slide)
        listed = np.maximum((final - begin) // slide + 1, 0)
        latest = np.repeat(np.arange(len(panes)), listed)
        place = np.arange(len(latest)) - np.repeat(np.cumsum(listed) - listed, listed)
        ends = begin[latest] + place * slide

        earliest = np.searchsorted(panes, ends - window)
        below = np.concatenate([[0], np.cumsum(counts)])
        sums = below[latest + 1] - below[earliest]
        if not cfg.is_tumbling:
            # A window with nothing past its start does not exist.
            exists = (latest > earliest) | (panes[earliest] > ends - window) | inside[earliest]
            ends, sums = ends[exists], sums[exists]

        warm = int(np.searchsorted(ends, self.warm_until, side="right"))
        shown, self.average = fold_counts(sums.tolist(), warm, self.average, cfg.alpha)
        self.done = settled
        kept = np.searchsorted(panes, settled - window)
        self.panes, self.counts, self.inside = panes[kept:], counts[kept:], inside[kept:]
        return ends, sums, shown, warm


def _fold_panes(cfg: SurgeConfig) -> Callable:
    def emit(
        zone: pa.Scalar, ends: np.ndarray, sums: np.ndarray, shown: list[float], warm: int
    ) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.repeat(zone, len(ends)),
                pa.array(ends),
                pa.array(sums),
                pa.array(np.arange(len(ends)) < warm),
                pa.array(shown, pa.float64()),
            ],
            names=["zone", "window_end_ms", "request_count", "warming", "ema_baseline"],
        )

    # A pane leads to at most window / slide windows; this bounds what is held at once.
    longest = max(1, OUTPUT_ROWS * cfg.slide_ms // cfg.window_ms)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            zones = batch.column("zone")
            firsts = batch.column("first_pane")
            columns = [
                batch.column("pane").to_numpy(),
                batch.column("n").to_numpy(),
                batch.column("inside").to_numpy(zero_copy_only=False),
            ]
            starts = run_starts(zones)
            for begin, end in zip(starts, [*starts[1:], batch.num_rows]):
                for lo in range(begin, end, longest):
                    hi = min(lo + longest, end)
                    yield zones[lo], firsts[lo].as_py(), [c[lo:hi] for c in columns]

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zone, windows, held = None, None, None
        for next_zone, first_pane, columns in pieces(batches):
            if held is not None:
                yield emit(zone, *windows.feed(*held, last=next_zone != zone))
            if held is None or next_zone != zone:
                zone, windows = next_zone, PaneWindows(cfg, first_pane)
            held = columns
        if held is not None:
            yield emit(zone, *windows.feed(*held, last=True))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches(evaluate(batches), OUTPUT_ROWS)

    return fold


def detect_panes(panes: DataFrame, cfg: SurgeConfig) -> DataFrame:
    """Evaluations from pane rows ``zone, pane, n, last_ms``.

    The window function that finds each key's first pane also makes the planner bring a
    key's panes together in order, which is what the pass relies on.
    """
    in_order = Window.partitionBy("zone").orderBy("pane")
    rows = panes.select(
        "zone",
        "pane",
        "n",
        (F.col("last_ms") > F.col("pane")).alias("inside"),
        F.min("pane").over(in_order).alias("first_pane"),
    )
    folded = rows.sortWithinPartitions("zone", "pane").mapInArrow(
        _fold_panes(cfg), evaluation_schema(panes.schema["zone"].dataType)
    )
    return classified(folded, cfg)
