"""The baseline over very long histories: one key's windows split over many tasks.

A key's moving average is a chain through all its windows, rounded at each step. To
cut the chain without changing a single bit, each (key, block of window slots) is
summarised on its own, a short walk per key over the summaries finds the average
entering every block, and the blocks are then folded in parallel.

The summary uses that a step ``alpha * count + (1 - alpha) * average`` never reverses
the order of two averages, rounding included. Folding the lowest and the highest
possible average through the first windows of a block (the head) therefore encloses
the true one, and after enough windows the two ends are equal or a few adjacent
doubles. All doubles between them are carried to the end of the block. The walk folds
the head counts with the true average, finds it among the enclosed doubles and reads
off where it leaves. Blocks with few windows, or where the ends stay far apart, list
all their counts as head, so the result is exact for every input.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spikewatch.config import SurgeConfig
from spikewatch.functions.timeline import align_down
from spikewatch.operators.baseline import (
    classified,
    evaluation_schema,
    fold_counts,
    run_starts,
)
from spikewatch.operators.windows import caused, pane_counts, spread

# Counts stay below this, and with them every average.
TOP = float(2**53)
# More enclosed doubles than this are not tabulated; such a block lists all its counts.
MAX_ENCLOSED = 1024
MOST_STEPS = 2**31


def settling_steps(alpha: float) -> int:
    """Steps after which any two averages in [0, TOP] differ by rounding only.

    For the smallest alphas a number no history reaches, so that nothing is split.
    """
    if alpha == 1:
        return 1
    halvings = -math.log1p(-alpha) / math.log(2)
    return math.ceil(108 / halvings) if halvings > 108 / MOST_STEPS else MOST_STEPS


def warm_slots(cfg: SurgeConfig) -> int:
    """Upper bound on the windows of a key that can be warming up."""
    return cfg.window_ms // cfg.slide_ms + 1


def head_rows(cfg: SurgeConfig) -> int:
    return warm_slots(cfg) + settling_steps(cfg.alpha)


def block_span_ms(cfg: SurgeConfig, block_windows: int) -> int:
    """Length of a block; at least eight heads, so that summaries stay small."""
    return max(block_windows, 8 * head_rows(cfg)) * cfg.slide_ms


def block_windows_of(
    events: DataFrame, cfg: SurgeConfig, span_ms: int, key: str, time_ms: str
) -> DataFrame:
    """Window counts partitioned by ``(zone, block)``, ``block`` being the block's first end."""
    first = align_down(F.col("pane"), cfg.slide_ms) + F.lit(cfg.slide_ms)
    last = align_down(F.col("pane") + F.lit(cfg.window_ms), cfg.slide_ms)
    span = F.lit(span_ms).cast("long")
    slide = F.lit(cfg.slide_ms).cast("long")
    panes = (
        pane_counts(events, cfg, key, time_ms)
        .withColumn("first_end", first)
        .withColumn("last_end", last)
        .withColumn(
            "block",
            F.explode(
                F.sequence(
                    align_down(F.col("first_end"), span_ms),
                    align_down(F.col("last_end"), span_ms),
                    span,
                )
            ),
        )
    )
    ends = F.sequence(
        F.greatest("first_end", "block"),
        F.least(F.col("last_end"), F.col("block") + span - slide),
        slide,
    )
    return (
        spread(panes, "zone", "block")
        .withColumn("window_end_ms", F.explode(ends))
        .groupBy("zone", "block", "window_end_ms")
        .agg(
            F.sum("n").alias("request_count"),
            F.min("first_ms").alias("first_ms"),
            F.max("last_ms").alias("last_ms"),
        )
        .filter(caused(cfg))
        .drop("last_ms")
    )


def _block_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole (zone, block) runs of sorted batches; a run is at most one block long."""
    pending: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        cuts = sorted(
            {*run_starts(batch.column("zone")), *run_starts(batch.column("block")), batch.num_rows}
        )
        for lo, hi in zip(cuts, cuts[1:]):
            piece = batch.slice(lo, hi - lo)
            if pending and any(
                pending[0].column(c)[0] != piece.column(c)[0] for c in ("zone", "block")
            ):
                yield pa.Table.from_batches(pending)
                pending = []
            pending.append(piece)
    if pending:
        yield pa.Table.from_batches(pending)


def enclosed_averages(counts: np.ndarray, alpha: float) -> np.ndarray:
    """All doubles the average can equal after these counts, whatever it was before."""
    (_, low), (_, high) = (fold_counts(counts.tolist(), 0, x, alpha) for x in (0.0, TOP))
    # Doubles of one sign are ordered like their bit patterns.
    bits = np.array([low, high]).view(np.int64)
    return np.arange(bits[0], min(bits[1], bits[0] + MAX_ENCLOSED) + 1).view(np.float64)


def carry_averages(averages: np.ndarray, counts: np.ndarray, alpha: float) -> np.ndarray:
    """Each average after folding the counts, element by element."""
    keep = 1 - alpha
    for i, count in enumerate(counts.tolist()):
        if i % 64 == 0 and (averages == averages[0]).all():
            _, last = fold_counts(counts[i:].tolist(), 0, float(averages[0]), alpha)
            return np.full(len(averages), last)
        averages = alpha * count + keep * averages
    return averages


def _in_batches(tables: Iterator[pa.Table], size: int = 16384) -> Iterator[pa.RecordBatch]:
    """Many small tables as fewer batches, closed once they hold ``size`` values."""
    held: list[pa.Table] = []
    values = 0
    for table in tables:
        held.append(table)
        values += table.nbytes // 8
        if values >= size:
            yield from pa.concat_tables(held).combine_chunks().to_batches()
            held, values = [], 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches()


def _summary(run: pa.Table, alpha: float, warm: int, head: int) -> pa.Table:
    ends = run.column("window_end_ms").to_numpy()
    counts = run.column("request_count").to_numpy()
    enter = leave = np.empty(0)
    listed = len(counts)
    if len(counts) > head:
        inside = enclosed_averages(counts[warm:head], alpha)
        if len(inside) <= MAX_ENCLOSED:
            enter, listed = inside, head
            leave = carry_averages(inside, counts[head:], alpha)
    return (
        run.select(["zone", "block", "first_ms"])
        .slice(0, 1)
        .append_column("ends", pa.array([ends[:listed]], pa.list_(pa.int64())))
        .append_column("counts", pa.array([counts[:listed]], pa.list_(pa.int64())))
        .append_column("enter", pa.array([enter], pa.list_(pa.float64())))
        .append_column("leave", pa.array([leave], pa.list_(pa.float64())))
    )


def _summarise(alpha: float, warm: int, head: int) -> Callable:
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(_summary(run, alpha, warm, head) for run in _block_runs(batches))

    return summarise


def _walk(alpha: float) -> Callable:
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zone, average = None, None
        for batch in batches:
            entering = []
            for row in batch.to_pylist():
                if row["zone"] != zone:
                    zone, average = row["zone"], None
                entering.append(average)
                warm = int(np.searchsorted(row["ends"], row["warm_until"], side="right"))
                _, average = fold_counts(row["counts"], warm, average, alpha)
                if row["enter"]:
                    at = bisect_left(row["enter"], average)
                    if row["enter"][at] != average:
                        raise AssertionError("average outside its enclosure")
                    average = row["leave"][at]
            yield batch.select(["zone", "block", "warm_until"]).append_column(
                "entering", pa.array(entering, pa.float64())
            )

    return walk


def _folded(run: pa.Table, alpha: float) -> pa.Table:
    counts = run.column("request_count").to_pylist()
    warm = int(np.count_nonzero(run.column("warming").to_numpy()))
    shown, _ = fold_counts(counts, warm, run.column("entering")[0].as_py(), alpha)
    return run.select(["zone", "window_end_ms", "request_count", "warming"]).append_column(
        "ema_baseline", pa.array(shown, pa.float64())
    )


def _fold_blocks(alpha: float) -> Callable:
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(_folded(run, alpha) for run in _block_runs(batches))

    return fold


def detect_long(
    events: DataFrame,
    cfg: SurgeConfig,
    key: str = "zone_id",
    time_ms: str = "event_time_millis",
    block_windows: int = 65536,
) -> DataFrame:
    """Batch detection with the same result as the plain form, bit for bit.

    Both passes over the window counts read the one shuffle of pane rows.
    """
    span = block_span_ms(cfg, block_windows)
    windows = block_windows_of(events, cfg, span, key, time_ms)
    zone_type = windows.schema["zone"].dataType
    zone, block = T.StructField("zone", zone_type), T.StructField("block", T.LongType())
    longs, doubles = T.ArrayType(T.LongType()), T.ArrayType(T.DoubleType())
    in_block = Window.partitionBy("zone", "block").orderBy("window_end_ms")
    in_zone = Window.partitionBy("zone").orderBy("block")

    summaries = (
        windows.withColumn("first_ms", F.min("first_ms").over(in_block))
        .sortWithinPartitions("zone", "block", "window_end_ms")
        .mapInArrow(
            _summarise(cfg.alpha, warm_slots(cfg), head_rows(cfg)),
            T.StructType(
                [
                    zone,
                    block,
                    T.StructField("first_ms", T.LongType()),
                    T.StructField("ends", longs),
                    T.StructField("counts", longs),
                    T.StructField("enter", doubles),
                    T.StructField("leave", doubles),
                ]
            ),
        )
    )
    entering = (
        summaries.withColumn("warm_until", F.min("first_ms").over(in_zone) + F.lit(cfg.window_ms))
        .sortWithinPartitions("zone", "block")
        .mapInArrow(
            _walk(cfg.alpha),
            T.StructType(
                [
                    zone,
                    block,
                    T.StructField("warm_until", T.LongType()),
                    T.StructField("entering", T.DoubleType()),
                ]
            ),
        )
    )
    folded = (
        windows.join(entering, ["zone", "block"])
        .select(
            "zone",
            "block",
            "window_end_ms",
            "request_count",
            # Unused below; without it the two passes would prune differently and
            # the shuffle of pane rows would run twice.
            "first_ms",
            (F.col("window_end_ms") <= F.col("warm_until")).alias("warming"),
            F.first("entering").over(in_block).alias("entering"),
        )
        .sortWithinPartitions("zone", "block", "window_end_ms")
        .mapInArrow(_fold_blocks(cfg.alpha), evaluation_schema(zone_type))
    )
    return classified(folded, cfg)
