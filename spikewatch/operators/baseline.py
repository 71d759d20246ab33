"""Moving-average baseline and classification of window counts.

The average is an ordered recursion per key with a rounding step at each window, so
it runs as one sequential pass over rows sorted by key and window end. The pass
streams through a partition with two numbers of state; rows per key are bounded by
the time range over the slide, not by the number of events.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spikewatch.config import SurgeConfig
from spikewatch.schemas import INITIALIZING, NORMAL, SURGE_ALERT


def run_starts(column: pa.Array) -> list[int]:
    """Offsets at which a new value begins in a sorted column."""
    n = len(column)
    if n < 2:
        return list(range(n))
    change = pc.not_equal(column.slice(1), column.slice(0, n - 1)).fill_null(True)
    return [0, *(np.flatnonzero(change.to_numpy(zero_copy_only=False)) + 1).tolist()]


def in_batches(parts: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Many small batches as fewer, each closed once it holds that many rows."""
    held: list[pa.RecordBatch] = []
    size = 0
    for part in parts:
        held.append(part)
        size += part.num_rows
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def fold_counts(
    counts: list[int], warm: int, average: float | None, alpha: float
) -> tuple[list[float], float | None]:
    """Baselines shown for successive counts, and the average after them.

    The first ``warm`` counts restart the average; later ones see the average from
    before their own contribution.
    """
    keep = 1 - alpha
    shown = [float(c) for c in counts[:warm]]
    if shown:
        average = shown[-1]
    for count in counts[warm:]:
        shown.append(average)
        average = alpha * count + keep * average
    return shown, average


def _fold_partition(alpha: float) -> Callable:
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zone, average = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            zones = batch.column("zone")
            warming = batch.column("warming").to_numpy(zero_copy_only=False)
            counts = batch.column("request_count").to_pylist()
            starts = run_starts(zones)
            shown: list[float] = []
            for lo, hi in zip(starts, [*starts[1:], len(counts)]):
                if zones[lo].as_py() != zone:
                    zone, average = zones[lo].as_py(), None
                warm = int(np.count_nonzero(warming[lo:hi]))
                part, average = fold_counts(counts[lo:hi], warm, average, alpha)
                shown.extend(part)
            yield batch.append_column("ema_baseline", pa.array(shown, pa.float64()))

    return fold


def status_of(count: Column, baseline: Column, warming: Column, threshold: float) -> Column:
    """Warming windows initialise; others surge when strictly above threshold x baseline."""
    return (
        F.when(warming, INITIALIZING)
        .when(count > F.lit(float(threshold)) * baseline, SURGE_ALERT)
        .otherwise(NORMAL)
    )


def evaluation_schema(zone: T.DataType) -> T.StructType:
    """Output of the folds."""
    return T.StructType(
        [
            T.StructField("zone", zone),
            T.StructField("window_end_ms", T.LongType()),
            T.StructField("request_count", T.LongType()),
            T.StructField("warming", T.BooleanType()),
            T.StructField("ema_baseline", T.DoubleType()),
        ]
    )


def classified(folded: DataFrame, cfg: SurgeConfig) -> DataFrame:
    """Replace the ``warming`` flag by the ``status``."""
    status = status_of(
        F.col("request_count"), F.col("ema_baseline"), F.col("warming"), cfg.surge_threshold
    )
    return folded.withColumn("status", status).drop("warming")


def ema_baseline(windows: DataFrame, cfg: SurgeConfig) -> DataFrame:
    """Add the unrounded ``ema_baseline`` and the ``status`` to window counts.

    ``windows`` holds ``zone, window_end_ms, request_count, first_ms``. The window
    function that finds each key's first event also makes the planner bring a key's
    rows together in order, which is the order the fold relies on.
    """
    in_order = Window.partitionBy("zone").orderBy("window_end_ms")
    warm_until = F.min("first_ms").over(in_order) + F.lit(cfg.window_ms)
    rows = windows.select(
        "zone",
        "window_end_ms",
        "request_count",
        (F.col("window_end_ms") <= warm_until).alias("warming"),
    )
    folded = rows.sortWithinPartitions("zone", "window_end_ms").mapInArrow(
        _fold_partition(cfg.alpha), evaluation_schema(windows.schema["zone"].dataType)
    )
    return classified(folded, cfg)
