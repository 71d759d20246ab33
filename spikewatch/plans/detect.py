"""Batch detection: events in, one evaluated window per row out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spikewatch.config import SurgeConfig
from spikewatch.functions.numbers import round_cents
from spikewatch.operators.panefold import detect_panes
from spikewatch.operators.windows import pane_counts, spread


def detect(
    events: DataFrame,
    cfg: SurgeConfig | None = None,
    key: str = "zone_id",
    time_ms: str = "event_time_millis",
) -> DataFrame:
    """Evaluate every window of a bounded input, the still open ones at its end included.

    Returns ``zone, window_end_ms, request_count, ema_baseline, status``, unrounded.
    """
    cfg = cfg or SurgeConfig()
    return detect_panes(spread(pane_counts(events, cfg, key, time_ms), "zone"), cfg)


def as_alerts(evaluations: DataFrame) -> DataFrame:
    """Alert rows: typed window end, key as text, baseline at two decimals."""
    ordering = [c for c in ("emit_batch", "emit_seq") if c in evaluations.columns]
    return evaluations.select(
        F.timestamp_millis("window_end_ms").alias("timestamp"),
        F.col("zone").cast("string").alias("zone"),
        "request_count",
        round_cents(F.col("ema_baseline")).alias("ema_baseline"),
        "status",
        *ordering,
    )
