"""Streaming detection that emits at the watermark and again when late events come in.

A late but admitted event makes windows fire again that already fired; each firing
steps the key's average once more. Events too late for their last window count only
towards the key's first event time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame

from spikewatch.config import SurgeConfig
from spikewatch.streaming.keyed import (
    WindowProcessor,
    collapsed,
    fired_schema,
    hold_back_ms,
    one_per_window,
    state_after,
)


def state_pane_ms(cfg: SurgeConfig) -> int:
    """Widest bucket that tiles windows and the pruning limit exactly."""
    return math.gcd(cfg.window_ms, cfg.slide_ms, cfg.lateness_ms)


class RefireProcessor(WindowProcessor):
    """Late rows bring windows back that have fired."""

    def _needed_from(self, end: int) -> int:
        return end - self.cfg.window_ms - self.cfg.lateness_ms

    def _is_too_late(self, pane: int, latest: int, watermark: int) -> bool:
        return watermark > latest + self.cfg.lateness_ms

    def _earliest(self, earliest: int, watermark: int) -> int:
        return earliest


def detect_refire(
    requests: DataFrame,
    cfg: SurgeConfig | None = None,
    key: str = "zone_id",
    time: str = "event_time",
    side: Sequence[str] | None = None,
    states: DataFrame | None = None,
) -> DataFrame:
    """Evaluations in emission order per key, in update mode; needs RocksDB state.

    With ``side``, columns of the requests, the result is one for ``one_per_window`` and
    ``late_events`` to take apart. ``states`` are those that a new stream starts from, see
    ``history``.
    """
    cfg = cfg or SurgeConfig()
    delay = cfg.watermark_ms + hold_back_ms(cfg)
    rows = (
        collapsed(requests, cfg, state_pane_ms(cfg), key, time, side)
        .withWatermark("event_time", f"{delay} milliseconds")
        .groupBy("zone")
        .transformWithState(
            RefireProcessor(cfg, bool(side)),
            fired_schema(side),
            "Update",
            "EventTime",
            None if states is None else states.groupBy("zone"),
        )
    )
    return rows if side else one_per_window(rows, cfg)


def history(
    requests: DataFrame,
    cfg: SurgeConfig | None = None,
    key: str = "zone_id",
    time: str = "event_time",
) -> DataFrame:
    """What ``detect_refire`` would have emitted and kept after a bounded history; see
    ``state_after``."""
    cfg = cfg or SurgeConfig()
    return state_after(requests, RefireProcessor(cfg), state_pane_ms(cfg), cfg.watermark_ms, key, time)
