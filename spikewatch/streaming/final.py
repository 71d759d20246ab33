"""Streaming detection that evaluates each window once, when the watermark closes it.

A row counts in every window that is still open when it arrives, whichever windows it is
too late for. Like any other row, one that is too late for all still counts towards
its key's first event time.
"""

from __future__ import annotations

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


class FinalProcessor(WindowProcessor):
    """Windows that have fired stay closed."""

    def _needed_from(self, end: int) -> int:
        # Where the next window starts.
        return end + self.cfg.slide_ms - self.cfg.window_ms

    def _is_too_late(self, pane: int, latest: int, watermark: int) -> bool:
        reach = pane + self.cfg.window_ms
        return reach - reach % self.cfg.slide_ms <= watermark

    def _earliest(self, earliest: int, watermark: int) -> int:
        still_open = watermark - watermark % self.cfg.slide_ms + self.cfg.slide_ms
        return max(earliest, still_open)


def detect_final(
    requests: DataFrame,
    cfg: SurgeConfig | None = None,
    key: str = "zone_id",
    time: str = "event_time",
    wait_for_late: bool = True,
    side: Sequence[str] | None = None,
    states: DataFrame | None = None,
) -> DataFrame:
    """One evaluation per closed window, in append mode; needs RocksDB state.

    By default a window closes only after the allowed lateness has passed too, so that
    late rows are in it. ``wait_for_late=False`` closes it at the watermark and gives up
    rows that come after. ``side`` and ``states`` as in
    the other mode.
    """
    cfg = cfg or SurgeConfig()
    delay = cfg.watermark_ms + (cfg.lateness_ms if wait_for_late else 0) + hold_back_ms(cfg)
    rows = (
        collapsed(requests, cfg, cfg.pane_ms, key, time, side)
        .withWatermark("event_time", f"{delay} milliseconds")
        .groupBy("zone")
        .transformWithState(
            FinalProcessor(cfg, bool(side)),
            fired_schema(side),
            "Append",
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
    wait_for_late: bool = True,
) -> DataFrame:
    """What ``detect_final`` would have emitted and kept after a bounded history; see
    ``state_after``."""
    cfg = cfg or SurgeConfig()
    delay = cfg.watermark_ms + (cfg.lateness_ms if wait_for_late else 0)
    return state_after(requests, FinalProcessor(cfg), cfg.pane_ms, delay, key, time)
