"""The detection rules by brute force: every event kept, every window counted anew."""

from __future__ import annotations

from collections import defaultdict

from spikewatch.config import SurgeConfig


def ends_of(e: int, cfg: SurgeConfig) -> list[int]:
    """Window ends an event causes: its next slide boundary, and all below event + window."""
    w, s = cfg.window_ms, cfg.slide_ms
    nxt = next(t for t in range(e // s * s, e + s + 1, s) if t > e)
    return [t for t in range(nxt, e + w + 1, s) if t == nxt or t < e + w]


class Model:
    def __init__(self, cfg: SurgeConfig) -> None:
        self.cfg = cfg
        self.kept: dict[str, list[int]] = defaultdict(list)
        self.pending: dict[str, set[int]] = defaultdict(set)
        self.first: dict[str, int] = {}
        self.ema: dict[str, float] = {}
        self.out: dict[str, list[tuple]] = defaultdict(list)
        self.newest: int | None = None
        self.dropped: list[tuple] = []

    def _watermark(self) -> int | None:
        return None if self.newest is None else self.newest - self.cfg.watermark_ms

    def _fire_up_to(self, limit: int | None) -> None:
        if limit is None:
            return
        cfg = self.cfg
        for zone, pending in self.pending.items():
            for t in sorted(x for x in pending if x <= limit):
                pending.remove(t)
                n = len([e for e in self.kept[zone] if t - cfg.window_ms <= e < t])
                if zone not in self.ema or t <= self.first[zone] + cfg.window_ms:
                    row = (t, n, float(n), "INITIALIZING")
                    self.ema[zone] = float(n)
                else:
                    old = self.ema[zone]
                    surge = n > cfg.surge_threshold * old
                    row = (t, n, old, "SURGE_ALERT" if surge else "NORMAL")
                    self.ema[zone] = cfg.alpha * n + (1 - cfg.alpha) * old
                self.out[zone].append(row)
                oldest = t - cfg.window_ms - cfg.lateness_ms
                self.kept[zone] = [e for e in self.kept[zone] if e >= oldest]

    def batch(self, rows: list[tuple[str, int]]) -> None:
        mark = self._watermark()
        for zone, e in rows:
            self.first[zone] = min(e, self.first.get(zone, e))
            ends = ends_of(e, self.cfg)
            if mark is not None and mark > ends[-1] + self.cfg.lateness_ms:
                self.dropped.append((zone, e))
                continue
            self.kept[zone].append(e)
            self.pending[zone].update(ends)
        self._fire_up_to(mark)
        for _, e in rows:
            self.newest = e if self.newest is None else max(self.newest, e)
        self._fire_up_to(self._watermark())

    def flush(self) -> None:
        self._fire_up_to(2**62)


def batch_rows(rows: list[tuple[str, int]], cfg: SurgeConfig) -> dict[str, list[tuple]]:
    """Result over a bounded input read in one go."""
    model = Model(cfg)
    model.batch(rows)
    model.flush()
    return model.out


# Pulses per zone as (start second, end second, extra events per tick).
PULSES = {
    "Downtown": ((18, 22, 8), (31, 35, 7)),
    "Airport": ((24, 28, 6),),
    "Suburb_North": ((28, 31, 5),),
    "University_Campus": ((36, 40, 6),),
}
CYCLE_S = 45
START_MS = 1774288800000


def replay(seconds: int, delays: dict[int, int] | None = None) -> list[list[tuple[str, int]]]:
    """Default demand, one batch per quarter second; ``delays`` moves Downtown's first event."""
    batches = []
    for tick in range(seconds * 4):
        at = START_MS + tick * 250
        batch = []
        for zone, pulses in PULSES.items():
            extra = sum(x for lo, hi, x in pulses if lo <= tick / 4 % CYCLE_S < hi)
            batch += [(zone, at)] * (1 + extra)
        late = (delays or {}).get(tick // 4, 0) if tick % 4 == 0 else 0
        if late:
            batch[0] = ("Downtown", at - late * 1000)
        batches.append(batch)
    return batches
