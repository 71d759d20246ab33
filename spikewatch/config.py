"""Detection parameters and their checks."""

from __future__ import annotations

import math
from dataclasses import dataclass, fields
from typing import Any


@dataclass(frozen=True)
class SurgeConfig:
    """Parameters of one detection job; times are whole seconds.

    ``parallelism`` becomes ``spark.sql.shuffle.partitions`` when given.
    """

    window_seconds: int = 15
    slide_seconds: int = 5
    watermark_seconds: int = 3
    allowed_lateness_seconds: int = 10
    alpha: float = 0.2
    surge_threshold: float = 2.0
    parallelism: int | None = None

    def __post_init__(self) -> None:
        for name in ("window_seconds", "slide_seconds"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        if self.slide_seconds > self.window_seconds:
            raise ValueError("slide_seconds must not exceed window_seconds")
        for name in ("watermark_seconds", "allowed_lateness_seconds"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")
        for f in fields(self):
            value = getattr(self, f.name)
            if f.name.endswith("_seconds") and int(value) != value:
                raise ValueError(f"{f.name} must be a whole number of seconds")
        if not 0 < self.alpha <= 1:
            raise ValueError("alpha must lie in (0, 1]")
        if not self.surge_threshold > 0:
            raise ValueError("surge_threshold must be positive")
        if self.parallelism is not None and self.parallelism <= 0:
            raise ValueError("parallelism must be positive")

    @classmethod
    def from_options(cls, options: dict[str, Any]) -> SurgeConfig:
        """Build from string-valued options, e.g. job arguments; unknown names fail."""
        known = {f.name for f in fields(cls)}
        unknown = sorted(set(options) - known)
        if unknown:
            raise ValueError(f"unknown options: {', '.join(unknown)}")
        as_float = {"alpha", "surge_threshold"}
        return cls(**{k: float(v) if k in as_float else int(v) for k, v in options.items()})

    @property
    def window_ms(self) -> int:
        return int(self.window_seconds) * 1000

    @property
    def slide_ms(self) -> int:
        return int(self.slide_seconds) * 1000

    @property
    def watermark_ms(self) -> int:
        """Distance of the watermark behind the newest event time (delay plus one millisecond)."""
        return int(self.watermark_seconds) * 1000 + 1

    @property
    def lateness_ms(self) -> int:
        return int(self.allowed_lateness_seconds) * 1000

    @property
    def pane_ms(self) -> int:
        """Widest bucket that tiles every window exactly."""
        return math.gcd(self.window_ms, self.slide_ms)

    @property
    def is_tumbling(self) -> bool:
        return self.window_ms == self.slide_ms
