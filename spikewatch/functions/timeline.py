"""Window-end arithmetic and time text, as column expressions over epoch milliseconds.

Window ends are the multiples of the slide. An event counts in every window
``[end - window, end)`` that holds it, but it only *causes* windows whose end lies
strictly below ``event + window``: one sitting exactly on a window's start never
brings that window into being.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spikewatch.config import SurgeConfig

# Event times admitted: the years 1000 to 2999. A stream cannot tell others from no watermark.
EARLIEST_MS, BEYOND_MS = -30_610_224_000_000, 32_503_680_000_000


def admitted(ms: Column) -> Column:
    """Whether an event time lies in the years admitted."""
    return (ms >= EARLIEST_MS) & (ms < BEYOND_MS)


def align_down(ms: Column, step_ms: int) -> Column:
    """Largest multiple of the step at or below ``ms``; right before 1970 too."""
    return ms - F.pmod(ms, F.lit(step_ms).cast("long"))


def next_end(ms: Column, cfg: SurgeConfig) -> Column:
    """Earliest window end strictly after the event."""
    return align_down(ms, cfg.slide_ms) + F.lit(cfg.slide_ms)


def latest_end(ms: Column, cfg: SurgeConfig) -> Column:
    """Last window end the event causes."""
    below_reach = align_down(ms + F.lit(cfg.window_ms - 1), cfg.slide_ms)
    return F.greatest(next_end(ms, cfg), below_reach)


def millis_of(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp column, finer digits cut off."""
    return F.unix_millis(ts.cast("timestamp"))


def iso_utc(ms: Column) -> Column:
    """ISO-8601 text with ``Z``; six fraction digits only when there is a fraction."""
    ts = F.timestamp_millis(ms)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    fraction = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.when(F.pmod(ms, F.lit(1000)) == 0, whole).otherwise(fraction)


# Dates with or without a time of day, seconds, a fraction and an offset. What a cast reads
# beyond these would depend on the day it runs (a time alone) or on a zone's rules (its name).
ISO_TEXT = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,9})?)?(Z|[+-]\d{2}(:\d{2}(:\d{2})?)?)?)?$"
)


def parse_iso(text: Column) -> Column:
    """Timestamp of ISO-8601 text in extended form, null when unreadable; no offset means UTC."""
    return F.when(text.rlike(ISO_TEXT), F.try_to_timestamp(text))


def parse_iso_millis(text: Column) -> Column:
    """The same in epoch milliseconds."""
    return F.unix_millis(parse_iso(text))
