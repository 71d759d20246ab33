"""Event-time window counts per key.

Events are first counted into panes (the greatest common divisor of window and
slide), so the shuffle carries one row per key and pane and map task, however many
events a hot key has. Panes, not events, are then spread over the windows they
belong to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikewatch.config import SurgeConfig
from spikewatch.functions.timeline import align_down


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by keys at the session's shuffle width.

    The width is given outright so that adaptive execution does not merge the
    partitions: a pane row is a few bytes, yet it leads to several windows and a step
    in Python each, far more work than the shuffled size suggests.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(width, *keys)


def pane_counts(
    events: DataFrame,
    cfg: SurgeConfig,
    key: str = "zone_id",
    time_ms: str = "event_time_millis",
) -> DataFrame:
    """One row per key and pane: event count, earliest and latest event time."""
    return (
        events.filter(F.col(key).isNotNull() & F.col(time_ms).isNotNull())
        .select(F.col(key).alias("zone"), F.col(time_ms).alias("t"))
        .groupBy("zone", align_down(F.col("t"), cfg.pane_ms).alias("pane"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("t").alias("first_ms"),
            F.max("t").alias("last_ms"),
        )
    )


def pane_ends(cfg: SurgeConfig) -> Column:
    """Ends of all windows that hold the pane starting at column ``pane``."""
    first = align_down(F.col("pane"), cfg.slide_ms) + F.lit(cfg.slide_ms)
    last = align_down(F.col("pane") + F.lit(cfg.window_ms), cfg.slide_ms)
    return F.sequence(first, last, F.lit(cfg.slide_ms).cast("long"))


def caused(cfg: SurgeConfig) -> Column:
    """Whether some event lies past the window's start, so that the window exists."""
    if cfg.is_tumbling:
        return F.lit(True)
    return F.col("last_ms") > F.col("window_end_ms") - F.lit(cfg.window_ms)


def window_counts(
    events: DataFrame,
    cfg: SurgeConfig,
    key: str = "zone_id",
    time_ms: str = "event_time_millis",
) -> DataFrame:
    """One row per key and non-empty window: ``zone, window_end_ms, request_count, first_ms``.

    The panes are partitioned by key before they are spread over windows, so the
    window sums and the ordered pass of the baseline need no further exchange.
    """
    panes = spread(pane_counts(events, cfg, key, time_ms), "zone")
    return (
        panes.withColumn("window_end_ms", F.explode(pane_ends(cfg)))
        .groupBy("zone", "window_end_ms")
        .agg(
            F.sum("n").alias("request_count"),
            F.min("first_ms").alias("first_ms"),
            F.max("last_ms").alias("last_ms"),
        )
        .filter(caused(cfg))
        .select("zone", "window_end_ms", "request_count", "first_ms")
    )


def window_span(of: str, cfg: SurgeConfig) -> Column:
    """``window()`` with *ends* on multiples of the slide.

    ``window()`` aligns starts, so they are shifted when the slide does not divide the
    window. ``of`` is a time column or another window column.
    """
    shift = (cfg.slide_ms - cfg.window_ms % cfg.slide_ms) % cfg.slide_ms
    return F.window(
        F.col(of),
        f"{cfg.window_ms} milliseconds",
        f"{cfg.slide_ms} milliseconds",
        f"{shift} milliseconds",
    )


def window_counts_builtin(
    events: DataFrame,
    cfg: SurgeConfig,
    key: str = "zone_id",
    time: str = "event_time",
) -> DataFrame:
    """The same counts through Spark's ``window()``; also runs on streams."""
    return (
        events.groupBy(F.col(key).alias("zone"), window_span(time, cfg).alias("span"))
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.min(F.unix_millis(F.col(time))).alias("first_ms"),
            F.max(F.unix_millis(F.col(time))).alias("last_ms"),
        )
        .withColumn("window_end_ms", F.unix_millis("span.end"))
        .filter(caused(cfg))
        .select("zone", "window_end_ms", "request_count", "first_ms")
    )
