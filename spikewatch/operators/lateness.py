"""Arrival audit: how every event stood against the watermark when it came in.

``arrival`` is a whole number saying when a row came in: a micro-batch number, a clock
tick or a running number. Rows with the same arrival do not see each other, as in one
micro-batch or one watermark interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spikewatch.config import SurgeConfig
from spikewatch.functions.timeline import align_down, latest_end, next_end
from spikewatch.sources.requests import late_line

ON_TIME = "on_time"
OUT_OF_ORDER = "out_of_order"
LATE_REFIRE = "late_refire"
DROPPED = "dropped"

# Widths of the chunks the running maximum is taken in, each 65,536 of the one before. Above
# the widest, any whole numbers leave 65,536 rows at most.
WIDTHS = (1 << 16, 1 << 32, 1 << 48)


def _before(rows: DataFrame, widths: tuple[int, ...]) -> DataFrame:
    """``at, before``: the largest ``top`` among the rows with a smaller ``at``.

    The joins are null-safe, so that no filters are inferred and pushed below them. The
    uses of ``rows`` then stay alike and share one scan and one shuffle.
    """
    own = F.max("top")
    if not widths:
        every = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        return rows.select("at", own.over(every).alias("before"))
    chunk = align_down(F.col("at"), widths[0])
    placed = rows.withColumn("chunk", chunk)
    tops = placed.groupBy("chunk").agg(own.alias("top")).withColumnRenamed("chunk", "at")
    above = _before(tops, widths[1:]).toDF("above", "above_before")
    inside = Window.partitionBy(placed["chunk"]).orderBy("at")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(above, placed["chunk"].eqNullSafe(above["above"])).select(
        "at", F.greatest("above_before", own.over(inside)).alias("before")
    )


def newest_before(events: DataFrame, arrival: str, time_ms: str) -> DataFrame:
    """Per arrival the newest event time among strictly earlier arrivals, ``newest_ms``.

    Each arrival is first reduced to its maximum, so a bulk arrival costs one row. The
    running maximum is then taken inside chunks, over chunks inside wider chunks, and so on:
    no group holds more than 65,536 rows, whatever the unit of the arrivals.
    """
    ticks = events.groupBy(F.col(arrival).cast("bigint").alias("at")).agg(
        F.max(time_ms).alias("top")
    )
    return _before(ticks, WIDTHS).toDF("arrival", "newest_ms")


def arrival_class(cfg: SurgeConfig, event_ms: Column, newest_ms: Column) -> Column:
    """Class of one event given the newest event time that came in before it."""
    watermark = newest_ms - F.lit(cfg.watermark_ms)
    return (
        F.when(watermark > latest_end(event_ms, cfg) + F.lit(cfg.lateness_ms), DROPPED)
        .when(next_end(event_ms, cfg) <= watermark, LATE_REFIRE)
        .when(event_ms < newest_ms, OUT_OF_ORDER)
        .otherwise(ON_TIME)
    )


def audit_arrivals(
    events: DataFrame,
    cfg: SurgeConfig,
    arrival: str = "arrival",
    time_ms: str = "event_time_millis",
) -> DataFrame:
    """Add ``watermark_ms`` (null before the first one), ``lag_ms`` and ``arrival_class``.

    The join has one row per arrival on its right side; a bulk arrival makes the left
    side skewed, which adaptive execution splits.
    """
    newest = newest_before(events, arrival, time_ms).withColumnRenamed("arrival", "_arrival")
    joined = events.join(newest, F.col(arrival).eqNullSafe(F.col("_arrival")), "left")
    return audited_by(joined, F.col("newest_ms"), cfg, time_ms).drop("newest_ms", "_arrival")


def audited_by(
    events: DataFrame, newest_ms: Column, cfg: SurgeConfig, time_ms: str = "event_time_millis"
) -> DataFrame:
    """The audit's columns, given the newest event time that came in before each event."""
    event_ms = F.col(time_ms)
    return events.select(
        "*",
        (newest_ms - F.lit(cfg.watermark_ms)).alias("watermark_ms"),
        F.greatest(F.lit(0), F.coalesce(newest_ms - event_ms, F.lit(0))).alias("lag_ms"),
        arrival_class(cfg, event_ms, newest_ms).alias("arrival_class"),
    )


def lateness_summary(audited: DataFrame, key: str = "zone_id") -> DataFrame:
    """Per key and class: events, largest lag, share flagged as simulated late."""
    return audited.groupBy(F.col(key).alias("zone"), "arrival_class").agg(
        F.count(F.lit(1)).alias("events"),
        F.max("lag_ms").alias("max_lag_ms"),
        F.avg(F.col("is_simulated_late").cast("int")).alias("flagged_share"),
    )


def late_lines(audited: DataFrame) -> DataFrame:
    """Side output: one text line per dropped request."""
    return audited.filter(F.col("arrival_class") == DROPPED).select(late_line().alias("value"))
