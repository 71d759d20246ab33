"""Report tables over alert rows.

Alert rows carry ``timestamp, zone, request_count, ema_baseline, status`` and an
ordering column ``row_order`` (any orderable type, unique per row) that tells a window's
re-evaluation from its earlier one. "Last" always means last by timestamp and row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spikewatch.config import SurgeConfig
from spikewatch.functions.numbers import round_table
from spikewatch.schemas import INITIALIZING, NORMAL, SURGE_ALERT

# Display order of the statuses; unknown ones come last.
STATUS_RANK = {SURGE_ALERT: 0, INITIALIZING: 1, NORMAL: 2}
TIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def zone_label(zone: Column) -> Column:
    return F.replace(zone, F.lit("_"), F.lit(" "))


def status_rank(status: Column) -> Column:
    rank = F.lit(len(STATUS_RANK))
    for name, place in STATUS_RANK.items():
        rank = F.when(status == name, place).otherwise(rank)
    return rank


def in_order(alerts: DataFrame) -> DataFrame:
    """Rows sorted by time, re-evaluations after the rows they replace."""
    return alerts.orderBy("timestamp", "row_order")


def last_rows(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key. Tasks keep one row per key before anything is shuffled."""
    newest_first = Window.partitionBy(*keys).orderBy(*(F.desc(name) for name in order))
    ranked = rows.withColumn("_place", F.row_number().over(newest_first))
    return ranked.filter("_place = 1").drop("_place")


def last_evaluations(alerts: DataFrame) -> DataFrame:
    """The last row per window end and zone, so a re-evaluation replaces its first result."""
    kept = last_rows(alerts, ["timestamp", "zone"], ["row_order"])
    return kept.select(
        "timestamp", "zone", "request_count", "ema_baseline", "status", "row_order"
    )


def displayed(rows: DataFrame, cfg: SurgeConfig | None) -> DataFrame:
    cfg = cfg or SurgeConfig()
    start = F.timestamp_millis(F.unix_millis("timestamp") - F.lit(cfg.window_ms))
    above_zero = F.col("ema_baseline") > 0
    return rows.select(
        "*",
        start.alias("window_start"),
        F.when(above_zero, F.col("request_count") / F.col("ema_baseline")).alias("pressure_ratio"),
        (F.col("request_count") - F.col("ema_baseline")).alias("pressure_delta"),
        zone_label(F.col("zone")).alias("zone_label"),
        status_rank(F.col("status")).alias("status_rank"),
    )


def display_rows(alerts: DataFrame, cfg: SurgeConfig | None = None) -> DataFrame:
    """Last evaluations with window start, pressure against the baseline, label and rank."""
    return displayed(last_evaluations(alerts), cfg)


def latest_display(alerts: DataFrame, cfg: SurgeConfig | None = None) -> DataFrame:
    """The display rows that ``latest_by_zone`` would keep, straight from the log.

    A zone's last row of all is also its last evaluation, so the log need not be reduced to
    last evaluations first, and one row per zone and task is shuffled.
    """
    last = last_rows(alerts, ["zone"], ["timestamp", "row_order"])
    return displayed(
        last.select("timestamp", "zone", "request_count", "ema_baseline", "status", "row_order"),
        cfg,
    )


def latest_by_zone(display: DataFrame) -> DataFrame:
    """Each zone's last row, surges first, then by count and name."""
    others = [c for c in display.columns if c != "zone"]
    last = last_rows(display, ["zone"], ["timestamp", "row_order"])
    return last.select("zone", *others).orderBy("status_rank", F.desc("request_count"), "zone")


def zone_status_table(display: DataFrame) -> DataFrame:
    return latest_by_zone(display).select(
        F.col("zone_label").alias("Zone"),
        F.col("request_count").alias("Requests"),
        round_table(F.col("ema_baseline"), 1).alias("Baseline"),
        round_table(F.col("pressure_ratio"), 2).alias("Pressure"),
        F.col("status").alias("Status"),
    )


def recent_table(display: DataFrame, limit: int = 20) -> DataFrame:
    """The last ``limit`` evaluations, newest first, surges first within a time."""
    last = display.orderBy(F.desc("timestamp"), F.desc("row_order")).limit(limit)
    return last.orderBy(F.desc("timestamp"), "status_rank", "zone").select(
        F.date_format("window_start", TIME_TEXT).alias("Window Start"),
        F.date_format("timestamp", TIME_TEXT).alias("Window End"),
        F.col("zone_label").alias("Zone"),
        F.col("request_count").alias("Requests"),
        round_table(F.col("ema_baseline"), 1).alias("Baseline"),
        round_table(F.col("pressure_ratio"), 2).alias("Pressure"),
        F.col("status").alias("Status"),
    )


def surge_counts(display: DataFrame) -> DataFrame:
    """Surge windows per zone; zones without any are absent."""
    return (
        display.filter(F.col("status") == SURGE_ALERT)
        .groupBy("zone_label")
        .agg(F.count(F.lit(1)).alias("surge_alerts"))
        .withColumnRenamed("zone_label", "zone")
    )


def summary_metrics(display: DataFrame) -> DataFrame:
    """One row: windows shown, zones surging now, surge windows, highest count."""
    surging = F.col("status") == SURGE_ALERT
    per_zone = display.groupBy("zone").agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_if(surging).alias("surges"),
        F.max("request_count").alias("peak"),
        # There is one row per zone and time.
        F.max_by(surging, F.unix_micros("timestamp")).alias("surging"),
    )
    return summed(per_zone)


def summed(per_zone: DataFrame) -> DataFrame:
    """The summary from ``windows, surges, peak, surging`` of every zone."""
    return per_zone.agg(
        F.coalesce(F.sum("windows"), F.lit(0)).alias("window_snapshots"),
        F.count_if("surging").alias("active_zone_surges"),
        F.coalesce(F.sum("surges"), F.lit(0)).alias("surge_alerts"),
        F.coalesce(F.max("peak"), F.lit(0)).alias("peak_request_count"),
    )


def source_status(parsed_log: DataFrame) -> DataFrame:
    """One row on the log itself: ``label, rows_loaded, snapshots_shown, latest_window_end,
    malformed_lines``."""
    usable = F.col("error").isNull() & F.col("timestamp").isNotNull()
    latest = F.max(F.when(usable, F.col("timestamp")))
    return parsed_log.agg(
        F.when(F.count_if(usable) > 0, "LIVE").otherwise("WAITING").alias("label"),
        F.count_if(usable).alias("rows_loaded"),
        F.count_distinct(F.when(usable, F.struct("timestamp", "zone"))).alias("snapshots_shown"),
        F.coalesce(
            F.concat(F.date_format(latest, TIME_TEXT), F.lit(" UTC")), F.lit("n/a")
        ).alias("latest_window_end"),
        F.count_if(F.col("error").isNotNull()).alias("malformed_lines"),
    )


def current_against_baseline(display: DataFrame) -> DataFrame:
    """Latest count and baseline of each zone in long form: ``zone, Series, Value``."""
    return (
        latest_by_zone(display)
        .select(
            F.col("zone_label").alias("zone"),
            F.col("request_count").cast("double").alias("Current Requests"),
            F.col("ema_baseline").alias("EMA Baseline"),
        )
        .unpivot("zone", ["Current Requests", "EMA Baseline"], "Series", "Value")
    )


def trend_rows(display: DataFrame) -> DataFrame:
    """Time series of count and baseline per zone."""
    return display.select(
        "timestamp", "zone_label", "request_count", "ema_baseline", "status", "row_order"
    )


def surge_points(display: DataFrame) -> DataFrame:
    """The surge windows of the trend."""
    return trend_rows(display).filter(F.col("status") == SURGE_ALERT)


def zones_by_appearance(display: DataFrame) -> DataFrame:
    """Zone labels in the order they first appear."""
    return (
        display.groupBy("zone_label")
        .agg(F.min("row_order").alias("first_row"))
        .orderBy("first_row")
    )
