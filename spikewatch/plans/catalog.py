"""Every operator as a named query over the given tables.

Each query takes ``(spark, sf_dir)``. Times come out as ISO text and baselines at six
decimals, so that results can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spikewatch.config import SurgeConfig
from spikewatch.functions.jsontext import not_blank
from spikewatch.functions.timeline import iso_utc, latest_end, millis_of, next_end
from spikewatch.operators import report
from spikewatch.operators.history import detect_long
from spikewatch.operators.lateness import audit_arrivals, late_lines, lateness_summary
from spikewatch.operators.schedule import annotate_schedule, annotate_versions
from spikewatch.operators.windows import window_counts, window_counts_builtin
from spikewatch.plans.detect import as_alerts, detect
from spikewatch.plans.jobs import from_history, requests_of, start_job
from spikewatch.plans.standing import Standing
from spikewatch.session import configure, shared_dir
from spikewatch.sources.alert_log import (
    alert_line,
    alerts_between,
    log_lines,
    log_quality,
    parse_alerts,
    status_message,
    stored_schema,
    valid_alerts,
    write_batch,
)
from spikewatch.sources.lines import read_lines, stream_lines
from spikewatch.sources.requests import (
    accepted,
    parse_requests,
    reject_counts,
    rejected,
    request_line,
)
from spikewatch.streaming.arrivals import audited_rows, start_audit

Query = Callable[[SparkSession, str], DataFrame]

HOUR, DAY = 3600, 86400
BY_TYPE = SurgeConfig(window_seconds=6 * HOUR, slide_seconds=2 * HOUR, surge_threshold=1.5)
BY_USER = SurgeConfig(window_seconds=DAY, slide_seconds=8 * HOUR)
TUMBLING = SurgeConfig(window_seconds=DAY, slide_seconds=DAY)
UNEVEN = SurgeConfig(window_seconds=12 * HOUR, slide_seconds=5 * HOUR, surge_threshold=1.5)
WEEKLY = SurgeConfig(window_seconds=7 * DAY, slide_seconds=DAY, surge_threshold=1.2)
LATE = SurgeConfig(
    window_seconds=6 * HOUR,
    slide_seconds=2 * HOUR,
    watermark_seconds=HOUR,
    allowed_lateness_seconds=2 * HOUR,
    surge_threshold=1.5,
)
# Start of the second run in the report log.
RERUN_FROM = "2024-01-11T00:00:00Z"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as requests: one zone per event type."""
    configure(spark)
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    return table.withColumn("event_time_millis", millis_of(F.col("ts"))).withColumnRenamed(
        "event_type", "zone_id"
    )


def shown(evaluations: DataFrame) -> DataFrame:
    return evaluations.select(
        F.col("zone").cast("string").alias("zone"),
        iso_utc(F.col("window_end_ms")).alias("window_end"),
        "request_count",
        F.round("ema_baseline", 6).alias("ema_baseline"),
        "status",
    )


def detect_by_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(detect(events(spark, sf_dir), BY_TYPE))


def detect_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(detect(events(spark, sf_dir), BY_USER, key="user_id"))


def detect_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(detect(events(spark, sf_dir), TUMBLING, key="user_id"))


def detect_uneven_slide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(detect(events(spark, sf_dir), UNEVEN))


def _dated(spark: SparkSession, sf_dir: str, table: str, zone: str, date: str) -> DataFrame:
    configure(spark)
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return rows.select(F.col(zone).alias("zone_id"), millis_of(F.col(date)).alias("day_ms"))


def detect_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _dated(spark, sf_dir, "orders", "o_orderpriority", "o_orderdate")
    return shown(detect(rows, WEEKLY, time_ms="day_ms"))


def detect_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _dated(spark, sf_dir, "lineitem", "l_returnflag", "l_shipdate")
    return shown(detect(rows, WEEKLY, time_ms="day_ms"))


def detect_long_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _dated(spark, sf_dir, "lineitem", "l_returnflag", "l_shipdate")
    return shown(detect_long(rows, WEEKLY, time_ms="day_ms", block_windows=1))


def _window_rows(windows: DataFrame) -> DataFrame:
    return windows.select(
        F.col("zone").cast("string").alias("zone"),
        iso_utc(F.col("window_end_ms")).alias("window_end"),
        "request_count",
        iso_utc(F.col("first_ms")).alias("first_event"),
    )


def window_counts_by_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_rows(window_counts(events(spark, sf_dir), UNEVEN, key="user_id"))


def window_counts_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = events(spark, sf_dir).withColumn("event_time", F.timestamp_millis("event_time_millis"))
    return _window_rows(window_counts_builtin(timed, UNEVEN, key="user_id"))


def window_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_time_millis")
    return events(spark, sf_dir).select(
        "event_id",
        iso_utc(next_end(t, UNEVEN)).alias("first_end"),
        iso_utc(latest_end(t, UNEVEN)).alias("last_end"),
    )


# Ingest. The lines are the events as JSON; every 97th is damaged, each way in turn.


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = events(spark, sf_dir)
    number = F.col("event_id")
    ride = F.format_string('"ride_id":"ride-%d"', number)
    zone = F.concat(F.lit('"zone_id":"'), F.col("zone_id"), F.lit('"'))
    time = F.concat(F.lit('"timestamp":"'), iso_utc(F.col("event_time_millis")), F.lit('"'))
    late = F.concat(
        F.lit('"is_simulated_late":'),
        F.when(number % 11 == 0, "true").when(number % 11 == 1, "0").otherwise("false"),
    )

    def line(*parts: Column) -> Column:
        return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))

    explicit = F.format_string('"event_time_millis":%d', F.col("event_time_millis"))
    way = F.floor(number / 97) % 18
    nested = F.lit('{"a":' * 9 + "1" + "}" * 9 + " trailing")
    damaged = (
        F.when(way == 0, F.concat(F.lit("{"), ride, F.lit(","), zone))
        .when(way == 1, line(ride, time, late))
        .when(way == 2, line(ride, zone, F.lit('"timestamp":"soon"'), late))
        .when(way == 3, line(ride, zone, time, F.lit('"is_simulated_late":"false"')))
        .when(way == 4, line(ride, zone, time, F.lit('"event_time_millis":12.7'), late))
        .when(way == 5, F.lit("   "))
        .when(way == 6, line(zone, late))
        .when(way == 7, F.concat(line(ride, zone, time), line(ride, zone, time)))
        .when(way == 8, line(ride, zone, time))
        .when(way == 9, F.concat(line(ride, zone, time), F.lit('{"ride_id":"r2","zone_id":"z","times')))
        .when(way == 10, F.concat(line(ride, zone, time), F.lit("{")))
        .when(way == 11, F.concat(line(ride, zone, time), F.lit(" {{{ junk")))
        .when(way == 12, nested)
        .when(way == 13, line(ride, zone, F.lit('"timestamp":"12:30"'), late))
        .when(way == 14, line(ride, zone, F.lit('"timestamp":"2024"'), late))
        .when(way == 15, line(ride, zone, F.lit('"timestamp":"2024-01-05T10:00:00 America/New_York"')))
        .when(way == 16, line(ride, zone, F.lit('"timestamp":"9999-12-31T00:00:00Z"'), late))
        .otherwise(line(ride, zone, F.lit('"timestamp":"soon"'), explicit))
    )
    whole = F.when(number % 5 == 0, line(ride, zone, time, explicit, late)).otherwise(
        line(ride, zone, time, late)
    )
    return source.select(F.when(number % 97 == 0, damaged).otherwise(whole).alias("value"))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines through text files: written, then read back and parsed."""
    path = shared_dir(spark, "request-lines")
    raw_lines(spark, sf_dir).write.text(path)
    return parse_requests(read_lines(spark, path))


def _parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_requests(raw_lines(spark, sf_dir).filter(not_blank(F.col("value"))))


def requests_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(_parsed_lines(spark, sf_dir))


def requests_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected(_parsed_lines(spark, sf_dir))


def requests_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_counts(_parsed_lines(spark, sf_dir))


def requests_failfast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines known to be whole pass the strict reader unchanged."""
    whole = rejected_free_lines(spark, sf_dir)
    return accepted(parse_requests(whole), failfast=True)


def rejected_free_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as its own well-formed line."""
    return events(spark, sf_dir).select(
        F.to_json(
            F.struct(
                F.col("event_id").cast("string").alias("ride_id"),
                "zone_id",
                iso_utc(F.col("event_time_millis")).alias("timestamp"),
            )
        ).alias("value")
    )


def requests_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(parse_requests(raw_lines(spark, sf_dir))).select(request_line().alias("value"))


def detect_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch path: text lines to evaluated windows."""
    return shown(detect(accepted(_parsed(spark, sf_dir)), BY_TYPE))


# Alerts and their log.


def alert_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_alerts(detect(events(spark, sf_dir), BY_TYPE)).select(alert_line().alias("value"))


def alert_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "alert-log")
    write_batch(as_alerts(detect(events(spark, sf_dir), BY_USER, key="user_id")), path, 0)
    kept = valid_alerts(parse_alerts(log_lines(spark, path)))
    return kept.select(
        iso_utc(F.unix_millis("timestamp")).alias("window_end"),
        "zone",
        "request_count",
        "ema_baseline",
        "status",
    )


def damaged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert lines, some damaged depending on their window end; ``row_order`` by time."""
    alerts = as_alerts(detect(events(spark, sf_dir), BY_TYPE))
    way = F.floor(F.unix_millis("timestamp") / BY_TYPE.slide_ms) % 12
    good = alert_line()
    bad = (
        F.when(way == 0, F.lit("   "))
        .when(way == 1, F.lit("not json"))
        .when(way == 2, F.replace(good, F.lit('"zone"'), F.lit('"area"')))
        .when(way == 3, F.replace(good, F.lit('"timestamp":"2024'), F.lit('"timestamp":"none')))
        .when(way == 4, F.regexp_replace(good, r'"request_count":(\d+)', '"request_count":"$1"'))
        .when(way == 5, F.regexp_replace(good, r'"request_count":(\d+)', '"request_count":$1.75'))
        .when(way == 6, F.regexp_replace(good, r'"request_count":(\d+)', '"request_count":"$1.5"'))
        .when(way == 7, F.concat(good, F.substring(good, 1, 40)))
        .when(way == 8, F.concat(good, F.lit(" {{{ junk")))
        .otherwise(good)
    )
    order = F.struct("timestamp", "zone").alias("row_order")
    return alerts.select(bad.alias("value"), order).filter(F.trim("value") != "")


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = valid_alerts(parse_alerts(damaged_log(spark, sf_dir)))
    return kept.select(
        iso_utc(F.unix_millis("timestamp")).alias("window_end"),
        "zone",
        "request_count",
        "ema_baseline",
        "status",
    )


def log_quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_message(log_quality(parse_alerts(damaged_log(spark, sf_dir))), "alerts")


def log_source_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.source_status(parse_alerts(damaged_log(spark, sf_dir)))


# Reports, over a log in which a second run re-evaluated the later windows.


def report_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = events(spark, sf_dir)
    later = source.filter(F.col("ts") >= F.lit(RERUN_FROM).cast("timestamp"))
    runs = [
        as_alerts(detect(rows, BY_TYPE)).withColumn("emit_batch", F.lit(i))
        for i, rows in enumerate((source, later))
    ]
    order = F.struct("emit_batch", "timestamp", "zone").alias("row_order")
    return runs[0].unionByName(runs[1]).select(
        "timestamp",
        F.concat(F.lit("north_"), F.col("zone")).alias("zone"),
        "request_count",
        "ema_baseline",
        "status",
        order,
    )


def _display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.display_rows(report_log(spark, sf_dir), BY_TYPE)


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.latest_display(report_log(spark, sf_dir), BY_TYPE)


def _text_times(rows: DataFrame) -> DataFrame:
    """Timestamps as ISO text, the row order by its batch number."""
    times = [f.name for f in rows.schema.fields if f.dataType.typeName() == "timestamp"]
    for name in times:
        rows = rows.withColumn(name, iso_utc(F.unix_millis(name)))
    if "row_order" in rows.columns:
        rows = rows.withColumn("emit_batch", F.col("row_order.emit_batch").cast("bigint"))
    return rows.drop("row_order").withColumnsRenamed({"timestamp": "window_end"})


def report_ordered_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_times(report.in_order(report_log(spark, sf_dir)))


def report_last_evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_times(report.last_evaluations(report_log(spark, sf_dir)))


def report_display_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _display(spark, sf_dir)
    return _text_times(
        rows.withColumn("pressure_ratio", F.round("pressure_ratio", 6))
        .withColumn("pressure_delta", F.round("pressure_delta", 6))
        .withColumn("status_rank", F.col("status_rank").cast("bigint"))
    )


def report_latest_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = report.latest_by_zone(_latest(spark, sf_dir))
    return _text_times(
        latest.select(
            "zone", "timestamp", "request_count", "ema_baseline", "status", "row_order"
        )
    )


def report_zone_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.zone_status_table(_latest(spark, sf_dir))


def report_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.recent_table(_display(spark, sf_dir))


def report_surge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.surge_counts(_display(spark, sf_dir))


def report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.summary_metrics(_display(spark, sf_dir))


def report_current_against_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.current_against_baseline(_latest(spark, sf_dir))


def report_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_times(report.trend_rows(_display(spark, sf_dir)))


def report_surge_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_times(report.surge_points(_display(spark, sf_dir)))


def report_zones_by_appearance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.zones_by_appearance(_display(spark, sf_dir)).select(
        "zone_label",
        F.col("first_row.emit_batch").cast("bigint").alias("first_batch"),
        iso_utc(F.unix_millis("first_row.timestamp")).alias("first_window_end"),
    )


# Arrivals. Some events come in late, by an amount fixed by their number.


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("event_id")
    delay_s = (
        F.when(number % 50 == 7, 12 * HOUR)
        .when(number % 20 == 3, 5 * HOUR)
        .when(number % 7 == 2, 20 * 60)
        .otherwise(0)
    )
    return (
        events(spark, sf_dir)
        .withColumn("arrival", F.floor(F.col("event_time_millis") / 1000) + delay_s)
        .select(
            F.col("event_id").cast("string").alias("ride_id"),
            "zone_id",
            iso_utc(F.col("event_time_millis")).alias("timestamp"),
            "event_time_millis",
            (delay_s > 0).alias("is_simulated_late"),
            "arrival",
        )
    )


def arrival_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_arrivals(arrivals(spark, sf_dir), LATE).select(
        "ride_id", "arrival", "watermark_ms", "lag_ms", "arrival_class"
    )


def arrival_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = lateness_summary(audit_arrivals(arrivals(spark, sf_dir), LATE))
    return summary.withColumn("flagged_share", F.round("flagged_share", 6))


def late_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_lines(audit_arrivals(arrivals(spark, sf_dir), LATE))


def busy_hours(source: DataFrame) -> DataFrame:
    """A daily schedule taken from events: hours above the type's mean last two hours."""
    hour = F.floor(F.pmod(F.col("event_time_millis"), F.lit(DAY * 1000)) / (HOUR * 1000))
    hourly = source.groupBy("zone_id", hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("n")
    )
    mean = F.floor(F.sum("n").over(Window.partitionBy("zone_id")) / 24)
    return (
        hourly.withColumn("mean", mean)
        .filter(F.col("n") > F.col("mean"))
        .select(
            F.col("zone_id").alias("zone"),
            (F.col("hour") * HOUR).alias("start_s"),
            ((F.col("hour") + 2) * HOUR).alias("end_s"),
            (F.col("n") - F.col("mean")).alias("extra"),
        )
    )


def schedule_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = annotate_schedule(events(spark, sf_dir), busy_hours(events(spark, sf_dir)), DAY)
    return placed.select("event_id", "zone_id", "cycle_ms", "extra", "expected_load")


# Starts of the versions of a schedule; before the first there is none.
VERSIONS = (
    datetime(2024, 1, 3, tzinfo=UTC),
    datetime(2024, 1, 12, 6, 30, tzinfo=UTC),
    datetime(2024, 1, 12, 17, tzinfo=UTC),
)


def schedule_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions of a schedule, each taken from the events up to the next."""
    source, parts = events(spark, sf_dir), []
    starts = [int(t.timestamp() * 1000) for t in VERSIONS]
    for start, end in zip(starts, [*starts[1:], 2**62]):
        own = source.filter(F.col("event_time_millis").between(start, end - 1))
        parts.append(busy_hours(own).withColumn("valid_from_ms", F.lit(start)))
    versions = parts[0].union(parts[1]).union(parts[2])
    placed = annotate_versions(source, versions, DAY)
    return placed.select("event_id", "zone_id", "cycle_ms", "extra", "expected_load")


# Streams. Each run keeps its log and checkpoint under the shared folder.


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(table).schema
    # A pattern may match one file or a folder; a plain path must be a folder.
    return spark.readStream.schema(schema).parquet(f"{table[:-1]}[{table[-1]}]").select(
        F.col("event_type").alias("zone_id"),
        F.date_trunc("millisecond", F.col("ts").cast("timestamp")).alias("event_time"),
    )


def _stored(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(stored_schema()).parquet(path)
    return rows.select(
        "zone",
        iso_utc(F.unix_millis("timestamp")).alias("window_end"),
        "request_count",
        "ema_baseline",
        "status",
        "emit_seq",
    )


def _run_stream(
    spark: SparkSession, sf_dir: str, mode: str, flush: bool = False
) -> DataFrame:
    configure(spark)
    path, checkpoint = shared_dir(spark, f"{mode}-log"), shared_dir(spark, f"{mode}-checkpoint")
    job = start_job(
        _stream(spark, sf_dir),
        path,
        checkpoint,
        LATE,
        mode,
        "parquet",
        until_caught_up=True,
        flush=flush,
    )
    job.awaitTermination()
    return _stored(spark, path)


def stream_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_stream(spark, sf_dir, "final")


def stream_refire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_stream(spark, sf_dir, "refire")


def stream_final_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole bounded stream, with the windows open at its end."""
    return _run_stream(spark, sf_dir, "final", flush=True)


def stream_refire_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_stream(spark, sf_dir, "refire", flush=True)


# Seconds of arrivals in one part of a replay; shorter ones drop more.
PART_S, SHORT_PART_S = 10 * DAY, 5 * DAY


def _feed(spark: SparkSession, sf_dir: str, part_s: int, checkpoint: str) -> DataFrame:
    """A stream of request lines in arrival order: a folder of files for every part and
    micro-batch, so that late rows come with later batches."""
    configure(spark)
    feed = shared_dir(spark, "feed")
    line = F.to_json(F.struct("ride_id", "zone_id", "timestamp", "is_simulated_late"))
    arrivals(spark, sf_dir).select(
        line.alias("value"),
        F.format_string("%08d", F.floor(F.col("arrival") / part_s)).alias("part"),
    ).write.partitionBy("part").text(feed)
    lines = stream_lines(
        spark, "growing_lines", path=feed, folderPerBatch="true", checkpoint=checkpoint
    )
    return requests_of(lines)


def _finish(job: StreamingQuery) -> None:
    try:
        job.processAllAvailable()
    finally:
        job.stop()


def _replayed(
    spark: SparkSession,
    sf_dir: str,
    mode: str,
    fmt: str = "parquet",
    part_s: int = PART_S,
    **outputs: str,
) -> str:
    """The log of such a stream."""
    path, checkpoint = shared_dir(spark, "replay-log"), shared_dir(spark, "replay-checkpoint")
    requests = _feed(spark, sf_dir, part_s, checkpoint)
    _finish(start_job(requests, path, checkpoint, LATE, mode, fmt, **outputs))
    return path


def stream_arrival_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the requests of a running stream stood, a micro-batch being an arrival."""
    path, checkpoint = shared_dir(spark, "audit"), shared_dir(spark, "audit-checkpoint")
    _finish(start_audit(_feed(spark, sf_dir, PART_S, checkpoint), path, checkpoint, LATE))
    return audited_rows(spark, path).select(
        "ride_id", F.col("emit_batch").alias("arrival"), "watermark_ms", "lag_ms", "arrival_class"
    )


def stream_refire_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows make windows fire again, or are dropped."""
    return _stored(spark, _replayed(spark, sf_dir, "refire"))


def stream_final_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows count in the windows still open."""
    return _stored(spark, _replayed(spark, sf_dir, "final"))


# Where a stream takes over from stored history.
TAKE_OVER = "2024-01-14T05:00:00Z"


def stream_after_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch over the first part and a stream over the rest: as if it had been one stream."""
    configure(spark)
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    timed = table.select(
        F.col("event_type").alias("zone_id"),
        F.date_trunc("millisecond", F.col("ts").cast("timestamp")).alias("event_time"),
    )
    is_past = F.col("event_time") < F.lit(TAKE_OVER).cast("timestamp")
    past, states = from_history(timed.filter(is_past), LATE, "refire")
    path, checkpoint = shared_dir(spark, "later-log"), shared_dir(spark, "later-checkpoint")
    later = _stream(spark, sf_dir).filter(~is_past)
    options = {"until_caught_up": True, "flush": True, "states": states}
    start_job(later, path, checkpoint, LATE, "refire", "parquet", **options).awaitTermination()
    first = as_alerts(past).select(
        "zone",
        iso_utc(F.unix_millis("timestamp")).alias("window_end"),
        "request_count",
        "ema_baseline",
        "status",
        "emit_seq",
    )
    return first.unionByName(_stored(spark, path))


def _late_lines(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    late = shared_dir(spark, "late-requests")
    _replayed(spark, sf_dir, mode, part_s=SHORT_PART_S, late_path=late)
    return read_lines(spark, late).select("value")


def stream_refire_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the requests that a running stream dropped."""
    return _late_lines(spark, sf_dir, "refire")


def stream_final_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_lines(spark, sf_dir, "final")


def stream_log_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of lines read back: each zone's rows are in the order they were emitted in."""
    log = log_lines(spark, _replayed(spark, sf_dir, "refire", "json"))
    place = F.row_number().over(Window.partitionBy("zone").orderBy("row_order")) - 1
    return valid_alerts(parse_alerts(log)).select(
        "zone",
        iso_utc(F.unix_millis("timestamp")).alias("window_end"),
        "request_count",
        "ema_baseline",
        "status",
        place.cast("bigint").alias("emit_seq"),
    )


# Days of a log divided by date.
SOME_DAYS = (datetime(2024, 1, 9, 6, tzinfo=UTC), datetime(2024, 1, 16, tzinfo=UTC))


def log_some_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of some days; other days of the log are not read."""
    path = shared_dir(spark, "dated-log")
    alerts = as_alerts(detect(events(spark, sf_dir), BY_USER, key="user_id"))
    write_batch(alerts, path, 0, by_date=True)
    return alerts_between(spark, path, *SOME_DAYS).select(
        iso_utc(F.unix_millis("timestamp")).alias("window_end"),
        "zone",
        "request_count",
        "ema_baseline",
        "status",
    )


# Reports kept up to date per micro-batch.


def _standing(spark: SparkSession, sf_dir: str) -> Standing:
    path = shared_dir(spark, "standing")
    _replayed(spark, sf_dir, "refire", part_s=SHORT_PART_S, report_path=path)
    return Standing(spark, path, LATE)


def standing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last evaluation of every window, those settled long ago and those still open."""
    return _standing(spark, sf_dir).display_rows().select(
        "zone",
        iso_utc(F.unix_millis("timestamp")).alias("window_end"),
        "request_count",
        "ema_baseline",
        "status",
        F.col("row_order.emit_seq").alias("emit_seq"),
    )


def standing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _standing(spark, sf_dir).summary_metrics()


def standing_zone_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.zone_status_table(_standing(spark, sf_dir).latest_display())


def standing_surge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _standing(spark, sf_dir).surge_counts()


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        detect_by_event_type,
        detect_by_user,
        detect_tumbling,
        detect_uneven_slide,
        detect_orders,
        detect_shipments,
        detect_long_history,
        detect_from_lines,
        window_counts_by_panes,
        window_counts_by_window,
        window_assignment,
        requests_accepted,
        requests_rejected,
        requests_reject_counts,
        requests_failfast,
        requests_as_json,
        alert_lines,
        alert_log_roundtrip,
        log_rows,
        log_quality_counts,
        log_source_status,
        report_ordered_log,
        report_last_evaluations,
        report_display_rows,
        report_latest_by_zone,
        report_zone_status,
        report_recent,
        report_surge_counts,
        report_summary,
        report_current_against_baseline,
        report_trend,
        report_surge_points,
        report_zones_by_appearance,
        arrival_audit,
        arrival_summary,
        late_event_lines,
        schedule_annotation,
        schedule_versions,
        stream_final,
        stream_refire,
        stream_refire_late,
        stream_final_late,
        stream_final_flush,
        stream_refire_flush,
        stream_after_history,
        stream_refire_dropped,
        stream_final_dropped,
        stream_log_order,
        stream_arrival_audit,
        log_some_days,
        standing_rows,
        standing_summary,
        standing_zone_status,
        standing_surge_counts,
    )
}
