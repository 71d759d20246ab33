import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from spikewatch.schemas import ALERT
from spikewatch.sources.alert_log import (
    alert_line,
    alerts_between,
    log_lines,
    log_quality,
    log_status,
    parse_alerts,
    status_message,
    valid_alerts,
    write_batch,
)

GOOD = (
    '{"ema_baseline":72.8,"request_count":188,"status":"SURGE_ALERT",'
    '"timestamp":"2026-03-23T18:00:25Z","zone":"Downtown"}'
)


def rows_of(spark, *rows):
    df = spark.createDataFrame(rows, "at string, zone string, n long, base double, status string")
    return df.select(
        F.to_timestamp("at").alias("timestamp"),
        "zone",
        F.col("n").alias("request_count"),
        F.col("base").alias("ema_baseline"),
        "status",
    )


def test_line_format(spark):
    rows = rows_of(
        spark,
        ("2026-03-23T18:00:25Z", "Downtown", 188, 72.8, "SURGE_ALERT"),
        ("2026-03-23T18:00:30Z", 'a "b"', 20000000, 12000000.0, "NORMAL"),
    )
    lines = [r[0] for r in rows.select(alert_line()).collect()]
    assert lines[0] == GOOD
    assert '"ema_baseline":12000000.0,' in lines[1] and json.loads(lines[1])["zone"] == 'a "b"'


def test_tolerant_parse(spark):
    base = json.loads(GOOD)
    lines = [
        GOOD,
        "junk",
        json.dumps({k: v for k, v in base.items() if k not in ("zone", "status")}),
        json.dumps(base | {"request_count": "188"}),
        json.dumps(base | {"request_count": 188.9}),
        json.dumps(base | {"request_count": "188.9"}),
        json.dumps(base | {"ema_baseline": "72.8"}),
        json.dumps(base | {"ema_baseline": "high"}),
        json.dumps(base | {"timestamp": "yesterday"}),
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "row_order int, value string")
    parsed = parse_alerts(df)
    errors = [r.error for r in parsed.orderBy("row_order").collect()]
    assert errors == [
        None,
        "Malformed JSON",
        "Missing required fields: status, zone",
        None,
        None,
        "Unreadable number: request_count",
        None,
        "Unreadable number: ema_baseline",
        None,
    ]
    kept = valid_alerts(parsed).collect()
    assert [(r.request_count, r.ema_baseline) for r in kept] == [(188, 72.8)] * 4
    quality = status_message(log_quality(parsed), "log.json").first()
    assert quality[:3] == (5, 4, "Unreadable number: ema_baseline")
    assert quality.message == (
        "Live stream connected. Skipped 4 malformed line(s). "
        "Last parse issue: Unreadable number: ema_baseline"
    )


def test_messages_without_rows(spark):
    empty = parse_alerts(spark.createDataFrame([], "row_order int, value string"))
    assert status_message(log_quality(empty), "x.json").first().message == (
        "x.json has no valid rows yet."
    )


def test_missing_log_is_empty(spark, tmp_path):
    lines = log_lines(spark, str(tmp_path / "nothing"))
    assert valid_alerts(parse_alerts(lines)).count() == 0
    status = log_status(spark, str(tmp_path / "nothing")).first()
    assert status.message == "Waiting for data file: nothing" and status.valid_lines == 0
    (tmp_path / "log").write_text(GOOD + "\n")
    assert log_status(spark, str(tmp_path / "log")).first().message == "Live stream connected."


def test_batches_truncate_then_replace_their_own_folder(spark, tmp_path):
    path = str(tmp_path / "log")
    first = rows_of(spark, ("2026-03-23T18:00:05Z", "A", 1, 1.0, "NORMAL"))
    second = rows_of(spark, ("2026-03-23T18:00:05Z", "A", 2, 1.5, "NORMAL"))

    def stored():
        kept = valid_alerts(parse_alerts(log_lines(spark, path))).collect()
        return sorted((r.row_order.batch, r.request_count) for r in kept)

    write_batch(second, path, 7)
    write_batch(first, path, 0)
    assert stored() == [(0, 1)]
    write_batch(second, path, 1)
    write_batch(second, path, 1)
    assert stored() == [(0, 1), (1, 2)]
    empty = spark.createDataFrame([], ALERT)
    write_batch(empty, path, 2)
    assert stored() == [(0, 1), (1, 2)]


@pytest.mark.parametrize("files", [None, 2])
def test_rows_keep_their_order_per_zone(spark, tmp_path, files):
    path = str(tmp_path / "log")
    rows = spark.range(200).select(
        F.timestamp_millis(F.lit(1774288800000) + (F.col("id") % 7) * 5000).alias("timestamp"),
        (F.col("id") % 3).cast("string").alias("zone"),
        F.col("id").alias("request_count"),
        F.lit(1.0).alias("ema_baseline"),
        F.lit("NORMAL").alias("status"),
        F.col("id").alias("emit_seq"),
    )
    write_batch(rows.repartition(3, "zone"), path, 0, files=files)
    if files:
        assert len(list((tmp_path / "log" / "emit_batch=0").glob("*.txt"))) <= files
    kept = valid_alerts(parse_alerts(log_lines(spark, path))).orderBy("row_order").collect()
    for zone in "012":
        counts = [r.request_count for r in kept if r.zone == zone]
        assert counts == sorted(counts)


def test_log_by_date(spark, tmp_path):
    """Other days are not read, and a batch written again leaves no row twice."""
    path = str(tmp_path / "log")
    days = [f"2026-03-{day}T{hour}:00:05Z" for day in (22, 23, 24, 25) for hour in ("00", "12")]
    alerts = rows_of(spark, *((t, "A", n, 1.0, "NORMAL") for n, t in enumerate(days)))
    for number in (0, 1, 1):
        write_batch(alerts, path, number, by_date=True)
    assert (tmp_path / "log" / "emit_batch=1" / "date=2026-03-24").is_dir()
    start, end = datetime(2026, 3, 23, 6, tzinfo=UTC), datetime(2026, 3, 25, tzinfo=UTC)
    some = alerts_between(spark, path, start, end)
    assert sorted(r.request_count for r in some.collect()) == [3, 3, 4, 4, 5, 5]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "(date" in plan
    write_batch(alerts.limit(0), path, 1, by_date=True)
    assert alerts_between(spark, path, start, end).count() == 3
    assert valid_alerts(parse_alerts(log_lines(spark, path))).count() == 8
