import math

import pytest
from pyspark.sql import functions as F

from spikewatch.operators import report

I, N, S = "INITIALIZING", "NORMAL", "SURGE_ALERT"
# (window end second, zone, count, baseline, status), in log order; A at 10 s comes twice.
LOG = [
    (5, "A_x", 4, 4.0, I),
    (5, "B", 9, 2.0, S),
    (10, "A_x", 9, 4.0, S),
    (10, "B", 3, 2.24, N),
    (10, "A_x", 10, 5.25, N),
    (15, "A_x", 12, 0.0, "ODD"),
    (15, "C", 12, 5.0, S),
]


@pytest.fixture(scope="module")
def log(spark):
    rows = [(i, *r) for i, r in enumerate(LOG)]
    df = spark.createDataFrame(
        rows, "row_order long, s long, zone string, request_count long, ema_baseline double, "
        "status string"
    )
    return df.withColumn("timestamp", F.timestamp_seconds("s")).drop("s")


@pytest.fixture(scope="module")
def display(log):
    return report.display_rows(log)


def test_in_order(log):
    assert [r.row_order for r in report.in_order(log).collect()] == list(range(7))


def test_last_evaluation_wins(log):
    kept = {r.row_order for r in report.last_evaluations(log).collect()}
    assert kept == {0, 1, 3, 4, 5, 6}


def test_display_rows(display):
    rows = {r.row_order: r for r in display.collect()}
    r = rows[4]
    assert r.zone_label == "A x" and r.status_rank == 2
    assert (r.timestamp - r.window_start).total_seconds() == 15
    assert r.pressure_ratio == 10 / 5.25 and r.pressure_delta == 10 - 5.25
    assert rows[5].pressure_ratio is None and rows[5].status_rank == 3
    assert [rows[i].status_rank for i in (0, 1)] == [1, 0]


def test_latest_by_zone_order(display):
    rows = report.latest_by_zone(display).collect()
    assert [(r.zone, r.request_count) for r in rows] == [("C", 12), ("B", 3), ("A_x", 12)]


def test_zone_status_table(display):
    rows = report.zone_status_table(display)
    assert rows.columns == ["Zone", "Requests", "Baseline", "Pressure", "Status"]
    assert [tuple(r) for r in rows.collect()] == [
        ("C", 12, 5.0, 2.4, S),
        ("B", 3, 2.2, 1.34, N),
        ("A x", 12, 0.0, None, "ODD"),
    ]


def test_recent_table(display):
    rows = [tuple(r) for r in report.recent_table(display, 4).collect()]
    assert [(r[1][-2:], r[2]) for r in rows] == [
        ("15", "C"),
        ("15", "A x"),
        ("10", "A x"),
        ("10", "B"),
    ]
    assert rows[2] == (
        "1969-12-31 23:59:55", "1970-01-01 00:00:10", "A x", 10, 5.2, 1.9, N
    )


def test_counts_and_summary(display):
    assert {tuple(r) for r in report.surge_counts(display).collect()} == {("B", 1), ("C", 1)}
    assert tuple(report.summary_metrics(display).first()) == (6, 1, 2, 12)
    empty = display.filter(F.lit(False))
    assert tuple(report.summary_metrics(empty).first()) == (0, 0, 0, 0)
    assert report.recent_table(empty).count() == report.latest_by_zone(empty).count() == 0


def test_source_status(log):
    parsed = log.withColumn("error", F.when(F.col("row_order") == 0, "Malformed JSON"))
    assert tuple(report.source_status(parsed).first()) == (
        "LIVE", 6, 5, "1970-01-01 00:00:15 UTC", 1
    )
    assert tuple(report.source_status(parsed.filter(F.lit(False))).first()) == (
        "WAITING", 0, 0, "n/a", 0
    )


def test_long_form(display):
    rows = {tuple(r) for r in report.current_against_baseline(display).collect()}
    assert rows == {
        ("C", "Current Requests", 12.0),
        ("C", "EMA Baseline", 5.0),
        ("B", "Current Requests", 3.0),
        ("B", "EMA Baseline", 2.24),
        ("A x", "Current Requests", 12.0),
        ("A x", "EMA Baseline", 0.0),
    }


def test_trend_and_zones(display):
    assert report.trend_rows(display).count() == 6
    assert {r.zone_label for r in report.surge_points(display).collect()} == {"B", "C"}
    zones = [r.zone_label for r in report.zones_by_appearance(display).collect()]
    assert zones == ["A x", "B", "C"]
    assert all(math.isfinite(r.ema_baseline) for r in report.trend_rows(display).collect())
