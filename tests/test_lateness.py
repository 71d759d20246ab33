import random

import pytest
from pyspark.sql import functions as F

from model import START_MS, ends_of
from spikewatch.config import SurgeConfig
from spikewatch.operators import lateness
from spikewatch.operators.lateness import audit_arrivals, late_lines, lateness_summary
from spikewatch.operators.schedule import (
    annotate_schedule,
    annotate_versions,
    schedule_steps,
    version_spans,
)
from spikewatch.streaming.arrivals import audit_batch, audited_rows

SCHEMA = (
    "ride_id string, zone_id string, timestamp string, event_time_millis long, "
    "is_simulated_late boolean, arrival long"
)


def brute_force(rows, cfg):
    out = {}
    for r in rows:
        earlier = [x[3] for x in rows if x[5] < r[5]]
        e, ends = r[3], ends_of(r[3], cfg)
        if not earlier:
            out[r[0]] = ("on_time", 0)
            continue
        newest = max(earlier)
        mark = newest - cfg.watermark_ms
        if mark > ends[-1] + cfg.lateness_ms:
            kind = "dropped"
        elif ends[0] <= mark:
            kind = "late_refire"
        else:
            kind = "out_of_order" if e < newest else "on_time"
        out[r[0]] = (kind, max(0, newest - e))
    return out


@pytest.mark.parametrize("chunk", [3, 4096])
@pytest.mark.parametrize("cfg", [SurgeConfig(), SurgeConfig(window_seconds=7, slide_seconds=3)])
def test_audit_against_brute_force(monkeypatch, spark, cfg, chunk):
    monkeypatch.setattr(lateness, "WIDTHS", (chunk, chunk**2, chunk**3))
    rng = random.Random(11)
    rows = []
    for i in range(300):
        arrival = rng.randrange(-20, 150)
        e = START_MS + arrival * 1000 - rng.choice([0, 0, 500, 4000, 17000, 60000])
        rows.append((f"r{i}", rng.choice("ab"), "t", e, False, arrival))
    got = audit_arrivals(spark.createDataFrame(rows, SCHEMA), cfg)
    assert {r.ride_id: (r.arrival_class, r.lag_ms) for r in got.collect()} == brute_force(rows, cfg)


@pytest.mark.parametrize(
    "newest, kind",
    [
        # The event's windows end at 5, 10 and 15 s; the watermark trails by 3.001 s.
        (28002, "dropped"),
        (28001, "late_refire"),
        (8001, "late_refire"),
        (8000, "out_of_order"),
        (1001, "out_of_order"),
        (1000, "on_time"),
    ],
)
def test_watermark_edges(spark, newest, kind):
    rows = [
        ("lead", "z", "t", START_MS + newest, False, 0),
        ("r", "z", "t", START_MS + 1000, False, 1),
    ]
    audited = audit_arrivals(spark.createDataFrame(rows, SCHEMA), SurgeConfig())
    assert {r.ride_id: r.arrival_class for r in audited.collect()} == {"lead": "on_time", "r": kind}


def test_summary_and_late_lines(spark):
    rows = [
        ("a", "z", "t0", START_MS + 100_000, False, 0),
        ("b", "z", "t1", START_MS, True, 1),
        ("c", "z", "t2", START_MS + 99_000, False, 1),
    ]
    audited = audit_arrivals(spark.createDataFrame(rows, SCHEMA), SurgeConfig())
    assert {tuple(r) for r in lateness_summary(audited).collect()} == {
        ("z", "on_time", 1, 0, 0.0),
        ("z", "dropped", 1, 100_000, 1.0),
        ("z", "out_of_order", 1, 1000, 0.0),
    }
    assert [r.value for r in late_lines(audited).collect()] == [
        "LATE_EVENT | zone=z | ride_id=b | timestamp=t1 | is_simulated_late=true"
    ]


ENTRIES = [
    ("Downtown", 18, 22, 8),
    ("Downtown", 31, 35, 7),
    ("Downtown", 20, 33, 2),
    ("Airport", 24, 28, 6),
    ("Airport", 28, 28, 9),
    ("Airport", 40, 50, 3),
    ("Suburb_North", 28, 31, 5),
    ("Suburb_North", 31, 36, 5),
]


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_schedule_against_brute_force(spark, parts):
    schedule = spark.createDataFrame(ENTRIES, "zone string, start_s long, end_s long, extra long")
    events = spark.range(0, 100_000, 250).select(
        (F.col("id") + START_MS - 30_000).alias("event_time_millis"),
        F.explode(F.array(*map(F.lit, ("Downtown", "Airport", "Suburb_North", "Nowhere")))).alias(
            "zone_id"
        ),
    )
    got = annotate_schedule(events, schedule, 45, START_MS, parts=parts).collect()
    assert len(got) == events.count()
    for r in got:
        position = (r.event_time_millis - START_MS) / 1000 % 45
        extra = sum(x for z, lo, hi, x in ENTRIES if z == r.zone_id and lo <= position < hi)
        assert (r.extra, r.expected_load) == (extra, 1 + extra)


def test_steps_do_not_overlap(spark):
    schedule = spark.createDataFrame(ENTRIES, "zone string, start_s long, end_s long, extra long")
    steps = sorted(tuple(r) for r in schedule_steps(schedule).collect())
    assert [s for s in steps if s[0] == "Downtown"] == [
        ("Downtown", 18, 20, 8),
        ("Downtown", 20, 22, 10),
        ("Downtown", 22, 31, 2),
        ("Downtown", 31, 33, 9),
        ("Downtown", 33, 35, 7),
    ]


VERSIONED = [
    ("A", START_MS, 0, 10, 5),
    ("A", START_MS, 5, 20, 2),
    ("A", START_MS + 61_000, 30, 45, 7),
    # Takes the schedule away.
    ("A", START_MS + 130_500, 0, 0, 0),
    ("A", START_MS + 200_000, 0, 45, 1),
    ("B", START_MS - 10**12, 0, 45, 3),
    ("B", START_MS + 10**12, 0, 45, 9),
    (None, START_MS, 0, 45, 4),
    ("A", None, 0, 45, 4),
]


@pytest.mark.parametrize("parts, era_s", [(1, 86_400), (7, 13), (64, 1000)])
def test_versions_against_brute_force(spark, parts, era_s):
    names = "zone string, valid_from_ms long, start_s long, end_s long, extra long"
    versions = spark.createDataFrame(VERSIONED, names)
    zones = F.explode(F.array(*map(F.lit, ("A", "B", "C"))))
    events = spark.range(0, 300_000, 777).select(
        (F.col("id") + START_MS - 30_000).alias("event_time_millis"), zones.alias("zone_id")
    )
    got = annotate_versions(events, versions, 45, START_MS, parts=parts, era_s=era_s).collect()
    assert len(got) == events.count()
    for r in got:
        starts = [v for z, v, *_ in VERSIONED if z == r.zone_id and v is not None]
        force = max((v for v in starts if v <= r.event_time_millis), default=None)
        position = (r.event_time_millis - START_MS) / 1000 % 45
        extra = sum(
            x for z, v, lo, hi, x in VERSIONED
            if force is not None and (z, v) == (r.zone_id, force) and lo <= position < hi
        )
        assert (r.extra, r.expected_load) == (extra, 1 + extra)


def test_versions_without_events_or_versions(spark):
    names = "zone string, valid_from_ms long, start_s long, end_s long, extra long"
    versions = spark.createDataFrame(VERSIONED, names)
    events = spark.createDataFrame([("A", 5)], "zone_id string, event_time_millis long")
    assert annotate_versions(events.limit(0), versions, 45).collect() == []
    assert [r.extra for r in annotate_versions(events, versions.limit(0), 45).collect()] == [0]
    spans = version_spans(versions).filter("zone = 'B'").orderBy("valid_from_ms").collect()
    assert [(r.valid_from_ms, r.valid_to_ms) for r in spans] == [
        (START_MS - 10**12, START_MS + 10**12),
        (START_MS + 10**12, None),
    ]


def test_old_versions_do_not_meet_in_one_task(spark):
    """The join is on zone, era and part of the cycle, and nothing is broadcast by force."""
    names = "zone string, valid_from_ms long, start_s long, end_s long, extra long"
    versions = spark.createDataFrame(VERSIONED, names)
    events = spark.range(5).selectExpr("'A' AS zone_id", f"id + {START_MS} AS event_time_millis")
    plan = annotate_versions(events, versions, 45, START_MS)._jdf.queryExecution().toString()
    assert "_era" in plan and "ResolvedHint" not in plan


def test_stream_audit_equals_the_stored_one(spark, tmp_path):
    """Micro-batches as arrivals, one of them empty and one written twice."""
    cfg, path, rng = SurgeConfig(), str(tmp_path / "audit"), random.Random(3)
    names = "ride_id string, event_time_millis long, emit_batch long"
    rows, now = [], 0
    for batch in range(6):
        now += rng.choice([5, 20, 60])
        lags = [0, 0, 2, 8, 20, 45, 90]
        own = [
            (f"r{batch}-{n}", START_MS + (now - rng.choice(lags)) * 1000, batch)
            for n in range(0 if batch == 3 else 12)
        ]
        rows += own
        given = spark.createDataFrame(own, names).drop("emit_batch")
        for _ in range(2 if batch == 2 else 1):
            audit_batch(given, path, batch, cfg)
    stored = audit_arrivals(spark.createDataFrame(rows, names), cfg, "emit_batch")
    streamed = audited_rows(spark, path).select(*stored.columns)
    assert sorted(streamed.collect()) == sorted(stored.collect())
    assert {r.arrival_class for r in stored.collect()} == {"on_time", "out_of_order", "late_refire", "dropped"}
