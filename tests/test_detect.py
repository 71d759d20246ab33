import random

import pytest
from pyspark.sql import functions as F

import default_demand
from model import START_MS, Model, batch_rows, ends_of, replay
from spikewatch.config import SurgeConfig
from spikewatch.functions.timeline import latest_end, next_end
from spikewatch.operators import history, panefold
from spikewatch.operators.baseline import ema_baseline
from spikewatch.operators.windows import (
    window_counts,
    window_counts_builtin,
)
from spikewatch.plans.detect import as_alerts, detect

SCHEMA = "zone_id string, event_time_millis long"
I, N, S = "INITIALIZING", "NORMAL", "SURGE_ALERT"

# Downtown under default demand, (end second, count, baseline, status).
DOWNTOWN = [
    (5, 20, 20.0, I),
    (10, 40, 40.0, I),
    (15, 60, 60.0, I),
    (20, 124, 60.0, S),
    (25, 188, 72.8, S),
    (30, 188, 95.84, N),
    (35, 236, 114.27, S),
    (40, 172, 138.62, N),
    (45, 172, 145.29, N),
]


def by_zone(evaluations) -> dict:
    out = {}
    for r in evaluations.collect():
        row = (r.window_end_ms, r.request_count, r.ema_baseline, r.status)
        out.setdefault(r.zone, []).append(row)
    return {zone: sorted(rows) for zone, rows in out.items()}


def random_rows(rng, n, span_ms, step):
    zones = ["a", "b_c", "é"]
    return [(rng.choice(zones), START_MS + rng.randrange(0, span_ms, step)) for _ in range(n)]


def test_default_demand(spark):
    rows = [row for batch in replay(110) for row in batch]
    got = by_zone(detect(spark.createDataFrame(rows, SCHEMA)))
    assert got == batch_rows(rows, SurgeConfig())
    shown = [
        ((t - START_MS) // 1000, n, round(x, 2), s) for t, n, x, s in got["Downtown"][: len(DOWNTOWN)]
    ]
    assert shown == DOWNTOWN


def test_default_demand_in_all_zones(spark):
    rows = [row for batch in replay(110) for row in batch]
    alerts = as_alerts(detect(spark.createDataFrame(rows, SCHEMA)))
    got = {}
    for r in alerts.select("*", F.unix_millis("timestamp").alias("ms")).orderBy("ms").collect():
        end = (r.ms - START_MS) // 1000
        if end <= 100:
            got.setdefault(r.zone, []).append((end, r.request_count, r.ema_baseline, r.status[0]))
    assert got == {
        zone: [(5 * n, *row) for n, row in enumerate(expected, 1)]
        for zone, expected in default_demand.ROWS.items()
    }


def test_alert_counts_over_100_seconds(spark):
    rows = [row for batch in replay(110) for row in batch]
    alerts = as_alerts(detect(spark.createDataFrame(rows, SCHEMA))).filter(
        F.unix_millis("timestamp") <= START_MS + 100_000
    )
    counts = {r.status: r["count"] for r in alerts.groupBy("status").count().collect()}
    assert counts == {I: 12, N: 61, S: 7}
    assert alerts.agg(F.max("request_count")).first()[0] == 236


@pytest.mark.parametrize(
    "counts, expected",
    [
        # Tumbling counts and the baselines and statuses they lead to.
        ([15, 90, 15, 5], [(15.0, I), (15.0, S), (30.0, N), (27.0, N)]),
        ([15, 15, 15, 5], [(15.0, I), (15.0, N), (15.0, N), (15.0, N)]),
    ],
)
def test_baseline_chain(spark, counts, expected):
    cfg = SurgeConfig(slide_seconds=15)
    rows = [("z", 15000 * (i + 1), c, 0) for i, c in enumerate(counts)]
    windows = spark.createDataFrame(
        rows, "zone string, window_end_ms long, request_count long, first_ms long"
    )
    out = ema_baseline(windows, cfg).orderBy("window_end_ms").collect()
    assert [(r.ema_baseline, r.status) for r in out] == expected


def test_tie_is_not_a_surge(spark):
    cfg = SurgeConfig(window_seconds=5)
    rows = [("z", 0)] * 10 + [("z", 5000)] * 10 + [("z", 10000)] * 20 + [("z", 15000)] * 25
    got = by_zone(detect(spark.createDataFrame(rows, SCHEMA), cfg))["z"]
    assert [r[3] for r in got] == [I, N, N, S]
    assert [r[2] for r in got] == [10.0, 10.0, 10.0, 12.0]


CONFIGS = [
    SurgeConfig(),
    SurgeConfig(window_seconds=12, slide_seconds=5),
    SurgeConfig(window_seconds=5, slide_seconds=5, alpha=1.0),
    SurgeConfig(window_seconds=7, slide_seconds=3, alpha=0.37, surge_threshold=1.1),
    SurgeConfig(window_seconds=60, slide_seconds=1, alpha=0.05),
]


@pytest.mark.parametrize("cfg", CONFIGS)
def test_against_brute_force(spark, cfg):
    rng = random.Random(7)
    # Whole seconds put many events exactly on window starts.
    rows = random_rows(rng, 60, 200_000, 1000) + random_rows(rng, 60, 400_000, 250)
    df = spark.createDataFrame(rows, SCHEMA)
    expected = batch_rows(rows, cfg)
    assert by_zone(detect(df, cfg)) == expected
    assert by_zone(history.detect_long(df, cfg, block_windows=1)) == expected

    assert by_zone(ema_baseline(window_counts(df, cfg), cfg)) == expected

    timed = df.withColumn("event_time", F.timestamp_millis("event_time_millis"))
    columns = ["zone", "window_end_ms", "request_count", "first_ms"]
    panes = window_counts(df, cfg).select(columns)
    for other in (window_counts_builtin,):
        assert sorted(panes.collect()) == sorted(other(timed, cfg).select(columns).collect())


@pytest.mark.parametrize("cfg", CONFIGS)
@pytest.mark.parametrize("batch", [1, 3, 7])
def test_passes_in_small_pieces(spark, cfg, batch):
    """Keys and windows cut anywhere by the size of the batches sent to Python."""
    rng = random.Random(batch)
    rows = random_rows(rng, 80, 150_000, 1000) + random_rows(rng, 20, 1_000_000, 500)
    df = spark.createDataFrame(rows, SCHEMA)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, batch)
    try:
        expected = batch_rows(rows, cfg)
        assert by_zone(detect(df, cfg)) == expected
        assert by_zone(ema_baseline(window_counts(df, cfg), cfg)) == expected
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("rows_out", [1, 5])
def test_bounded_output_pieces(monkeypatch, spark, rows_out):
    monkeypatch.setattr(panefold, "OUTPUT_ROWS", rows_out)
    rng = random.Random(rows_out)
    rows = random_rows(rng, 120, 300_000, 1000)
    for cfg in CONFIGS:
        assert by_zone(detect(spark.createDataFrame(rows, SCHEMA), cfg)) == batch_rows(rows, cfg)


def test_literal_key(spark):
    rows = [row for batch in replay(60) for row in batch if row[0] == "Airport"]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("all", F.lit("Airport"))
    expected = batch_rows(rows, SurgeConfig())
    assert by_zone(detect(df, key="all")) == expected
    assert by_zone(history.detect_long(df, SurgeConfig(), key="all", block_windows=1)) == expected


def test_assignment_before_1970(spark):
    times = [-1, 0, -5000, -12345, 4999, 5000, 7]
    for cfg in CONFIGS:
        df = spark.createDataFrame([("z", t) for t in times], SCHEMA)
        t = F.col("event_time_millis")
        got = df.select(t, next_end(t, cfg), latest_end(t, cfg)).collect()
        assert [(r[1], r[2]) for r in got] == [
            (ends_of(x, cfg)[0], ends_of(x, cfg)[-1]) for x in times
        ]


def test_event_on_window_start_alone_makes_no_window(spark):
    df = spark.createDataFrame([("z", START_MS)], SCHEMA)
    ends = sorted(r.window_end_ms - START_MS for r in detect(df).collect())
    assert ends == [5000, 10000]


def test_keys_and_times_may_be_null(spark):
    rows = [("z", START_MS), (None, START_MS), ("z", None)]
    assert {r.zone for r in detect(spark.createDataFrame(rows, SCHEMA)).collect()} == {"z"}


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert detect(empty).count() == 0
    assert history.detect_long(empty, SurgeConfig()).count() == 0


@pytest.mark.parametrize("alpha", [0.2, 0.1, 0.5, 1.0, 0.01])
def test_long_history_keeps_every_bit(spark, alpha):
    """A steady stream after a spike settles on neighbouring doubles that never merge."""
    cfg = SurgeConfig(alpha=alpha)
    span = history.block_span_ms(cfg, 1)
    seconds = F.col("id")
    spike = F.when(seconds < 900, seconds % 7).otherwise(1)
    stream = spark.range(0, 4 * span // 1000).select(
        F.lit("z").alias("zone_id"),
        (seconds * 1000).alias("event_time_millis"),
        F.explode(F.sequence(F.lit(0), spike)),
    )
    plain = detect(stream, cfg).cache()
    long = history.detect_long(stream, cfg, block_windows=1).cache()
    assert plain.count() == long.count() > 0
    assert plain.exceptAll(long).isEmpty() and long.exceptAll(plain).isEmpty()


def test_unsettled_block_lists_all_counts(monkeypatch, spark):
    """Without any tabulated doubles the walk still gets everything right."""
    rng = random.Random(3)
    rows = random_rows(rng, 4000, 30_000_000, 1000)
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(history, "MAX_ENCLOSED", 0)
    assert by_zone(history.detect_long(df, SurgeConfig(), block_windows=1)) == batch_rows(
        rows, SurgeConfig()
    )


def test_model_reproduces_late_goldens():
    """Fixed values for the re-fire rules, which the stream tests then rely on."""
    model = Model(SurgeConfig())
    # Downtown's first event is moved back by these seconds.
    for batch in replay(50, {10: 3, 30: 3, 40: 12}):
        model.batch(batch)
    model.flush()
    shown = [
        ((t - START_MS) // 1000, n, round(x, 2), s[0]) for t, n, x, s in model.out["Downtown"]
    ]
    assert shown == [
        (5, 20, 20.0, "I"),
        (10, 41, 41.0, "I"),
        (15, 60, 60.0, "I"),
        (20, 124, 60.0, "S"),
        (25, 187, 72.8, "S"),
        (30, 189, 95.64, "N"),
        (35, 236, 114.31, "S"),
        (30, 190, 138.65, "N"),
        (35, 237, 148.92, "N"),
        (40, 173, 166.54, "N"),
        (45, 170, 167.83, "N"),
        (50, 59, 168.26, "N"),
        (55, 39, 146.41, "N"),
        (60, 20, 124.93, "N"),
    ]
    assert model.dropped == [] and sum(map(len, model.out.values())) == 50


@pytest.mark.parametrize("alpha", [1.0, 0.5, 0.2, 1e-4, 1e-12, 1e-17, 5e-324])
def test_any_alpha_settles(alpha):
    steps = history.settling_steps(alpha)
    assert 1 <= steps <= history.MOST_STEPS
    if alpha >= 1e-4:
        assert (1 - alpha) ** steps * history.TOP < 2**-54
