import json
import os
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from model import START_MS, Model, batch_rows, replay
from spikewatch.config import SurgeConfig
from spikewatch.functions.timeline import EARLIEST_MS
from spikewatch.plans.jobs import _batch_writer, from_history, requests_of, start_job
from spikewatch.plans.standing import Standing
from spikewatch.sources.alert_log import log_lines, parse_alerts, stored_schema, valid_alerts
from spikewatch.sources.lines import stream_lines
from spikewatch.streaming.keyed import fired, fired_schema, too_late


@pytest.fixture(scope="module", autouse=True)
def narrow(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def line(zone, ms, i):
    at = datetime.fromtimestamp(ms / 1000, tz=timezone.utc).isoformat()
    return json.dumps({"ride_id": f"r{i}", "zone_id": zone, "timestamp": at})


def feed(folder, batches, start=0):
    """One file per micro-batch; the source takes files by age."""
    folder.mkdir(exist_ok=True)
    for i, batch in enumerate(batches, start):
        path = folder / f"{i:05d}.json"
        path.write_text("\n".join(line(z, t, j) for j, (z, t) in enumerate(batch)) + "\n\n")
        os.utime(path, (1_700_000_000 + i * 10,) * 2)


def run(spark, tmp_path, cfg, mode, fmt="parquet", **options):
    lines = stream_lines(spark, "text", path=str(tmp_path / "in"), maxFilesPerTrigger="1")
    log, checkpoint = str(tmp_path / f"{mode}-log"), str(tmp_path / f"{mode}-cp")
    start_job(
        requests_of(lines), log, checkpoint, cfg, mode, fmt, until_caught_up=True, **options
    ).awaitTermination()
    return log


def stored(spark, log):
    rows = spark.read.schema(stored_schema()).parquet(log).orderBy("zone", "emit_seq").collect()
    out = {}
    for r in rows:
        ms = int(r.timestamp.replace(tzinfo=timezone.utc).timestamp() * 1000)
        out.setdefault(r.zone, []).append((ms, r.request_count, r.ema_baseline, r.status))
        assert r.emit_seq == len(out[r.zone]) - 1
    return out


def rounded(rows):
    return {z: [(t, n, round(x, 2), s) for t, n, x, s in rs] for z, rs in rows.items() if rs}


def seconds(*batches, zone="A"):
    return [[(zone, START_MS + s * 1000) for s in batch] for batch in batches]


def test_refire_golden(spark, tmp_path):
    cfg = SurgeConfig()
    feed(tmp_path / "in", seconds([0, 1, 6], [12, 20], [40], [21, 2, 13], [60]))
    got = stored(spark, run(spark, tmp_path, cfg, "refire", flush=True))["A"]
    # Fixed values: (window end, count, baseline) in order; 25 and 30 fire twice.
    assert [((t - START_MS) // 1000, n, x) for t, n, x, _ in got] == [
        (5, 2, 2.0),
        (10, 3, 3.0),
        (15, 4, 4.0),
        (20, 2, 4.0),
        (25, 2, 3.6),
        (30, 1, 3.28),
        (25, 3, 2.82),
        (30, 2, 2.86),
        (35, 2, 2.69),
        (45, 1, 2.55),
        (50, 1, 2.24),
        (65, 1, 1.99),
        (70, 1, 1.79),
    ]
    assert [s for *_, s in got] == ["INITIALIZING"] * 3 + ["NORMAL"] * 10


def test_flushed_replay_with_late_rows(spark, tmp_path):
    """Fifty seconds of default demand; three Downtown events come late, windows re-fire."""
    cfg = SurgeConfig()
    ticks = replay(50, {10: 3, 30: 3, 40: 12})
    batches = [sum(ticks[i : i + 8], []) for i in range(0, len(ticks), 8)]
    model = Model(cfg)
    for batch in batches:
        model.batch(batch)
    model.flush()
    feed(tmp_path / "in", batches)
    assert stored(spark, run(spark, tmp_path, cfg, "refire", flush=True)) == rounded(model.out)


def test_job_goes_on_over_a_flush(spark, tmp_path):
    """What a flush wrote gives way to the micro-batch that takes its place."""
    cfg = SurgeConfig()
    batches = seconds([0, 1, 6], [12, 20], [40])
    model = Model(cfg)
    feed(tmp_path / "in", batches[:2])
    run(spark, tmp_path, cfg, "refire", flush=True)
    feed(tmp_path / "in", batches[2:], 2)
    got = stored(spark, run(spark, tmp_path, cfg, "refire", flush=True))
    for batch in batches:
        model.batch(batch)
    model.flush()
    assert got == rounded(model.out)


def test_flush_needs_an_end(spark, tmp_path):
    with pytest.raises(ValueError):
        start_job(spark.range(1), str(tmp_path), str(tmp_path), flush=True)


@pytest.mark.parametrize(
    "seed, cfg",
    [
        (1, SurgeConfig()),
        (2, SurgeConfig(window_seconds=12, slide_seconds=5, allowed_lateness_seconds=4)),
        (3, SurgeConfig(window_seconds=6, slide_seconds=6, allowed_lateness_seconds=0)),
    ],
)
def test_refire_against_brute_force(spark, tmp_path, seed, cfg):
    rng = random.Random(seed)
    batches, now = [], 0
    for _ in range(8):
        now += rng.choice([3, 8, 20, 45])
        lags = [0, 0, 1, 4, 9, 18, 30, 60, 500]
        batches.append(
            [
                (rng.choice(["a", "b", "c"]), START_MS + (now - rng.choice(lags)) * 1000)
                for _ in range(rng.randrange(1, 12))
            ]
        )
    model = Model(cfg)
    for batch in batches:
        model.batch(batch)
    feed(tmp_path / "in", batches)
    got = stored(spark, run(spark, tmp_path, cfg, "refire"))
    assert got == rounded(model.out)
    assert model.dropped and sum(map(len, got.values())) > 20


def test_ancient_event_shortens_warm_up(spark, tmp_path):
    cfg = SurgeConfig()
    batches = seconds([100_000], [100_001, 5], [100_030])
    model = Model(cfg)
    for batch in batches:
        model.batch(batch)
    assert model.dropped == [("A", START_MS + 5000)]
    feed(tmp_path / "in", batches)
    got = stored(spark, run(spark, tmp_path, cfg, "refire"))
    assert got == rounded(model.out)
    assert [s for *_, s in got["A"]] == ["INITIALIZING", "NORMAL", "NORMAL"]


def test_both_modes_equal_batch_in_order_and_survive_restart(spark, tmp_path):
    cfg = SurgeConfig()
    ticks = replay(60)
    batches = [sum(ticks[i : i + 40], []) for i in range(0, len(ticks), 40)]
    newest = max(t for batch in batches for _, t in batch)
    whole = batch_rows([r for b in batches for r in b], cfg)
    feed(tmp_path / "in", batches[:3])
    for mode in ("refire", "final"):
        run(spark, tmp_path, cfg, mode)
    feed(tmp_path / "in", batches[3:], 3)
    for mode, delay in (("refire", cfg.watermark_ms), ("final", cfg.watermark_ms + cfg.lateness_ms)):
        got = stored(spark, run(spark, tmp_path, cfg, mode))
        closed = {z: [r for r in rows if r[0] <= newest - delay] for z, rows in whole.items()}
        assert got == rounded(closed), mode


def test_final_mode_takes_late_rows_in(spark, tmp_path):
    cfg = SurgeConfig(window_seconds=5)
    batches = seconds([1, 2], [12], [3], [60], [200])
    feed(tmp_path / "in", batches)
    got = stored(spark, run(spark, tmp_path, cfg, "final"))["A"]
    in_time = batch_rows([r for b in batches for r in b], cfg)["A"]
    assert got == rounded({"A": [r for r in in_time if r[0] <= START_MS + 186_000]})["A"]


def test_final_mode_keeps_late_rows_for_open_windows(spark, tmp_path):
    """84 is too late for its first window, whose pane has closed, not for the other two."""
    cfg = SurgeConfig()
    feed(tmp_path / "in", seconds([0], [100], [101], [84], [200], [201], [400], [401]))
    got = stored(spark, run(spark, tmp_path, cfg, "final"))["A"]
    ends = [(t - START_MS) // 1000 for t, *_ in got]
    assert ends[:8] == [5, 10, 90, 95, 105, 110, 115, 205]
    assert [n for _, n, *_ in got][2:4] == [1, 1]


@pytest.mark.parametrize("mode", ["final", "refire"])
@pytest.mark.parametrize("year", [1969, 1970, 2026])
def test_old_times_and_rows_decades_late(spark, tmp_path, year, mode):
    """Windows fire at the logical watermark whatever the century; no row is lost."""
    cfg = SurgeConfig()
    base = int(datetime(year, 7, 20, tzinfo=timezone.utc).timestamp() * 1000)
    decades = 40 * 365 * 24 * 3600
    batches = [
        [("A", base + s * 1000) for s in batch]
        for batch in ([0, 1], [2, 3], [30], [31, -decades], [60], [1000])
    ]
    feed(tmp_path / "in", batches)
    got = stored(spark, run(spark, tmp_path, cfg, mode))
    model = Model(cfg)
    for batch in batches:
        model.batch(batch)
    if mode == "refire":
        assert got == rounded(model.out)
    else:
        assert [(t, n) for t, n, *_ in got["A"]] == [(t, n) for t, n, *_ in model.out["A"]]


def test_times_out_of_reach_are_an_error(spark, tmp_path):
    """Lines are rejected when parsed; rows from elsewhere are an error."""
    rows = spark.createDataFrame([("A", EARLIEST_MS - 1)], "zone_id string, ms long")
    rows.select("zone_id", F.timestamp_millis("ms").alias("event_time")).write.parquet(
        str(tmp_path / "in")
    )
    stream = spark.readStream.schema("zone_id string, event_time timestamp").parquet(
        str(tmp_path / "in")
    )
    with pytest.raises(Exception, match="outside the years"):
        start_job(
            stream, str(tmp_path / "log"), str(tmp_path / "cp"), until_caught_up=True
        ).awaitTermination()


def test_final_mode_can_give_late_rows_up(spark, tmp_path):
    cfg = SurgeConfig(window_seconds=5)
    feed(tmp_path / "in", seconds([1, 2], [12], [14], [3], [60]))
    got = stored(spark, run(spark, tmp_path, cfg, "final", wait_for_late=False))["A"]
    assert [((t - START_MS) // 1000, n) for t, n, *_ in got] == [(5, 2), (15, 2)]


@pytest.mark.parametrize(
    "cfg",
    [
        SurgeConfig(window_seconds=12, slide_seconds=5),
        SurgeConfig(window_seconds=7, slide_seconds=7, watermark_seconds=0),
    ],
)
def test_final_mode_equals_batch_for_other_windows(spark, tmp_path, cfg):
    """Whole seconds, so that events sit on pane and window edges; none is too late."""
    rng = random.Random(5)
    batches = [
        [(rng.choice("ab"), START_MS + (i * 10 + rng.randrange(12)) * 1000) for _ in range(9)]
        for i in range(6)
    ]
    newest = max(t for b in batches for _, t in b)
    whole = batch_rows([r for b in batches for r in b], cfg)
    feed(tmp_path / "in", batches)
    got = stored(spark, run(spark, tmp_path, cfg, "final"))
    limit = newest - cfg.watermark_ms - cfg.lateness_ms
    assert got == rounded({z: [r for r in rows if r[0] <= limit] for z, rows in whole.items()})


def test_json_log_reads_back(spark, tmp_path):
    cfg = SurgeConfig()
    feed(tmp_path / "in", seconds([0, 1, 6], [40], [100]))
    log = run(spark, tmp_path, cfg, "refire", fmt="json")
    kept = valid_alerts(parse_alerts(log_lines(spark, log))).orderBy("row_order")
    assert [r.request_count for r in kept.collect()] == [2, 3, 3, 1, 1, 1]
    assert kept.filter(F.col("zone") == "A").count() == 6


def late_file(tmp_path):
    return sorted(p.read_text() for p in (tmp_path / "late").rglob("*.txt") if p.stat().st_size)


@pytest.mark.parametrize("mode", ["refire", "final"])
def test_late_requests_have_an_output_of_their_own(spark, tmp_path, mode):
    """2 and 13 come after 40, 3 after 200; the log is the same as without the side output."""
    cfg = SurgeConfig()
    batches = seconds([0, 1, 6], [12, 20], [40], [21, 2, 13], [60], [200], [3])
    feed(tmp_path / "in", batches)
    got = stored(spark, run(spark, tmp_path, cfg, mode, late_path=str(tmp_path / "late"), by_date=True))
    lines = "".join(late_file(tmp_path)).splitlines()
    at = [line.split("timestamp=")[1][17:19] for line in lines]
    # In final mode too: the last window of 13 ends at 25, the watermark is at 27.
    assert sorted(at) == ["02", "03", "13"]
    assert all(line.startswith("LATE_EVENT | zone=A | ride_id=r") for line in lines)
    assert all(line.endswith("is_simulated_late=false") for line in lines)
    (tmp_path / "again").mkdir()
    feed(tmp_path / "again" / "in", batches)
    assert stored(spark, run(spark, tmp_path / "again", cfg, mode)) == got


def test_outputs_of_a_replayed_batch(spark, tmp_path):
    """A batch written again, after a failure in between, leaves every output once."""
    cfg = SurgeConfig()
    rows = fired("A", [START_MS + 5000], [3], [3.0], 1, 0).asDict()
    event = '{"ride_id":"r1","zone_id":"A","timestamp":"2026-01-01T00:00:00Z","is_simulated_late":true}'
    late = too_late("A", [event, event.replace("r1", "r2")])
    batch = spark.createDataFrame([Row(**rows, late=None), late], fired_schema(["ride_id"]))
    paths = [str(tmp_path / name) for name in ("log", "late", "report")]
    write = _batch_writer(cfg, paths[0], "parquet", None, False, paths[1], paths[2])
    for number in (0, 1, 1):
        write(batch.limit(0) if number else batch, number)
    write(batch, 1)
    assert spark.read.text(paths[1]).count() == 4
    assert [len(rows) for rows in stored_batches(spark, paths[0])] == [1, 1]
    assert Standing(spark, paths[2], cfg).summary_metrics().first().window_snapshots == 1


def stored_batches(spark, log):
    rows = spark.read.schema(stored_schema()).parquet(log).collect()
    return [[r for r in rows if r.emit_batch == n] for n in (0, 1)]


@pytest.mark.parametrize("mode", ["refire", "final"])
def test_stream_after_history(spark, tmp_path, mode):
    """Batch over the first part, a stream over the rest: the same as one stream over all."""
    cfg = SurgeConfig(window_seconds=12, slide_seconds=4)
    ticks = replay(60)
    rows = sum(ticks, [])
    past, later = rows[: len(rows) // 2], rows[len(rows) // 2 :]
    given = spark.createDataFrame(past, "zone_id string, ms long")
    given = given.withColumn("event_time", F.timestamp_millis("ms"))
    first, states = from_history(given.repartition(3), cfg, mode)
    feed(tmp_path / "in", [later[:50], later[50:]])
    log = run(spark, tmp_path, cfg, mode, states=states, flush=True)
    whole = {}
    for r in first.orderBy("emit_seq").collect():
        whole.setdefault(r.zone, []).append((r.window_end_ms, r.request_count, r.ema_baseline, r.status))
    settled = {zone: len(rows) for zone, rows in whole.items()}
    assert all(settled.values())
    parts = spark.read.schema(stored_schema()).parquet(log)
    for r in parts.orderBy("emit_seq").collect():
        assert r.emit_seq == len(whole[r.zone])
        ms = int(r.timestamp.replace(tzinfo=timezone.utc).timestamp() * 1000)
        whole[r.zone].append((ms, r.request_count, r.ema_baseline, r.status))
    assert rounded(whole) == rounded(batch_rows(rows, cfg))


def test_no_history(spark):
    none = spark.createDataFrame([], "zone_id string, event_time timestamp")
    first, states = from_history(none, SurgeConfig(), "final")
    assert first.collect() == [] and states.collect() == []


def test_far_dates_do_not_stop_a_stream(spark, tmp_path):
    cfg = SurgeConfig()
    batches = seconds([0, 1], [12], [60])
    feed(tmp_path / "in", batches)
    with open(tmp_path / "in" / "00000.json", "a") as file:
        file.write('{"ride_id":"x","zone_id":"A","timestamp":"9999-12-31T00:00:00Z"}\n')
    os.utime(tmp_path / "in" / "00000.json", (1_700_000_000,) * 2)
    model = Model(cfg)
    for batch in batches:
        model.batch(batch)
    assert stored(spark, run(spark, tmp_path, cfg, "refire")) == rounded(model.out)


def test_unknown_mode(spark, tmp_path):
    with pytest.raises(ValueError):
        start_job(spark.range(1), str(tmp_path), str(tmp_path), mode="eager")
