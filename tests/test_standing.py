"""Standing reports against reports over the whole log, after every batch."""

import random

import pytest
from pyspark.sql import functions as F

from model import START_MS
from spikewatch.config import SurgeConfig
from spikewatch.operators import report
from spikewatch.plans import standing
from spikewatch.plans.standing import EVALUATION, Standing, merge_batch, rebuild

CFG = SurgeConfig(window_seconds=10, slide_seconds=5, allowed_lateness_seconds=5)
STATUSES = ["INITIALIZING", "NORMAL", "SURGE_ALERT"]


def batches(seed=1, n=5):
    """Windows in order, and windows not yet settled once more, with other counts."""
    rng, out, seqs, ends = random.Random(seed), [], {}, []
    for batch in range(n):
        newest = max(ends, default=0)
        again = rng.sample(sorted(e for e in set(ends) if e >= newest - 15), k=min(2, len(set(ends))) if ends else 0)
        new = [newest + 5 * k for k in range(1, rng.randrange(2, 9))] if batch != 2 else []
        rows = []
        for end in new + again:
            for zone in ("a_b", "c", "d")[: 1 + (end // 5) % 3]:
                seqs[zone] = seqs.get(zone, -1) + 1
                count = rng.randrange(50)
                rows.append((START_MS + end * 1000, zone, count, float(rng.randrange(40)), rng.choice(STATUSES), batch, seqs[zone]))
        ends += new
        out.append(rows)
    return out


def table(spark, rows):
    names = EVALUATION.fieldNames()
    raw = spark.createDataFrame(rows, "ms long, zone string, n long, base double, status string, b long, s long")
    return raw.select(F.timestamp_millis("ms"), "zone", "n", "base", "status", "b", "s").toDF(*names)


def same(one, two):
    columns = sorted(two.columns)
    return sorted(map(repr, one.select(*columns).collect())) == sorted(map(repr, two.select(*columns).collect()))


def agree(spark, path, rows):
    got = Standing(spark, path, CFG)
    order = F.struct("emit_batch", "emit_seq", "zone").alias("row_order")
    display = report.display_rows(table(spark, rows).select("*", order), CFG)
    assert same(got.display_rows().drop("date"), display)
    assert same(got.summary_metrics(), report.summary_metrics(display))
    assert same(report.zone_status_table(got.latest_display()), report.zone_status_table(display))
    assert same(got.surge_counts(), report.surge_counts(display))
    first = [r.zone_label for r in report.zones_by_appearance(display).collect()]
    assert [r.zone_label for r in got.zones_by_appearance().collect()] == first
    assert got.recent_table(4).collect() == report.recent_table(display, 4).collect()


@pytest.fixture(scope="module", autouse=True)
def narrow(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_equal_to_the_whole_log_after_every_batch(spark, tmp_path):
    path, log = str(tmp_path / "report"), []
    for n, rows in enumerate(batches()):
        if n == 3:
            # A batch that gives way to another, as after a flush or a failure.
            merge_batch(table(spark, rows[:1]), path, n, CFG)
        merge_batch(table(spark, rows), path, n, CFG)
        log += rows
        agree(spark, path, log)
    assert standing.versions(spark, path) == [3, 4]
    assert Standing(spark, path).snapshot.filter("kind = 'zone'").count() == 3


def test_a_merge_reads_one_snapshot_and_the_batch(spark, tmp_path, monkeypatch):
    path, read = str(tmp_path / "report"), []
    real = standing._merge

    def seen(rows, before, *others):
        read.extend(before.inputFiles() if before is not None else [])
        real(rows, before, *others)

    monkeypatch.setattr(standing, "_merge", seen)
    sizes = []
    for n, rows in enumerate(batches(n=4)):
        read.clear()
        merge_batch(table(spark, rows), path, n, CFG)
        assert all(f"/version={n - 1}/" in name for name in read)
        sizes.append(Standing(spark, path).snapshot.filter("kind = 'open'").count())
    assert max(sizes) <= 4 * 3


def test_rebuilt_from_the_log(spark, tmp_path):
    path, log = str(tmp_path / "report"), [r for rows in batches() for r in rows]
    rest = [r for r in log if r[5] == 4]
    with pytest.raises(ValueError, match="rebuild"):
        merge_batch(table(spark, rest), path, 4, CFG)
    rebuild(table(spark, log), path, 3, CFG)
    merge_batch(table(spark, rest), path, 4, CFG)
    agree(spark, path, log)


def test_settled_windows_are_not_replaced(spark, tmp_path):
    path = str(tmp_path / "report")
    row = (START_MS + 100_000, "a", 1, 1.0, "NORMAL", 0, 0)
    merge_batch(table(spark, [row]), path, 0, CFG)
    with pytest.raises(Exception, match="settled windows"):
        merge_batch(table(spark, [(START_MS, *row[1:])]), path, 1, CFG)


def test_no_report_yet(spark, tmp_path):
    none = Standing(spark, str(tmp_path / "nothing"), CFG)
    assert none.summary_metrics().first()[:] == (0, 0, 0, 0)
    assert none.display_rows().collect() == [] and none.recent_table().collect() == []
    merge_batch(table(spark, []), str(tmp_path / "empty"), 0, CFG)
    agree(spark, str(tmp_path / "empty"), [])
