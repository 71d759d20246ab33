"""Report tables that are kept up to date while the alert log grows.

Reports over a log read all of it. Here every micro-batch is merged once, and what a merge
reads and writes does not depend on the length of the log:

- ``settled/batch=<id>/date=<day>``: evaluations that can no longer be replaced, written
  once, by the batch that settles them;
- ``version=<id>``: a snapshot after that batch. It holds the evaluations that a late event may
  still replace (``open``), totals per zone over the settled ones (``zone``), the newest
  settled rows that a list of recent evaluations needs (``recent``) and one row on the log.

A window end is settled once it lies further behind the newest evaluation than the allowed
lateness and a window: the watermark has passed the newest one, an event is admitted only if
its last window is within the lateness of the watermark, and its first window ends no more
than a window before its last.

A merge reads the snapshot before it and the batch, and writes folders of its own, so that a
batch that is replayed, or takes the place of a flush, leaves the same tables. The snapshot is
written last; readers take the newest one that is complete, and the settled rows up to it. The
two newest snapshots are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spikewatch.config import SurgeConfig
from spikewatch.operators import report
from spikewatch.schemas import ALERT, SURGE_ALERT
from spikewatch.sources.alert_log import date_of

RECENT = 20
EVALUATION = T.StructType(
    [*ALERT.fields, T.StructField("emit_batch", T.LongType()), T.StructField("emit_seq", T.LongType())]
)
# A zone's row holds its last settled evaluation, totals, and where it first appears in the
# log. The log's row holds the newest window end, and the number of rows as ``windows``.
SNAPSHOT = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        *EVALUATION.fields,
        T.StructField("windows", T.LongType()),
        T.StructField("surges", T.LongType()),
        T.StructField("peak", T.LongType()),
        T.StructField("first_batch", T.LongType()),
        T.StructField("first_seq", T.LongType()),
        T.StructField("settled_before", T.TimestampType()),
    ]
)
NAMES = EVALUATION.fieldNames()


def _folder(spark: SparkSession, path: str):
    """A folder and its file system, by Hadoop's interface: any store that Spark writes to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete snapshots, rising."""
    at, files = _folder(spark, path)
    if not files.exists(at):
        return []
    names = [status.getPath().getName() for status in files.listStatus(at)]
    numbers = [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]
    done = [n for n in numbers if files.exists(_folder(spark, f"{path}/version={n}/_SUCCESS")[0])]
    return sorted(done)


def _snapshot(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(SNAPSHOT).parquet(f"{path}/version={version}")


def _filled(rows: DataFrame, kind: str) -> DataFrame:
    """The rows as part of a snapshot."""
    have = set(rows.columns)
    return rows.select(
        F.lit(kind).alias("kind"),
        *(
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SNAPSHOT.fields[1:]
        ),
    )


def _by_zone(evaluations: DataFrame) -> DataFrame:
    """Totals of evaluations, one per zone and time, as zones' rows."""
    ms = F.unix_micros("timestamp")
    last = [F.max_by(name, ms).alias(name) for name in NAMES if name not in ("zone", "timestamp")]
    first = F.min(F.struct("emit_batch", "emit_seq")).alias("first")
    return (
        evaluations.groupBy("zone")
        .agg(
            F.max("timestamp").alias("timestamp"),
            *last,
            F.count(F.lit(1)).alias("windows"),
            F.count_if(F.col("status") == SURGE_ALERT).alias("surges"),
            F.max("request_count").alias("peak"),
            first,
        )
        .select(
            *NAMES,
            "windows",
            "surges",
            "peak",
            F.col("first.emit_batch").alias("first_batch"),
            F.col("first.emit_seq").alias("first_seq"),
        )
    )


def _added(zones: DataFrame) -> DataFrame:
    """Zones' rows of several sets of windows, added up."""
    ms = F.unix_micros("timestamp")
    last = [F.max_by(name, ms).alias(name) for name in NAMES if name not in ("zone", "timestamp")]
    return (
        zones.groupBy("zone")
        .agg(
            F.max("timestamp").alias("timestamp"),
            *last,
            *(F.sum(name).alias(name) for name in ("windows", "surges")),
            F.max("peak").alias("peak"),
            F.min(F.struct("first_batch", "first_seq")).alias("first"),
        )
        .select(*NAMES, "windows", "surges", "peak", "first.first_batch", "first.first_seq")
    )


def merge_batch(
    alerts: DataFrame, path: str, batch_id: int, cfg: SurgeConfig, recent: int = RECENT
) -> None:
    """Merge the alert rows of one micro-batch, with ``emit_seq``, into the tables at ``path``.

    Batch 0 starts afresh. A batch needs the snapshot of the one before it; where there is
    none, as when a log is older than its report, ``rebuild`` makes it.
    """
    spark = alerts.sparkSession
    before = None
    if batch_id:
        if batch_id - 1 not in versions(spark, path):
            raise ValueError(f"no snapshot of batch {batch_id - 1} at {path}: rebuild it first")
        before = _snapshot(spark, path, batch_id - 1)
    rows = alerts.withColumn("emit_batch", F.lit(batch_id).cast("long")).select(*NAMES)
    _merge(rows, before, path, batch_id, cfg, recent)


def rebuild(
    alerts: DataFrame, path: str, batch_id: int, cfg: SurgeConfig, recent: int = RECENT
) -> None:
    """The snapshot after ``batch_id`` from all rows of a stored log up to it, which have
    ``emit_batch`` and ``emit_seq``."""
    rows = alerts.filter(F.col("emit_batch") <= batch_id).select(*NAMES)
    _merge(rows, None, path, batch_id, cfg, recent)


def _merge(
    rows: DataFrame,
    before: DataFrame | None,
    path: str,
    batch_id: int,
    cfg: SurgeConfig,
    recent: int,
) -> None:
    spark = rows.sparkSession
    if before is None:
        at, files = _folder(spark, path)
        files.delete(at, True)
        before = spark.createDataFrame([], SNAPSHOT)
    # Read several times; a snapshot does not grow with the log.
    before = before.persist()
    # Times pass through the driver as microseconds, which no time zone changes.
    at = F.unix_micros("timestamp")
    log = before.filter("kind = 'log'")
    told = log.select(at.alias("newest"), "windows", F.unix_micros("settled_before").alias("edge"))
    told = told.first()
    limit = told["edge"] if told else None
    if limit is not None:
        late = F.concat(F.lit("An evaluation of settled windows: "), F.col("timestamp").cast("string"))
        fine = F.when(at >= limit, True).otherwise(F.raise_error(late).cast("boolean"))
        rows = rows.filter(fine)
    rows = rows.persist()
    evaluations = before.filter("kind = 'open'").select(*NAMES).union(rows)
    evaluations = report.last_rows(evaluations, ["timestamp", "zone"], ["emit_batch", "emit_seq"])
    evaluations = evaluations.persist()
    try:
        new = rows.agg(F.max(at).alias("newest"), F.count(F.lit(1)).alias("n")).first()
        times = [t for t in (new["newest"], told["newest"] if told else None) if t is not None]
        newest = max(times, default=None)
        edge = None
        if newest is not None:
            edge = newest - 1000 * (cfg.lateness_ms + cfg.window_ms)
            edge = edge if limit is None else max(edge, limit)
        is_settled = F.lit(False) if edge is None else at < edge
        settled = evaluations.filter(is_settled)
        settled.withColumn("date", date_of()).write.mode("overwrite").partitionBy("date").parquet(
            f"{path}/settled/batch={batch_id}"
        )
        zones = _added(
            before.filter("kind = 'zone'")
            .select(*NAMES, "windows", "surges", "peak", "first_batch", "first_seq")
            .unionByName(_by_zone(settled))
        )
        newest_settled = before.filter("kind = 'recent'").select(*NAMES).union(settled)
        newest_settled = newest_settled.orderBy(
            F.desc("timestamp"), F.desc("emit_batch"), F.desc("emit_seq"), F.desc("zone")
        ).limit(recent)
        counted = spark.range(1).select(
            F.timestamp_micros(F.lit(newest).cast("long")).alias("timestamp"),
            F.lit((told["windows"] if told else 0) + new["n"]).alias("windows"),
            F.timestamp_micros(F.lit(edge).cast("long")).alias("settled_before"),
        )
        snapshot = (
            _filled(evaluations.filter(~is_settled), "open")
            .union(_filled(zones, "zone"))
            .union(_filled(newest_settled, "recent"))
            .union(_filled(counted, "log"))
        )
        # Small, and read by every merge and report: one file for each task is too many.
        files = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
        snapshot.coalesce(files).write.mode("overwrite").parquet(f"{path}/version={batch_id}")
    finally:
        for frame in (evaluations, rows, before):
            frame.unpersist()
    for old in versions(spark, path):
        if old < batch_id - 1:
            at, files = _folder(spark, f"{path}/version={old}")
            files.delete(at, True)


class Standing:
    """The report tables as of the newest complete snapshot.

    ``row_order`` is (micro-batch, ``emit_seq``, zone).
    """

    def __init__(self, spark: SparkSession, path: str, cfg: SurgeConfig | None = None) -> None:
        self.spark, self.path, self.cfg = spark, path, cfg
        done = versions(spark, path)
        self.version = done[-1] if done else None
        if self.version is None:
            self.snapshot = spark.createDataFrame([], SNAPSHOT)
        else:
            self.snapshot = _snapshot(spark, path, self.version)

    def _of(self, *kinds: str) -> DataFrame:
        return self.snapshot.filter(F.col("kind").isin(*kinds))

    def _shown(self, rows: DataFrame, *others: str) -> DataFrame:
        order = F.struct("emit_batch", "emit_seq", "zone").alias("row_order")
        return report.displayed(rows.select(*ALERT.fieldNames(), order, *others), self.cfg)

    def display_rows(self) -> DataFrame:
        """Like ``report.display_rows`` over the whole log, without a shuffle. A filter on
        ``date`` leaves other days of settled windows unread."""
        rows = self._of("open").select(*NAMES, date_of().alias("date"))
        if self.version is not None:
            folders = [T.StructField("batch", T.LongType()), T.StructField("date", T.DateType())]
            schema = T.StructType([*EVALUATION.fields, *folders])
            settled = self.spark.read.schema(schema).parquet(f"{self.path}/settled")
            settled = settled.filter(F.col("batch") <= self.version)
            rows = rows.union(settled.select(*NAMES, "date"))
        return self._shown(rows, "date")

    def zones(self) -> DataFrame:
        """Totals and last evaluation per zone, from one row per zone and the open windows."""
        own = ["windows", "surges", "peak", "first_batch", "first_seq"]
        settled = self._of("zone").select(*NAMES, *own)
        return _added(settled.unionByName(_by_zone(self._of("open").select(*NAMES))))

    def latest_display(self) -> DataFrame:
        return self._shown(self.zones())

    def recent_table(self, limit: int = RECENT) -> DataFrame:
        """As ``report.recent_table``, up to the number of rows that merges kept."""
        return report.recent_table(self._shown(self._of("recent", "open").select(*NAMES)), limit)

    def summary_metrics(self) -> DataFrame:
        surging = (F.col("status") == SURGE_ALERT).alias("surging")
        return report.summed(self.zones().select("windows", "surges", "peak", surging))

    def surge_counts(self) -> DataFrame:
        label = report.zone_label(F.col("zone")).alias("zone")
        counts = self.zones().groupBy(label).agg(F.sum("surges").alias("surge_alerts"))
        return counts.filter("surge_alerts > 0")

    def zones_by_appearance(self) -> DataFrame:
        first = F.struct(
            F.col("first_batch").alias("emit_batch"), F.col("first_seq").alias("emit_seq"), "zone"
        )
        label = report.zone_label(F.col("zone")).alias("zone_label")
        rows = self.zones().groupBy(label).agg(F.min(first).alias("first_row"))
        return rows.orderBy("first_row")
