"""The arrival audit of a running stream.

Rows of a micro-batch come in together: how each stands is told by the newest event time of
the micro-batches before, which is one number. It is kept in a folder per micro-batch beside
the audited rows, so that a batch that is replayed finds what it found the first time and
writes the same again. Rows are judged where they lie, without a shuffle; the batch's own newest
time is a maximum that every task takes first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spikewatch.config import SurgeConfig
from spikewatch.operators.lateness import audited_by
from spikewatch.session import configure
from spikewatch.sources.alert_log import write_owned

NEWEST = "newest_ms long"


def _newest_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The newest event time of all micro-batches before, nothing before the first."""
    if batch_id == 0:
        return None
    rows = spark.read.schema(NEWEST).parquet(f"{path}/newest/emit_batch={batch_id - 1}")
    return rows.first()["newest_ms"]


def audit_batch(batch: DataFrame, path: str, batch_id: int, cfg: SurgeConfig) -> None:
    """Write ``rows/emit_batch=<id>``: the batch with ``watermark_ms``, ``lag_ms`` and
    ``arrival_class`` as in the audit of stored arrivals, its number being the arrival.

    The first batch truncates the audit at ``path``.
    """
    before = _newest_before(batch.sparkSession, path, batch_id)
    known = F.lit(before).cast("long")
    write_owned(audited_by(batch, known, cfg), f"{path}/rows", batch_id, "parquet")
    # After a batch without rows the newest time is what it was.
    newest = batch.agg(F.greatest(known, F.max("event_time_millis")).alias("newest_ms"))
    write_owned(newest, f"{path}/newest", batch_id, "parquet")


def start_audit(
    requests: DataFrame,
    path: str,
    checkpoint: str,
    cfg: SurgeConfig | None = None,
    until_caught_up: bool = False,
) -> StreamingQuery:
    """Audit a stream of requests with ``event_time_millis``, micro-batch by micro-batch."""
    cfg = cfg or SurgeConfig()
    configure(requests.sparkSession, cfg)

    def write(batch: DataFrame, batch_id: int) -> None:
        audit_batch(batch, path, batch_id, cfg)

    writer = requests.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    if until_caught_up:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def audited_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows audited so far, with ``emit_batch`` as their arrival."""
    return spark.read.parquet(f"{path}/rows").withColumn("emit_batch", F.col("emit_batch").cast("long"))
