"""Running detection as a streaming job that keeps an alert log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spikewatch.config import SurgeConfig
from spikewatch.plans import standing
from spikewatch.plans.detect import as_alerts
from spikewatch.schemas import LATE_REQUEST
from spikewatch.session import configure, shared_dir
from spikewatch.sources.alert_log import write_batch, write_owned
from spikewatch.sources.requests import accepted, late_line, parse_requests, with_event_time
from spikewatch.streaming import final, refire
from spikewatch.streaming.final import FinalProcessor, detect_final
from spikewatch.streaming.keyed import late_events, one_per_window, pending_rows, states_of
from spikewatch.streaming.refire import RefireProcessor, detect_refire

MODES = {"final": detect_final, "refire": detect_refire}
HISTORIES = {"final": final.history, "refire": refire.history}
PROCESSORS = {"final": FinalProcessor, "refire": RefireProcessor}


def requests_of(lines: DataFrame, failfast: bool = False) -> DataFrame:
    """Good requests of JSON lines, with ``event_time``."""
    return with_event_time(accepted(parse_requests(lines), failfast))


def _batch_writer(
    cfg: SurgeConfig,
    path: str,
    fmt: str,
    files: int | None,
    by_date: bool,
    late_path: str | None,
    report_path: str | None,
) -> Callable[[DataFrame, int], None]:
    """What happens to a micro-batch. Every output owns its folders per batch, so that a batch
    that is replayed after a failure anywhere leaves all of them as they should be."""

    def write(batch: DataFrame, batch_id: int) -> None:
        several = late_path is not None or report_path is not None
        if several:
            # The state is read once, whatever the number of outputs.
            batch.persist()
        try:
            alerts = as_alerts(one_per_window(batch, cfg) if late_path is not None else batch)
            write_batch(alerts, path, batch_id, fmt, files, by_date)
            if late_path is not None:
                late = late_events(batch, LATE_REQUEST).select(late_line().alias("value"))
                write_owned(late, late_path, batch_id, "text")
            if report_path is not None:
                standing.merge_batch(alerts, report_path, batch_id, cfg)
        finally:
            if several:
                batch.unpersist()

    return write


def start_job(
    requests: DataFrame,
    path: str,
    checkpoint: str,
    cfg: SurgeConfig | None = None,
    mode: str = "final",
    fmt: str = "json",
    files: int | None = None,
    until_caught_up: bool = False,
    flush: bool = False,
    by_date: bool = False,
    late_path: str | None = None,
    report_path: str | None = None,
    states: DataFrame | None = None,
    **options: str | bool,
) -> StreamingQuery:
    """Start detection over a stream with an ``event_time`` column.

    ``until_caught_up`` processes what is there and stops. ``flush`` then waits for that and
    evaluates the windows still open, as at the end of a bounded stream. The log at ``path`` is
    truncated when the job starts with a fresh checkpoint and continued otherwise;
    ``files`` bounds the files per micro-batch and ``by_date`` divides it by the date of the
    window end. Other options go to the mode: ``key``, ``time``, and ``wait_for_late`` in final
    mode.

    Requests too late to count are written as lines to ``late_path``. They need the columns
    of a request, which then travel to the task of their key with the counts. ``report_path``
    keeps the tables of ``standing`` up to date. A new job starts from ``states`` that
    ``from_history`` made, and otherwise cold.
    """
    cfg = cfg or SurgeConfig()
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(sorted(MODES))}")
    if flush and not until_caught_up:
        raise ValueError("flush needs until_caught_up: an endless stream has no end")
    spark = requests.sparkSession
    configure(spark, cfg)
    side = LATE_REQUEST.fieldNames() if late_path is not None else None
    key = options.get("key", "zone_id")
    if side is not None and key != "zone_id":
        # The line names the key that the request was counted under.
        requests = requests.withColumn("zone_id", F.col(key).cast("string"))
    evaluations = MODES[mode](requests, cfg, side=side, states=states, **options)
    write = _batch_writer(cfg, path, fmt, files, by_date, late_path, report_path)
    writer = (
        evaluations.writeStream.outputMode("append" if mode == "final" else "update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    if until_caught_up:
        writer = writer.trigger(availableNow=True)
    query = writer.start()
    if flush:
        query.awaitTermination()
        flush_pending(spark, path, checkpoint, cfg, mode, fmt, files, by_date, report_path)
    return query


def from_history(
    requests: DataFrame, cfg: SurgeConfig | None = None, mode: str = "final", **options: str | bool
) -> tuple[DataFrame, DataFrame]:
    """Evaluations over a bounded history, with ``emit_seq``, and the states that a job over
    what comes after it starts from. Options are those of the mode."""
    cfg = cfg or SurgeConfig()
    after = HISTORIES[mode](requests, cfg, **options)
    # Read twice; written to the shared folder once.
    path = shared_dir(requests.sparkSession, "history")
    after.write.parquet(path)
    after = requests.sparkSession.read.schema(after.schema).parquet(path)
    return one_per_window(after, cfg), states_of(after)


def flush_pending(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    cfg: SurgeConfig,
    mode: str = "final",
    fmt: str = "json",
    files: int | None = None,
    by_date: bool = False,
    report_path: str | None = None,
) -> None:
    """Write the windows a stopped job still waits with, as the log's next micro-batch.

    The states are read where the job left them and stay as they are: a job that goes on
    from the checkpoint writes its next micro-batch over this one.
    """
    found = spark.read.format("state-metadata").load(checkpoint)
    last = found.agg(F.max("maxBatchId").alias("last")).first()["last"]
    if last is None:
        return
    states = (
        spark.read.format("statestore")
        .option("path", checkpoint)
        .option("stateVarName", "key_state")
        .load()
        .select("key.*", "value.*")
    )
    rows = as_alerts(pending_rows(states, PROCESSORS[mode](cfg)))
    write_batch(rows, path, last + 1, fmt, files, by_date)
    if report_path is not None:
        standing.merge_batch(rows, report_path, last + 1, cfg)
