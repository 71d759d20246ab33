"""The alert log: tolerant reading, and writing as JSON lines or Parquet.

Each micro-batch owns the folder ``emit_batch=<id>`` and overwrites it, so a replayed
batch leaves the log as it was. Files are written by the tasks; nothing passes through
the driver.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spikewatch.functions.jsontext import (
    missing_names,
    not_blank,
    parse_once,
    single_object,
    to_integer,
    to_number,
)
from spikewatch.functions.numbers import plain_decimal
from spikewatch.functions.timeline import iso_utc, parse_iso
from spikewatch.schemas import ALERT

FIELDS = (
    "timestamp string, zone string, request_count variant, ema_baseline variant, "
    "status string, _corrupt string"
)
PARSER = {"columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"}
COLUMNS = ["timestamp", "zone", "request_count", "ema_baseline", "status"]


def date_of() -> Column:
    """The date a log may be divided by; times are UTC."""
    return F.to_date("timestamp")


def alert_line() -> Column:
    """Compact JSON text of an alert row, keys in alphabetical order.

    The baseline is spliced in as plain decimal text, since ``to_json`` would print
    ten million as 1.0E7.
    """
    rest = F.to_json(
        F.struct(
            "request_count",
            "status",
            iso_utc(F.unix_millis("timestamp")).alias("timestamp"),
            "zone",
        ),
        {"writeNonAsciiCharacterAsCodePoint": "true"},
    )
    baseline = plain_decimal(F.col("ema_baseline"))
    return F.concat(F.lit('{"ema_baseline":'), baseline, F.lit(","), F.substring(rest, 2, 2**31 - 1))


def _read_text(spark: SparkSession, path: str) -> DataFrame | None:
    """The text at ``path``, or nothing if there is no such path."""
    try:
        return spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def within_dates(rows: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    """Leave dates outside ``[start, end)`` unread, if the log is divided by date."""
    if "date" not in rows.columns:
        return rows
    if start is not None:
        rows = rows.filter(F.col("date") >= F.lit(start.date()))
    if end is not None:
        rows = rows.filter(F.col("date") <= F.lit(end.date()))
    return rows


def log_lines(
    spark: SparkSession, path: str, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Non-blank lines with ``row_order``, their order in the log; empty if there is no log.

    ``row_order`` is (micro-batch, file, block, line), so that later batches come last. Of a
    log divided by date only the dates from ``start`` to ``end`` (in UTC) are read; lines of
    those days outside the two times are still there.
    """
    text = _read_text(spark, path)
    if text is None:
        return spark.createDataFrame([], "value string, row_order struct<batch:bigint>")
    text = within_dates(text, start, end)
    batch = F.col("emit_batch") if "emit_batch" in text.columns else F.lit(0)
    order = F.struct(
        batch.cast("bigint").alias("batch"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return text.select("value", order.alias("row_order")).filter(not_blank(F.col("value")))


def parse_alerts(lines: DataFrame) -> DataFrame:
    """Typed alert columns of every line plus ``error``, null on valid lines.

    ``timestamp`` may be null on a valid line; such rows are dropped by
    ``valid_alerts`` without counting as malformed.
    """
    others = [c for c in lines.columns if c not in COLUMNS and c != "value"]
    raw = parse_once(lines, FIELDS, PARSER)
    names = ["timestamp", "zone", "request_count", "ema_baseline", "status"]
    typed = raw.select(
        *others,
        "value",
        F.col("_raw._corrupt").alias("_corrupt"),
        missing_names({n: F.col(f"_raw.{n}").isNotNull() for n in names}).alias("_missing"),
        parse_iso(F.col("_raw.timestamp")).alias("timestamp"),
        F.col("_raw.zone").alias("zone"),
        to_integer(F.col("_raw.request_count")).alias("request_count"),
        to_number(F.col("_raw.ema_baseline")).alias("ema_baseline"),
        F.col("_raw.status").alias("status"),
    )
    error = (
        F.when(F.col("_corrupt").isNotNull() | ~single_object(F.col("value")), "Malformed JSON")
        .when(
            F.col("_missing") != "",
            # Fixed wording.
            F.concat(F.lit("Missing required fields: "), F.col("_missing")),
        )
        .when(F.col("request_count").isNull(), "Unreadable number: request_count")
        .when(F.col("ema_baseline").isNull(), "Unreadable number: ema_baseline")
    )
    return typed.withColumn("error", error).drop("_corrupt", "_missing")


def valid_alerts(parsed: DataFrame) -> DataFrame:
    """Valid rows with a readable timestamp, keeping ``row_order``."""
    return (
        parsed.filter(F.col("error").isNull())
        .dropna(subset=["timestamp"])
        .select(*COLUMNS, *[c for c in parsed.columns if c == "row_order"])
    )


def alerts_between(
    spark: SparkSession, path: str, start: datetime, end: datetime
) -> DataFrame:
    """Valid rows of a log of lines whose window ends in ``[start, end)``, with ``row_order``."""
    rows = valid_alerts(parse_alerts(log_lines(spark, path, start, end)))
    return rows.filter((F.col("timestamp") >= F.lit(start)) & (F.col("timestamp") < F.lit(end)))


def log_quality(parsed: DataFrame, order: str = "row_order") -> DataFrame:
    """One row: ``valid_lines, malformed_lines, last_error``."""
    bad = F.col("error").isNotNull()
    return parsed.agg(
        F.count_if(~bad).alias("valid_lines"),
        F.count_if(bad).alias("malformed_lines"),
        F.max_by(F.col("error"), F.when(bad, F.col(order))).alias("last_error"),
    )


def status_message(quality: DataFrame, name: str) -> DataFrame:
    """Add ``message``, the sentence shown above the reports."""
    # Fixed wording of the status line.
    skipped = F.format_string("Skipped %d malformed line(s).", "malformed_lines")
    issue = F.concat(F.lit("Last parse issue: "), F.col("last_error"))
    live = F.concat_ws(
        " ",
        F.lit("Live stream connected."),
        F.when(F.col("malformed_lines") > 0, skipped),
        F.when(F.col("malformed_lines") > 0, issue),
    )
    return quality.withColumn(
        "message",
        F.when(F.col("valid_lines") > 0, live).otherwise(f"{name} has no valid rows yet."),
    )


def log_status(spark: SparkSession, path: str) -> DataFrame:
    """Quality and message of the log at ``path``, also when it does not exist yet."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    status = status_message(log_quality(parse_alerts(log_lines(spark, path))), name)
    if _read_text(spark, path) is None:
        # Fixed wording.
        status = status.withColumn("message", F.lit(f"Waiting for data file: {name}"))
    return status


def write_owned(
    rows: DataFrame, path: str, batch_id: int, fmt: str, by: tuple[str, ...] = ()
) -> None:
    """Write rows as the folder ``emit_batch=<batch_id>``, divided further by columns ``by``.

    The first batch truncates what is at ``path``; every later one replaces its own folder.
    """
    if batch_id == 0:
        rows = rows.withColumn("emit_batch", F.lit(batch_id).cast("bigint"))
        writer = rows.write.partitionBy("emit_batch", *by)
        writer = writer.option("partitionOverwriteMode", "static")
    else:
        # The folder itself, so that a batch without rows empties it too.
        path = f"{path.rstrip('/')}/emit_batch={batch_id}"
        writer = rows.write.partitionBy(*by) if by else rows.write
    writer.mode("overwrite").format(fmt).save(path)


def write_batch(
    alerts: DataFrame,
    path: str,
    batch_id: int,
    fmt: str = "json",
    files: int | None = None,
    by_date: bool = False,
) -> None:
    """Write one batch of alert rows as ``emit_batch=<batch_id>``.

    The first batch truncates the log; every later one replaces only its own folder.
    Rows are kept in ``emit_seq`` order per key where that column exists. ``files``
    bounds the number of files, which otherwise is that of the shuffle partitions. With
    ``by_date`` a batch is divided by the date of the window end, so that reports on some
    days read only those; a batch of a running stream spans a day or two.
    """
    rows = alerts.drop("emit_batch")
    if files is not None:
        rows = rows.repartition(files, "zone")
    own = [date_of().alias("date")] if by_date else []
    if fmt == "json":
        if "emit_seq" in rows.columns:
            rows = rows.sortWithinPartitions(*([date_of()] if by_date else []), "zone", "emit_seq")
        rows = rows.select(alert_line().alias("value"), *own)
    else:
        rows = rows.select("*", *own)
    write_owned(rows, path, batch_id, "text" if fmt == "json" else fmt, ("date",) if by_date else ())


def stored_schema() -> T.StructType:
    """Schema of a Parquet log, for reading it while it is still empty."""
    extra = [T.StructField("emit_seq", T.LongType()), T.StructField("emit_batch", T.LongType())]
    return T.StructType([*ALERT.fields, *extra])
