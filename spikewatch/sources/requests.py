"""Ride requests: JSON lines to typed rows, with every rejection explained.

JSON null in a required field counts as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikewatch.functions.jsontext import (
    is_given,
    missing_names,
    parse_once,
    single_object,
    to_integer,
    truthy,
)
from spikewatch.functions.timeline import admitted, parse_iso_millis

FIELDS = (
    "ride_id string, zone_id string, timestamp string, "
    "event_time_millis variant, is_simulated_late variant, _corrupt string"
)
PARSER = {"columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"}
COLUMNS = ["ride_id", "zone_id", "timestamp", "event_time_millis", "is_simulated_late"]


def parse_requests(lines: DataFrame) -> DataFrame:
    """Typed columns of every line plus ``reject_reason``, null on good lines.

    An explicit ``event_time_millis`` wins over the ``timestamp`` text. Times outside the
    years 1000 to 2999, such as placeholder dates, are rejected: one of them would move a
    stream's watermark beyond all others. Other columns of ``lines`` are kept.
    """
    others = [c for c in lines.columns if c not in COLUMNS]
    raw = parse_once(lines, FIELDS, PARSER)
    explicit = F.col("_raw.event_time_millis")
    event_time = F.when(is_given(explicit), to_integer(explicit)).otherwise(
        parse_iso_millis(F.col("_raw.timestamp"))
    )
    typed = raw.select(
        *others,
        "_raw._corrupt",
        "_raw.ride_id",
        "_raw.zone_id",
        "_raw.timestamp",
        event_time.alias("event_time_millis"),
        truthy(F.col("_raw.is_simulated_late")).alias("is_simulated_late"),
    )
    missing = missing_names(
        {name: F.col(name).isNotNull() for name in ("ride_id", "zone_id", "timestamp")}
    )
    reason = (
        F.when(F.col("_corrupt").isNotNull() | ~single_object(F.col("value")), "Malformed JSON")
        .when(missing != "", F.concat(F.lit("Missing required event fields: "), missing))
        .when(F.col("event_time_millis").isNull(), "Unreadable event time")
        .when(~admitted(F.col("event_time_millis")), "Event time outside the years 1000 to 2999")
    )
    return typed.withColumn("reject_reason", reason).drop("_corrupt")


def accepted(parsed: DataFrame, failfast: bool = False) -> DataFrame:
    """Good rows. With ``failfast`` the first bad line fails the job, as a filter so that
    column pruning cannot skip the check."""
    reason = F.col("reject_reason")
    keep: Column = reason.isNull()
    if failfast:
        keep = F.when(reason.isNull(), True).otherwise(F.raise_error(reason).cast("boolean"))
    return parsed.filter(keep).select(*COLUMNS)


def rejected(parsed: DataFrame) -> DataFrame:
    """Quarantined lines with their reason."""
    return parsed.filter(F.col("reject_reason").isNotNull()).select("value", "reject_reason")


def reject_counts(parsed: DataFrame) -> DataFrame:
    """Lines per reason; null stands for accepted lines."""
    return parsed.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("lines"))


def with_event_time(requests: DataFrame) -> DataFrame:
    """Add the ``event_time`` timestamp used by watermarks and ``window()``."""
    return requests.withColumn("event_time", F.timestamp_millis("event_time_millis"))


def request_line(columns: tuple[str, ...] = tuple(COLUMNS)) -> Column:
    """Compact JSON text of a request, keys in alphabetical order."""
    return F.to_json(F.struct(*sorted(columns)), {"writeNonAsciiCharacterAsCodePoint": "true"})


def late_line() -> Column:
    """Text of a late request for the side output."""
    # Fixed wording.
    return F.format_string(
        "LATE_EVENT | zone=%s | ride_id=%s | timestamp=%s | is_simulated_late=%s",
        "zone_id",
        "ride_id",
        "timestamp",
        F.col("is_simulated_late").cast("string"),
    )
