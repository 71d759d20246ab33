"""Expected extra load from a cyclic schedule of ``(zone, start_s, end_s, extra)``.

Overlapping entries add up. The schedule is first cut into steps that do not overlap,
so each event meets at most one step and no aggregation over events is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Parts of the cycle that events and steps are joined by, besides the zone.
PARTS = 64
# Spans of time that events and versions of a schedule are joined by, besides zone and part.
ERA_S = 86_400


def schedule_steps(schedule: DataFrame, by: tuple[str, ...] = ("zone",)) -> DataFrame:
    """Per zone the spans ``[from_s, to_s)`` of constant total ``extra``; zero spans left out."""
    changes = F.array(
        F.struct(F.col("start_s").alias("at"), F.col("extra").alias("change")),
        F.struct(F.col("end_s").alias("at"), (-F.col("extra")).alias("change")),
    )
    by_time = Window.partitionBy(*by).orderBy("at")
    return (
        schedule.filter(F.col("start_s") < F.col("end_s"))
        .select(*by, F.inline(changes))
        .groupBy(*by, "at")
        .agg(F.sum("change").alias("change"))
        .select(
            *by,
            F.col("at").alias("from_s"),
            F.lead("at").over(by_time).alias("to_s"),
            F.sum("change").over(by_time).alias("extra"),
        )
        .filter(F.col("to_s").isNotNull() & (F.col("extra") != 0))
    )


def _in_parts(steps: DataFrame, cycle_s: int, parts: int) -> DataFrame:
    """Steps within the cycle as ``_from, _to``, once for each ``_part`` that they touch."""
    inside = steps.withColumns(
        {
            "_from": F.greatest(F.col("from_s").cast("long") * 1000, F.lit(0)),
            "_to": F.least(F.col("to_s").cast("long") * 1000, F.lit(cycle_s * 1000)),
        }
    ).filter("_from < _to")
    width = _width(cycle_s, parts)
    touched = F.sequence(F.floor(F.col("_from") / width), F.floor((F.col("_to") - 1) / width))
    return inside.withColumn("_part", F.explode(touched)).drop("from_s", "to_s")


def _width(cycle_s: int, parts: int) -> int:
    return -(-cycle_s * 1000 // parts)


def _placed(events: DataFrame, cycle_s: int, origin_ms: int, time_ms: str) -> DataFrame:
    cycle = F.lit(cycle_s * 1000).cast("long")
    return events.withColumn("cycle_ms", F.pmod(F.col(time_ms) - F.lit(origin_ms), cycle))


def _joined(placed: DataFrame, steps: DataFrame, inside: Column, base: int) -> DataFrame:
    extra = F.coalesce("extra", F.lit(0).cast("long"))
    return placed.join(steps, inside, "left").select(
        *placed.columns,
        extra.alias("extra"),
        (F.lit(base) + extra).alias("expected_load"),
    )


def annotate_schedule(
    events: DataFrame,
    schedule: DataFrame,
    cycle_s: int,
    origin_ms: int = 0,
    base: int = 1,
    key: str = "zone_id",
    time_ms: str = "event_time_millis",
    parts: int = PARTS,
) -> DataFrame:
    """Add ``cycle_ms``, ``extra`` (0 outside every entry) and ``expected_load``.

    The cycle is cut into ``parts``; a step is listed in each part it touches and an event
    looks in its own. So a zone's events are spread over many tasks and meet few steps.
    """
    placed = _placed(events, cycle_s, origin_ms, time_ms)
    steps = _in_parts(schedule_steps(schedule), cycle_s, parts)
    steps = steps.withColumnRenamed("zone", "_zone")
    inside = (
        (F.col(key) == F.col("_zone"))
        & (F.floor(F.col("cycle_ms") / _width(cycle_s, parts)) == F.col("_part"))
        & (F.col("cycle_ms") >= F.col("_from"))
        & (F.col("cycle_ms") < F.col("_to"))
    )
    return _joined(placed, steps, inside, base)


def version_spans(versions: DataFrame) -> DataFrame:
    """``zone, valid_from_ms, valid_to_ms``: a version holds until its zone's next one.

    The last version of a zone ends with no time, null.
    """
    by_time = Window.partitionBy("zone").orderBy("valid_from_ms")
    given = versions.filter("zone IS NOT NULL AND valid_from_ms IS NOT NULL")
    return given.select("zone", "valid_from_ms").distinct().select(
        "zone", "valid_from_ms", F.lead("valid_from_ms").over(by_time).alias("valid_to_ms")
    )


def annotate_versions(
    events: DataFrame,
    versions: DataFrame,
    cycle_s: int,
    origin_ms: int = 0,
    base: int = 1,
    key: str = "zone_id",
    time_ms: str = "event_time_millis",
    parts: int = PARTS,
    era_s: int = ERA_S,
) -> DataFrame:
    """As ``annotate_schedule``, by the version of a zone's schedule in force at each event.

    ``versions`` are entries with ``valid_from_ms``: those of a zone with the same start are one
    version, which replaces the one before as a whole (an entry without a span makes an empty
    one). Before a zone's first version there is no schedule.

    An event looks for its version among those of its zone in its era, and for its step among
    those of its part of the cycle, in one join on all three. A version's steps are listed in
    each era that it shares with the events' time range, so that neither an old version nor a
    zone with most of the events lands in one task. Nothing is broadcast by force.
    """
    placed = _placed(events, cycle_s, origin_ms, time_ms)
    era_ms = era_s * 1000
    # Two numbers; without events there is nothing to list.
    reach = events.agg(F.min(time_ms).alias("first"), F.max(time_ms).alias("last")).first()
    first, last = (reach["first"], reach["last"]) if reach["first"] is not None else (0, -1)
    spans = version_spans(versions).select(
        "zone",
        "valid_from_ms",
        F.greatest("valid_from_ms", F.lit(first)).alias("_valid_from"),
        # Least leaves nulls out.
        F.least("valid_to_ms", F.lit(last + 1)).alias("_valid_to"),
    )
    spans = spans.filter("_valid_from < _valid_to")
    steps = schedule_steps(versions, ("zone", "valid_from_ms"))
    steps = _in_parts(steps, cycle_s, parts).join(spans, ["zone", "valid_from_ms"])
    eras = F.sequence(
        F.floor(F.col("_valid_from") / era_ms), F.floor((F.col("_valid_to") - 1) / era_ms)
    )
    steps = steps.select(
        F.col("zone").alias("_zone"),
        "extra",
        "_from",
        "_to",
        "_part",
        "_valid_from",
        "_valid_to",
        F.explode(eras).alias("_era"),
    )
    at = F.col(time_ms)
    inside = (
        (F.col(key) == F.col("_zone"))
        & (F.floor(at / era_ms) == F.col("_era"))
        & (F.floor(F.col("cycle_ms") / _width(cycle_s, parts)) == F.col("_part"))
        & (F.col("cycle_ms") >= F.col("_from"))
        & (F.col("cycle_ms") < F.col("_to"))
        & (at >= F.col("_valid_from"))
        & (at < F.col("_valid_to"))
    )
    return _joined(placed, steps, inside, base)
