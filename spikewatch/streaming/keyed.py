"""What both streaming modes share: events reduced to panes, state per key, firing in order."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, fields
from itertools import accumulate
from typing import Any, ClassVar

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from spikewatch.config import SurgeConfig
from spikewatch.functions.timeline import admitted, align_down, latest_end, next_end
from spikewatch.operators.baseline import fold_counts, status_of

# Spark discards rows behind its own watermark before a processor sees them, yet even the
# oldest row may lower a key's first event time. Spark's watermark is therefore held back by
# more than any two times admitted can lie apart. What Spark is told as event time is
# shifted on, so that the watermark held back is positive and means something: zero is
# Spark's word for "none yet". Neither costs state.
YEAR_MS = 31_556_952_000
HOLD_BACK_MS = 2001 * YEAR_MS
SHIFT_MS = 4000 * YEAR_MS
END_OF_TIME = 2**62

# What a processor returns for a key: arrays over the windows fired, since single rows
# from Python cost far more than array elements do. With a side output, rows that hold
# ``late`` events, as text, come in between.
FIRED = T.StructType(
    [
        T.StructField("zone", T.StringType()),
        T.StructField("window_end_ms", T.ArrayType(T.LongType())),
        T.StructField("request_count", T.ArrayType(T.LongType())),
        T.StructField("ema_baseline", T.ArrayType(T.DoubleType())),
        T.StructField("warm", T.LongType()),
        T.StructField("emit_seq", T.LongType()),
    ]
)
LATE = T.StructField("late", T.ArrayType(T.StringType()))


def fired_schema(side: Sequence[str] | None) -> T.StructType:
    return T.StructType([*FIRED.fields, LATE]) if side else FIRED


def fired(
    zone: str, ends: list[int], counts: list[int], shown: list[float], warm: int, seq: int
) -> Row:
    """The first ``warm`` windows are warming up; ``seq`` is the first one's ``emit_seq``."""
    return Row(
        zone=zone,
        window_end_ms=ends,
        request_count=counts,
        ema_baseline=shown,
        warm=warm,
        emit_seq=seq,
    )


def too_late(zone: str, events: list[str]) -> Row:
    """Events that were dropped, in the place of windows."""
    return Row(**fired(zone, [], [], [], 0, 0).asDict(), late=events)


def late_events(tagged: DataFrame, columns: T.StructType) -> DataFrame:
    """The events that a stream with a side output dropped, with the ``columns`` asked for."""
    events = tagged.select(F.explode("late").alias("event"))
    return events.select(F.from_json("event", columns).alias("event")).select("event.*")


def one_per_window(rows: DataFrame, cfg: SurgeConfig) -> DataFrame:
    """Evaluations ``zone, window_end_ms, request_count, ema_baseline, status, emit_seq``."""
    arrays = F.arrays_zip("window_end_ms", "request_count", "ema_baseline")
    exploded = rows.select("zone", "warm", "emit_seq", F.posexplode(arrays).alias("at", "window"))
    count, baseline = F.col("window.request_count"), F.col("window.ema_baseline")
    return exploded.select(
        "zone",
        "window.window_end_ms",
        "window.request_count",
        "window.ema_baseline",
        status_of(count, baseline, F.col("at") < F.col("warm"), cfg.surge_threshold).alias(
            "status"
        ),
        (F.col("emit_seq") + F.col("at")).alias("emit_seq"),
    )



def hold_back_ms(cfg: SurgeConfig) -> int:
    return HOLD_BACK_MS + cfg.window_ms + cfg.lateness_ms + 1


def _collapse(side: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    fate = ["zone", "pane", "next_end", "latest_end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if side:
                # Events in the order of their fates, so that ``n`` tells whose is whose.
                rows = rows.sort_by([(name, "ascending") for name in fate])
            alike = rows.group_by(fate, use_threads=False).aggregate(
                [("t", "count"), ("t", "min"), ("t", "max")]
            )
            keys = alike.group_by("zone", use_threads=False).aggregate(
                [
                    ("pane", "list"),
                    ("next_end", "list"),
                    ("latest_end", "list"),
                    ("t_count", "list"),
                    ("t_min", "min"),
                    ("t_max", "max"),
                ]
            )
            shifted = pc.multiply(pc.add(keys.column("t_max_max"), SHIFT_MS), 1000)
            newest = shifted.cast(pa.timestamp("us", tz="UTC"))
            columns = {
                "zone": keys.column("zone"),
                "pane": keys.column("pane_list"),
                "next_end": keys.column("next_end_list"),
                "latest_end": keys.column("latest_end_list"),
                "n": keys.column("t_count_list"),
                "first_ms": keys.column("t_min_min"),
                "event_time": newest,
            }
            if side:
                # Zones come first in the order, so they are in the same order here.
                events = rows.group_by("zone", use_threads=False).aggregate([("event", "list")])
                columns["events"] = events.column("event_list")
            yield from pa.table(columns).combine_chunks().to_batches()

    return run


def _checked(t: Column) -> Column:
    """The time, or an error if it is outside what can be told from Spark's watermark."""
    text = F.concat(F.lit("Event time outside the years 1000 to 2999: "), t.cast("string"))
    return F.when(admitted(t), t).otherwise(F.raise_error(text).cast("bigint"))


def collapsed(
    requests: DataFrame,
    cfg: SurgeConfig,
    pane_ms: int,
    key: str,
    time: str,
    side: Sequence[str] | None = None,
) -> DataFrame:
    """Requests reduced inside each partition, before the shuffle by key.

    Events of one pane with the same first and last window share their fate, so a batch of
    events becomes one row per key with a few array elements, however hot the key.
    ``event_time`` is the newest time in a row, shifted by ``SHIFT_MS``. Rows without a key
    or time are left out. With ``side``, the columns of every event go along as JSON text,
    in the order of the array elements they are counted in: only the key's task knows which
    of them are too late.
    """
    t = F.col("t")
    event = [F.to_json(F.struct(*side)).alias("event")] if side else []
    kept = ["event"] if side else []
    shape = (
        "zone string, pane array<bigint>, next_end array<bigint>, "
        "latest_end array<bigint>, n array<bigint>, first_ms bigint, event_time timestamp"
    )
    return (
        requests.select(
            F.col(key).cast("string").alias("zone"), F.unix_millis(time).alias("t"), *event
        )
        .filter("zone IS NOT NULL AND t IS NOT NULL")
        .select("zone", _checked(t).alias("t"), *kept)
        .select(
            "zone",
            "t",
            align_down(t, pane_ms).alias("pane"),
            next_end(t, cfg).alias("next_end"),
            latest_end(t, cfg).alias("latest_end"),
            *kept,
        )
        .mapInArrow(
            _collapse(bool(side)), f"{shape}, events array<string>" if side else shape
        )
    )


@dataclass
class KeyState:
    """What is kept per key, stored as one row: a read and a write per micro-batch.

    ``panes`` and ``counts`` go together; ``pending`` are the window ends still to
    fire; ``timer`` is the window end the key's one timer stands for.
    """

    panes: list[int] = field(default_factory=list)
    counts: list[int] = field(default_factory=list)
    pending: list[int] = field(default_factory=list)
    average: float | None = None
    first_ms: int | None = None
    emit_seq: int = 0
    timer: int | None = None

    # Same order as the fields.
    SCHEMA: ClassVar[str] = (
        "panes array<bigint>, counts array<bigint>, pending array<bigint>, "
        "average double, first_ms bigint, emit_seq bigint, timer bigint"
    )

    def row(self) -> tuple:
        return tuple(getattr(self, f.name) for f in fields(self))


class WindowProcessor(StatefulProcessor):
    """Fires window ends in order as the watermark passes them.

    A mode says which events are dropped (``_is_too_late``), which window ends an event brings
    about (``_earliest``) and which panes are still needed after a window has fired
    (``_needed_from``). With ``side``, dropped events are returned too.
    """

    def __init__(self, cfg: SurgeConfig, side: bool = False) -> None:
        self.cfg = cfg
        self.side = side
        # The logical watermark is this far ahead of Spark's.
        self.ahead = hold_back_ms(cfg) - SHIFT_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stored = handle.getValueState("key_state", KeyState.SCHEMA)

    def _needed_from(self, end: int) -> int:
        raise NotImplementedError

    def _is_too_late(self, pane: int, latest: int, watermark: int) -> bool:
        raise NotImplementedError

    def _earliest(self, earliest: int, watermark: int) -> int:
        raise NotImplementedError

    def _add(
        self, zone: str, state: KeyState, rows: Iterator[Row], watermark: int | None
    ) -> Iterator[Row]:
        """Count the rows in their panes; what is returned are the events dropped, if asked for."""
        cfg = self.cfg
        panes = dict(zip(state.panes, state.counts))
        pending = set(state.pending)
        for row in rows:
            if state.first_ms is None or row.first_ms < state.first_ms:
                state.first_ms = row.first_ms
            late, at = [], 0
            for pane, earliest, latest, n in zip(row.pane, row.next_end, row.latest_end, row.n):
                at += n
                if watermark is not None:
                    if self._is_too_late(pane, latest, watermark):
                        if self.side:
                            late += row.events[at - n : at]
                        continue
                    earliest = self._earliest(earliest, watermark)
                panes[pane] = panes.get(pane, 0) + n
                pending.update(range(earliest, latest + 1, cfg.slide_ms))
            if late:
                yield too_late(zone, late)
        state.panes = sorted(panes)
        state.counts = [panes[pane] for pane in state.panes]
        state.pending = sorted(pending)

    def _fired(self, *values: Any) -> Row:
        return Row(**fired(*values).asDict(), late=None) if self.side else fired(*values)

    def _load(self) -> KeyState:
        row = self.stored.get()
        if row is None:
            return KeyState()
        lists = [list(values) for values in row[:3]]
        return KeyState(*lists, *row[3:])

    def _fire(self, zone: str, state: KeyState, watermark: int) -> Iterator[Row]:
        """Evaluate the pending windows up to the watermark, in ascending order."""
        cfg = self.cfg
        due = sorted(end for end in state.pending if end <= watermark)
        if not due:
            return
        state.pending = [end for end in state.pending if end > watermark]
        below = [0, *accumulate(state.counts)]
        counts = [
            below[bisect_left(state.panes, end)]
            - below[bisect_left(state.panes, end - cfg.window_ms)]
            for end in due
        ]
        warm_until = state.first_ms + cfg.window_ms
        # The first window of a key has no average to compare with.
        warm = max(bisect_right(due, warm_until), int(state.average is None))
        shown, state.average = fold_counts(counts, warm, state.average, cfg.alpha)
        yield self._fired(zone, due, counts, shown, warm, state.emit_seq)
        state.emit_seq += len(due)
        # Each firing prunes; the last one of an ascending pass prunes the most.
        gone = bisect_left(state.panes, self._needed_from(due[-1]))
        del state.panes[:gone], state.counts[:gone]

    def _save(self, state: KeyState) -> None:
        """Store the state and move the timer to the earliest window still to fire."""
        timer = min(state.pending, default=None)
        if timer != state.timer:
            if state.timer is not None:
                self.handle.deleteTimer(state.timer - self.ahead)
            if timer is not None:
                self.handle.registerTimer(timer - self.ahead)
            state.timer = timer
        self.stored.update(state.row())

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held = timerValues.getCurrentWatermarkInMs()
        # Zero means that there is no watermark yet.
        watermark = held + self.ahead if held > 0 else None
        state = self._load()
        if watermark is not None:
            # Spark runs timers after the rows; windows already due must not see them.
            yield from self._fire(key[0], state, watermark)
        yield from self._add(key[0], state, rows, watermark)
        if watermark is not None:
            # Late rows brought fired windows back.
            yield from self._fire(key[0], state, watermark)
        self._save(state)

    def handleExpiredTimer(
        self, key: Any, timerValues: Any, expiredTimerInfo: Any
    ) -> Iterator[Row]:
        state = self._load()
        # Spark removes this timer itself once it has been handled.
        state.timer = None
        watermark = timerValues.getCurrentWatermarkInMs() + self.ahead
        yield from self._fire(key[0], state, watermark)
        self._save(state)

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        """Go on from a state of ``state_after``."""
        values = [initialState[f.name] for f in fields(KeyState)]
        state = KeyState(*(list(v) if isinstance(v, (list, tuple)) else v for v in values))
        state.timer = None
        self._save(state)

    def close(self) -> None:
        pass


def pending_rows(state: DataFrame, processor: WindowProcessor) -> DataFrame:
    """Evaluations of the windows that stored states still wait with, as if time had ended.

    ``state`` has ``zone`` and the fields of ``KeyState``. Keys are independent, so this is
    one pass over the states where they lie.
    """
    names = [f.name for f in fields(KeyState)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("zone", pa.string()),
                ("window_end_ms", pa.list_(pa.int64())),
                ("request_count", pa.list_(pa.int64())),
                ("ema_baseline", pa.list_(pa.float64())),
                ("warm", pa.int64()),
                ("emit_seq", pa.int64()),
            ]
        )
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                stored = KeyState(*(row[name] for name in names))
                out += [r.asDict() for r in processor._fire(row["zone"], stored, END_OF_TIME)]
            yield pa.RecordBatch.from_pylist(out, schema)

    rows = state.select("zone", *names).mapInArrow(run, FIRED)
    return one_per_window(rows, processor.cfg)


def state_after(
    requests: DataFrame,
    processor: WindowProcessor,
    pane_ms: int,
    delay_ms: int,
    key: str = "zone_id",
    time: str = "event_time",
) -> DataFrame:
    """What a stream would have emitted and kept after a bounded history, one row per key.

    The columns are those of ``one_per_window`` and of ``KeyState``. All of the history counts as
    one micro-batch, after which windows up to ``delay_ms`` behind its newest event fire; events
    older than that are in time. Events are reduced to panes before the shuffle and merged to
    one row per pane after it; a key's panes then pass through one task, as in batch detection.
    """
    cfg = processor.cfg
    rows = collapsed(requests, cfg, pane_ms, key, time)
    newest = rows.agg(F.max(F.unix_millis("event_time")).alias("newest")).first()["newest"]
    watermark = None if newest is None else newest - SHIFT_MS - delay_ms
    each = F.inline(F.arrays_zip("pane", "next_end", "latest_end", "n"))
    panes = (
        rows.select("zone", "first_ms", each)
        .groupBy("zone", "pane", "next_end", "latest_end")
        .agg(F.sum("n").alias("n"), F.min("first_ms").alias("first_ms"))
    )
    names = [f.name for f in fields(KeyState)]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        zone, state = group["zone"].iloc[0], KeyState()
        once = Row(
            first_ms=int(group["first_ms"].min()),
            **{name: group[name].tolist() for name in ("pane", "next_end", "latest_end", "n")},
        )
        list(processor._add(zone, state, iter([once]), None))
        out = list(processor._fire(zone, state, watermark)) or [fired(zone, [], [], [], 0, 0)]
        kept = dict(zip(names, state.row(), strict=True)) | {"next_seq": state.emit_seq}
        del kept["emit_seq"]
        return pd.DataFrame([out[0].asDict() | kept])

    kept = KeyState.SCHEMA.replace("emit_seq", "next_seq")
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FIRED.fields)
    return panes.groupBy("zone").applyInPandas(run, f"{shape}, {kept}")


def states_of(after: DataFrame) -> DataFrame:
    """The states of ``state_after``, for a stream to start from."""
    names = [f.name for f in fields(KeyState)]
    return after.select("zone", *(n if n != "emit_seq" else F.col("next_seq").alias(n) for n in names))
