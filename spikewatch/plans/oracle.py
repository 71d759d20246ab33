"""The same results as plain SQL, for checking the queries of ``catalog``.

Windows are listed per event and counted directly; the moving average is a recursive
query over numbered windows. Nothing is shared with the Spark code but parameters.
"""

from __future__ import annotations

from spikewatch.config import SurgeConfig
from spikewatch.plans.catalog import (
    BY_TYPE,
    BY_USER,
    DAY,
    HOUR,
    LATE,
    PART_S,
    RERUN_FROM,
    SHORT_PART_S,
    SOME_DAYS,
    TUMBLING,
    UNEVEN,
    VERSIONS,
    WEEKLY,
)

# Milliseconds cut off, not rounded.
MS = "(epoch_us(ts) // 1000)"
BY_EVENT_TYPE = f"SELECT event_type AS zone, {MS} AS e FROM events"
BY_USER_ID = f"SELECT CAST(user_id AS VARCHAR) AS zone, {MS} AS e FROM events"


def iso(ms: str) -> str:
    """ISO text of epoch milliseconds; six fraction digits only when there is a fraction."""
    at = f"make_timestamp(({ms}) * 1000)"
    return (
        f"CASE WHEN ({ms}) % 1000 = 0 THEN strftime({at}, '%Y-%m-%dT%H:%M:%SZ') "
        f"ELSE strftime({at}, '%Y-%m-%dT%H:%M:%S.%fZ') END"
    )


def floor_to(ms: str, step: int) -> str:
    return f"CAST(floor(({ms}) / {step}.0) AS BIGINT) * {step}"


def counted(source: str, cfg: SurgeConfig, p: str = "") -> str:
    """CTEs up to ``{p}win(zone, t, c, first_e)``."""
    w, s = cfg.window_ms, cfg.slide_ms
    return f"""
{p}ev AS ({source}),
{p}ends AS (
  SELECT zone, e, unnest(range({floor_to('e', s)} + {s}, {floor_to(f'e + {w}', s)} + 1, {s})) AS t
  FROM {p}ev),
{p}win AS (
  SELECT zone, t, count(*) AS c, min(e) AS first_e FROM {p}ends
  GROUP BY zone, t HAVING {w} = {s} OR max(e) > t - {w})"""


def evaluated(source: str, cfg: SurgeConfig, p: str = "") -> str:
    """CTEs up to ``{p}out(zone, t, c, base, status)``; needs WITH RECURSIVE."""
    w = cfg.window_ms
    a, keep = f"CAST({cfg.alpha!r} AS DOUBLE)", f"CAST({1 - cfg.alpha!r} AS DOUBLE)"
    thr = f"CAST({float(cfg.surge_threshold)!r} AS DOUBLE)"
    return f"""{counted(source, cfg, p)},
{p}num AS (
  SELECT zone, t, CAST(c AS DOUBLE) AS c, row_number() OVER (PARTITION BY zone ORDER BY t) AS rn,
    t <= min(first_e) OVER (PARTITION BY zone) + {w} AS warm
  FROM {p}win),
{p}ema AS (
  SELECT zone, rn, t, c, warm, c AS base, c AS avg_after FROM {p}num WHERE rn = 1
  UNION ALL
  SELECT n.zone, n.rn, n.t, n.c, n.warm, CASE WHEN n.warm THEN n.c ELSE m.avg_after END,
    CASE WHEN n.warm THEN n.c ELSE {a} * n.c + {keep} * m.avg_after END
  FROM {p}ema m JOIN {p}num n ON n.zone = m.zone AND n.rn = m.rn + 1),
{p}out AS (
  SELECT zone, t, CAST(c AS BIGINT) AS c, base, CASE WHEN warm THEN 'INITIALIZING'
    WHEN c > {thr} * base THEN 'SURGE_ALERT' ELSE 'NORMAL' END AS status
  FROM {p}ema)"""


def detection(source: str, cfg: SurgeConfig) -> str:
    return f"""WITH RECURSIVE {evaluated(source, cfg)}
SELECT zone, {iso('t')} AS window_end, c AS request_count, round(base, 6) AS ema_baseline, status
FROM out"""


def window_rows(source: str, cfg: SurgeConfig) -> str:
    return f"""WITH {counted(source, cfg)}
SELECT zone, {iso('t')} AS window_end, c AS request_count, {iso('first_e')} AS first_event FROM win"""


def table_dates(table: str, zone: str, date: str) -> str:
    return f"SELECT {zone} AS zone, epoch_ms({date}) AS e FROM {table}"


# Ingest.


def _line(*parts: str) -> str:
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


RIDE = """'"ride_id":"ride-' || event_id || '"'"""
ZONE = """'"zone_id":"' || event_type || '"'"""
TIME = f"""'"timestamp":"' || ({iso(MS)}) || '"'"""
SOON = """'"timestamp":"soon"'"""
FLAG = """'"is_simulated_late":' || CASE event_id % 11 WHEN 0 THEN 'true' WHEN 1 THEN '0' ELSE 'false' END"""
MILLIS = f"""'"event_time_millis":' || {MS}"""

LINES = f"""
lines AS (
  SELECT CASE WHEN event_id % 97 <> 0 THEN
      CASE WHEN event_id % 5 = 0 THEN {_line(RIDE, ZONE, TIME, MILLIS, FLAG)}
      ELSE {_line(RIDE, ZONE, TIME, FLAG)} END
    ELSE CASE (event_id // 97) % 18
      WHEN 0 THEN '{{' || {RIDE} || ',' || {ZONE}
      WHEN 1 THEN {_line(RIDE, TIME, FLAG)}
      WHEN 2 THEN {_line(RIDE, ZONE, SOON, FLAG)}
      WHEN 3 THEN {_line(RIDE, ZONE, TIME, "'" + '"is_simulated_late":"false"' + "'")}
      WHEN 4 THEN {_line(RIDE, ZONE, TIME, "'" + '"event_time_millis":12.7' + "'", FLAG)}
      WHEN 5 THEN '   '
      WHEN 6 THEN {_line(ZONE, FLAG)}
      WHEN 7 THEN {_line(RIDE, ZONE, TIME)} || {_line(RIDE, ZONE, TIME)}
      WHEN 8 THEN {_line(RIDE, ZONE, TIME)}
      WHEN 9 THEN {_line(RIDE, ZONE, TIME)} || '{{"ride_id":"r2","zone_id":"z","times'
      WHEN 10 THEN {_line(RIDE, ZONE, TIME)} || '{{'
      WHEN 11 THEN {_line(RIDE, ZONE, TIME)} || ' {{{{{{ junk'
      WHEN 12 THEN repeat('{{"a":', 9) || '1' || repeat('}}', 9) || ' trailing'
      WHEN 13 THEN {_line(RIDE, ZONE, "'" + '"timestamp":"12:30"' + "'", FLAG)}
      WHEN 14 THEN {_line(RIDE, ZONE, "'" + '"timestamp":"2024"' + "'", FLAG)}
      WHEN 15 THEN {_line(RIDE, ZONE, "'" + '"timestamp":"2024-01-05T10:00:00 America/New_York"' + "'")}
      WHEN 16 THEN {_line(RIDE, ZONE, "'" + '"timestamp":"9999-12-31T00:00:00Z"' + "'", FLAG)}
      ELSE {_line(RIDE, ZONE, SOON, MILLIS)} END END AS value
  FROM events)"""

REQUESTS = f"""{LINES},
shaped AS (
  SELECT value, json_valid(value) AS ok, CASE WHEN json_valid(value) THEN value ELSE '{{}}' END AS j
  FROM lines WHERE trim(value) <> ''),
fields AS (
  SELECT value, ok, json_extract_string(j, '$.ride_id') AS ride_id,
    json_extract_string(j, '$.zone_id') AS zone_id,
    json_extract_string(j, '$.timestamp') AS "timestamp",
    CASE WHEN json_extract_string(j, '$.event_time_millis') IS NOT NULL
      THEN CAST(trunc(CAST(json_extract_string(j, '$.event_time_millis') AS DOUBLE)) AS BIGINT)
      -- The cast alone would take the names of zones.
      WHEN contains(json_extract_string(j, '$.timestamp'), '/') THEN NULL
      ELSE epoch_ms(TRY_CAST(replace(json_extract_string(j, '$.timestamp'), 'Z', '') AS TIMESTAMP))
      END AS event_time_millis,
    coalesce(CASE json_type(j, '$.is_simulated_late')
      WHEN 'BOOLEAN' THEN json_extract_string(j, '$.is_simulated_late') = 'true'
      WHEN 'VARCHAR' THEN length(json_extract_string(j, '$.is_simulated_late')) > 0
      ELSE CAST(json_extract_string(j, '$.is_simulated_late') AS DOUBLE) <> 0 END,
      false) AS is_simulated_late
  FROM shaped),
absent AS (
  SELECT *, concat_ws(', ', CASE WHEN ride_id IS NULL THEN 'ride_id' END,
    CASE WHEN "timestamp" IS NULL THEN 'timestamp' END,
    CASE WHEN zone_id IS NULL THEN 'zone_id' END) AS names FROM fields),
parsed AS (
  SELECT *, CASE WHEN NOT ok THEN 'Malformed JSON'
    WHEN names <> '' THEN 'Missing required event fields: ' || names
    WHEN event_time_millis IS NULL THEN 'Unreadable event time'
    WHEN event_time_millis < epoch_ms(TIMESTAMP '1000-01-01')
      OR event_time_millis >= epoch_ms(TIMESTAMP '3000-01-01')
      THEN 'Event time outside the years 1000 to 2999' END AS reject_reason FROM absent)"""

# Alerts and their log.

CENTS = "round(base, 2)"
CENTS_TEXT = f"regexp_replace(CAST(CAST({CENTS} AS DECIMAL(38, 2)) AS VARCHAR), '0$', '')"


def alert_text(zone: str = "zone") -> str:
    return (
        f"""'{{"ema_baseline":' || {CENTS_TEXT} || ',"request_count":' || c || ',"status":"' """
        f"""|| status || '","timestamp":"' || ({iso('t')}) || '","zone":"' || {zone} || '"}}'"""
    )


_WAY = f"(t // {BY_TYPE.slide_ms}) % 12"
_COUNT = "'\"request_count\":' || c"
DAMAGED_LOG = f"""{evaluated(BY_EVENT_TYPE, BY_TYPE)},
good AS (SELECT *, {alert_text()} AS line FROM out),
damaged AS (
  SELECT zone, t, CASE {_WAY}
    WHEN 0 THEN '   '
    WHEN 1 THEN 'not json'
    WHEN 2 THEN replace(line, '"zone"', '"area"')
    WHEN 3 THEN replace(line, '"timestamp":"2024', '"timestamp":"none')
    WHEN 4 THEN replace(line, {_COUNT}, '"request_count":"' || c || '"')
    WHEN 5 THEN replace(line, {_COUNT}, {_COUNT} || '.75')
    WHEN 6 THEN replace(line, {_COUNT}, '"request_count":"' || c || '.5"')
    WHEN 7 THEN line || substring(line, 1, 40)
    WHEN 8 THEN line || ' {{{{{{ junk'
    ELSE line END AS value FROM good),
log AS (
  SELECT *, json_valid(value) AS ok, CASE WHEN json_valid(value) THEN value ELSE '{{}}' END AS j
  FROM damaged WHERE trim(value) <> ''),
fields AS (
  SELECT zone AS z, t, ok, json_extract_string(j, '$.zone') AS zone,
    TRY_CAST(replace(json_extract_string(j, '$.timestamp'), 'Z', '') AS TIMESTAMP) AS ts,
    CASE WHEN json_type(j, '$.request_count') = 'VARCHAR'
      THEN CASE WHEN regexp_full_match(json_extract_string(j, '$.request_count'), '[0-9]+')
        THEN CAST(json_extract_string(j, '$.request_count') AS BIGINT) END
      ELSE CAST(trunc(CAST(json_extract_string(j, '$.request_count') AS DOUBLE)) AS BIGINT)
      END AS request_count,
    CAST(json_extract_string(j, '$.ema_baseline') AS DOUBLE) AS ema_baseline,
    json_extract_string(j, '$.status') AS status
  FROM log),
parsed AS (
  SELECT *, CASE WHEN NOT ok THEN 'Malformed JSON'
    WHEN zone IS NULL THEN 'Missing required fields: zone'
    WHEN request_count IS NULL THEN 'Unreadable number: request_count' END AS error
  FROM fields)"""

# Reports.

LATER = f"{BY_EVENT_TYPE} WHERE ts >= TIMESTAMP '{RERUN_FROM.replace('T', ' ').replace('Z', '')}'"
REPORT_LOG = f"""{evaluated(BY_EVENT_TYPE, BY_TYPE, 'a_')},{evaluated(LATER, BY_TYPE, 'b_')},
log AS (
  SELECT 'north_' || zone AS zone, t, c, {CENTS} AS base, status, CAST(0 AS BIGINT) AS batch
  FROM a_out UNION ALL
  SELECT 'north_' || zone, t, c, {CENTS}, status, CAST(1 AS BIGINT) FROM b_out),
last_rows AS (
  SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY t, zone ORDER BY batch DESC) = 1),
display AS (
  SELECT *, replace(zone, '_', ' ') AS label, t - {BY_TYPE.window_ms} AS start_t,
    CASE WHEN base > 0 THEN c / base END AS ratio, c - base AS delta,
    CASE status WHEN 'SURGE_ALERT' THEN 0 WHEN 'INITIALIZING' THEN 1 WHEN 'NORMAL' THEN 2
      ELSE 3 END AS rank
  FROM last_rows),
latest AS (
  SELECT * FROM display QUALIFY row_number() OVER (PARTITION BY zone ORDER BY t DESC, batch DESC) = 1)"""
ROW = f"zone, {iso('t')} AS window_end, c AS request_count, base AS ema_baseline, status"


def reported(select: str) -> str:
    return f"WITH RECURSIVE {REPORT_LOG}\n{select}"


def to_digits(x: str, digits: int) -> str:
    return f"CAST(round_even({x} * {10**digits}.0::DOUBLE, 0) AS DOUBLE) / {10**digits}.0::DOUBLE"


def text_time(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%d %H:%M:%S')"


# Arrivals.

ARRIVALS = f"""
late AS (
  SELECT *, {MS} AS e, CASE WHEN event_id % 50 = 7 THEN {12 * HOUR}
    WHEN event_id % 20 = 3 THEN {5 * HOUR} WHEN event_id % 7 = 2 THEN {20 * 60} ELSE 0 END AS d
  FROM events),
arrived AS (
  SELECT event_id, event_type AS zone, e, d > 0 AS flag, e // 1000 + d AS arrival FROM late),
seen AS (
  SELECT *, max(e) OVER (ORDER BY arrival RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    AS newest FROM arrived),
audited AS (
  SELECT *, newest - {LATE.watermark_ms} AS wm, greatest(0, coalesce(newest - e, 0)) AS lag,
    CASE WHEN newest - {LATE.watermark_ms} > greatest({floor_to('e', LATE.slide_ms)}
        + {LATE.slide_ms}, {floor_to(f'e + {LATE.window_ms - 1}', LATE.slide_ms)})
        + {LATE.lateness_ms} THEN 'dropped'
      WHEN {floor_to('e', LATE.slide_ms)} + {LATE.slide_ms} <= newest - {LATE.watermark_ms}
        THEN 'late_refire'
      WHEN e < newest THEN 'out_of_order' ELSE 'on_time' END AS class FROM seen)"""

SCHEDULE = f"""
timed AS (
  SELECT event_id, event_type AS zone, {MS} % {DAY * 1000} AS cycle_ms FROM events),
hourly AS (
  SELECT zone, cycle_ms // {HOUR * 1000} AS h, count(*) AS n FROM timed GROUP BY ALL),
mean AS (SELECT zone, CAST(floor(sum(n) / 24) AS BIGINT) AS m FROM hourly GROUP BY zone),
entries AS (
  SELECT h.zone, h * {HOUR} AS start_s, (h + 2) * {HOUR} AS end_s, n - m AS extra
  FROM hourly h JOIN mean USING (zone) WHERE n > m),
loads AS (
  SELECT t.event_id, t.zone, t.cycle_ms, CAST(coalesce(sum(x.extra), 0) AS BIGINT) AS extra
  FROM timed t LEFT JOIN entries x ON x.zone = t.zone AND t.cycle_ms >= x.start_s * 1000
    AND t.cycle_ms < x.end_s * 1000 GROUP BY ALL)"""

# Streams: what is closed once the whole table, in time order, has been read in one go.


def closed(delay_ms: int) -> str:
    return f"""WITH RECURSIVE {evaluated(BY_EVENT_TYPE, LATE)}
SELECT zone, {iso('t')} AS window_end, c AS request_count, {CENTS} AS ema_baseline, status,
  row_number() OVER (PARTITION BY zone ORDER BY t) - 1 AS emit_seq
FROM out WHERE t <= (SELECT max({MS}) FROM events) - {delay_ms}"""


# Replays in parts. A part's rows are judged by the watermark of the parts before it; when the
# part is through, windows up to its own watermark fire.


def _parts(delay_ms: int, part_s: int = PART_S) -> str:
    """CTEs up to ``judged(zone, e, p, wm, next_t, last_t)`` and ``marks(p, wm, before)``."""
    w, s = LATE.window_ms, LATE.slide_ms
    return f"""{ARRIVALS},
parted AS (SELECT event_id, flag, zone, e, arrival // {part_s} AS p FROM arrived),
newest AS (SELECT p, max(max(e)) OVER (ORDER BY p) - {delay_ms} AS wm FROM parted GROUP BY p),
marks AS (SELECT p, wm, lag(wm) OVER (ORDER BY p) AS before FROM newest),
judged AS (
  SELECT event_id, flag, zone, e, p, m.before AS wm, {floor_to('e', s)} + {s} AS next_t,
    greatest({floor_to('e', s)} + {s}, {floor_to(f'e + {w - 1}', s)}) AS last_t
  FROM parted JOIN marks m USING (p)),
firsts AS (SELECT zone, p, min(min(e)) OVER (PARTITION BY zone ORDER BY p) AS first_e
  FROM judged GROUP BY zone, p)"""


def _averaged(order: str) -> str:
    """CTEs from ``counted(zone, t, c, p, ...)`` to the rows of a log, in firing order."""
    a, keep = f"CAST({LATE.alpha!r} AS DOUBLE)", f"CAST({1 - LATE.alpha!r} AS DOUBLE)"
    thr = f"CAST({float(LATE.surge_threshold)!r} AS DOUBLE)"
    return f"""num AS (
  SELECT zone, t, CAST(c AS DOUBLE) AS c, row_number() OVER (PARTITION BY zone ORDER BY {order}) AS rn,
    t <= (SELECT min(first_e) FROM firsts f WHERE f.zone = counted.zone AND f.p <= counted.p)
      + {LATE.window_ms} AS warm
  FROM counted),
ema AS (
  SELECT zone, rn, t, c, true AS warm, c AS base, c AS avg_after FROM num WHERE rn = 1
  UNION ALL
  SELECT n.zone, n.rn, n.t, n.c, n.warm, CASE WHEN n.warm THEN n.c ELSE m.avg_after END,
    CASE WHEN n.warm THEN n.c ELSE {a} * n.c + {keep} * m.avg_after END
  FROM ema m JOIN num n ON n.zone = m.zone AND n.rn = m.rn + 1)
SELECT zone, {iso('t')} AS window_end, CAST(c AS BIGINT) AS request_count,
  {CENTS} AS ema_baseline, CASE WHEN warm THEN 'INITIALIZING'
    WHEN c > {thr} * base THEN 'SURGE_ALERT' ELSE 'NORMAL' END AS status, rn - 1 AS emit_seq
FROM ema"""


def replay_final() -> str:
    w, s = LATE.window_ms, LATE.slide_ms
    return f"""WITH RECURSIVE {_parts(LATE.watermark_ms + LATE.lateness_ms)},
held AS (SELECT *, unnest(range(next_t, {floor_to(f'e + {w}', s)} + 1, {s})) AS t FROM judged),
win AS (
  SELECT zone, t, count(*) AS c FROM held WHERE wm IS NULL OR t > wm
  GROUP BY zone, t HAVING {w} = {s} OR max(e) > t - {w}),
counted AS (
  SELECT zone, t, c, (SELECT min(p) FROM marks m WHERE m.wm >= win.t) AS p FROM win
  WHERE t <= (SELECT max(wm) FROM marks)),
{_averaged('t')}"""


def replay_refire(part_s: int = PART_S) -> str:
    """Passes are numbered ``2 p`` for late rows' windows and ``2 p + 1`` for the new ones."""
    w, s, late = LATE.window_ms, LATE.slide_ms, LATE.lateness_ms
    return f"""WITH RECURSIVE {_parts(LATE.watermark_ms, part_s)},
admitted AS (SELECT * FROM judged WHERE wm IS NULL OR wm <= last_t + {late}),
caused AS (SELECT zone, p, wm, unnest(range(next_t, last_t + 1, {s})) AS t FROM admitted),
fired AS (
  SELECT DISTINCT zone, t, p, 2 * p AS pass FROM caused WHERE t <= wm
  UNION ALL
  SELECT zone, t, p, 2 * p + 1 FROM (
    SELECT c.zone, c.t, (SELECT min(m.p) FROM marks m WHERE m.wm >= c.t) AS p
    FROM (SELECT DISTINCT zone, t FROM caused WHERE wm IS NULL OR t > wm) c)
  WHERE p IS NOT NULL),
pruned AS (SELECT zone, pass, max(t) - {w} - {late} AS below FROM fired GROUP BY zone, pass),
met AS (
  SELECT f.zone, f.t, f.p, f.pass, a.e FROM fired f JOIN admitted a
    ON a.zone = f.zone AND a.p <= f.p AND a.e >= f.t - {w} AND a.e < f.t
  WHERE NOT EXISTS (SELECT 1 FROM pruned x WHERE x.zone = f.zone AND x.pass >= 2 * a.p
    AND x.pass < f.pass AND a.e < x.below)),
tallied AS (SELECT zone, t, pass, count(*) AS c FROM met GROUP BY zone, t, pass),
counted AS (
  SELECT f.zone, f.t, f.p, f.pass, coalesce(x.c, 0) AS c FROM fired f
  LEFT JOIN tallied x ON x.zone = f.zone AND x.t = f.t AND x.pass = f.pass),
{_averaged('pass, t')}"""


def dropped(delay_ms: int, too_late: str) -> str:
    """Lines of the events of a replay for which ``too_late`` holds."""
    return f"""WITH {_parts(delay_ms, SHORT_PART_S)}
SELECT 'LATE_EVENT | zone=' || zone || ' | ride_id=' || event_id || ' | timestamp=' || ({iso('e')})
  || ' | is_simulated_late=' || flag AS value FROM judged WHERE {too_late}"""


def standing(select: str) -> str:
    """A report over the last evaluations ``last_rows`` of a replay and each zone's ``latest``."""
    return f"""WITH fired AS ({replay_refire(SHORT_PART_S)}),
last_rows AS (
  SELECT * FROM fired
  QUALIFY row_number() OVER (PARTITION BY zone, window_end ORDER BY emit_seq DESC) = 1),
latest AS (
  SELECT *, replace(zone, '_', ' ') AS label, request_count / ema_baseline AS ratio FROM last_rows
  QUALIFY row_number() OVER (PARTITION BY zone ORDER BY window_end DESC) = 1)
{select}"""


SQL: dict[str, str] = {
    "detect_by_event_type": detection(BY_EVENT_TYPE, BY_TYPE),
    "detect_by_user": detection(BY_USER_ID, BY_USER),
    "detect_tumbling": detection(BY_USER_ID, TUMBLING),
    "detect_uneven_slide": detection(BY_EVENT_TYPE, UNEVEN),
    "detect_orders": detection(table_dates("orders", "o_orderpriority", "o_orderdate"), WEEKLY),
    "detect_shipments": detection(table_dates("lineitem", "l_returnflag", "l_shipdate"), WEEKLY),
    "detect_long_history": detection(
        table_dates("lineitem", "l_returnflag", "l_shipdate"), WEEKLY
    ),
    "detect_from_lines": f"""WITH RECURSIVE {REQUESTS},
{evaluated("SELECT zone_id AS zone, event_time_millis AS e FROM parsed "
           "WHERE reject_reason IS NULL", BY_TYPE)}
SELECT zone, {iso('t')} AS window_end, c AS request_count, round(base, 6) AS ema_baseline, status
FROM out""",
    "window_counts_by_panes": window_rows(BY_USER_ID, UNEVEN),
    "window_counts_by_window": window_rows(BY_USER_ID, UNEVEN),
    "window_assignment": f"""WITH ev AS (SELECT event_id, {MS} AS e FROM events),
ends AS (
  SELECT event_id, {floor_to('e', UNEVEN.slide_ms)} + {UNEVEN.slide_ms} AS a,
    {floor_to(f'e + {UNEVEN.window_ms - 1}', UNEVEN.slide_ms)} AS b FROM ev)
SELECT event_id, {iso('a')} AS first_end, {iso('greatest(a, b)')} AS last_end FROM ends""",
    "requests_accepted": f"""WITH {REQUESTS}
SELECT ride_id, zone_id, "timestamp", event_time_millis, is_simulated_late
FROM parsed WHERE reject_reason IS NULL""",
    "requests_rejected": f"""WITH {REQUESTS}
SELECT value, reject_reason FROM parsed WHERE reject_reason IS NOT NULL""",
    "requests_reject_counts": f"""WITH {REQUESTS}
SELECT reject_reason, count(*) AS lines FROM parsed GROUP BY reject_reason""",
    "requests_failfast": f"""SELECT CAST(event_id AS VARCHAR) AS ride_id, event_type AS zone_id,
  {iso(MS)} AS "timestamp", {MS} AS event_time_millis,
  false AS is_simulated_late FROM events""",
    "requests_as_json": f"""WITH {REQUESTS}
SELECT '{{"event_time_millis":' || event_time_millis || ',"is_simulated_late":' || is_simulated_late
  || ',"ride_id":"' || ride_id || '","timestamp":"' || "timestamp" || '","zone_id":"' || zone_id
  || '"}}' AS value FROM parsed WHERE reject_reason IS NULL""",
    "alert_lines": f"""WITH RECURSIVE {evaluated(BY_EVENT_TYPE, BY_TYPE)}
SELECT {alert_text()} AS value FROM out""",
    "alert_log_roundtrip": f"""WITH RECURSIVE {evaluated(BY_USER_ID, BY_USER)}
SELECT {iso('t')} AS window_end, zone, c AS request_count, {CENTS} AS ema_baseline, status
FROM out""",
    "log_rows": f"""WITH RECURSIVE {DAMAGED_LOG}
SELECT {iso(MS)} AS window_end, zone, request_count, ema_baseline, status
FROM parsed WHERE error IS NULL AND ts IS NOT NULL""",
    "log_quality_counts": f"""WITH RECURSIVE {DAMAGED_LOG},
quality AS (
  SELECT count(*) FILTER (error IS NULL) AS valid_lines,
    count(*) FILTER (error IS NOT NULL) AS malformed_lines,
    (SELECT error FROM parsed WHERE error IS NOT NULL ORDER BY t DESC, z DESC LIMIT 1) AS last_error
  FROM parsed)
SELECT *, CASE WHEN valid_lines = 0 THEN 'alerts has no valid rows yet.'
  WHEN malformed_lines = 0 THEN 'Live stream connected.'
  ELSE 'Live stream connected. Skipped ' || malformed_lines || ' malformed line(s). Last parse issue: '
    || last_error END AS message FROM quality""",
    "log_source_status": f"""WITH RECURSIVE {DAMAGED_LOG},
usable AS (SELECT * FROM parsed WHERE error IS NULL AND ts IS NOT NULL)
SELECT CASE WHEN (SELECT count(*) FROM usable) > 0 THEN 'LIVE' ELSE 'WAITING' END AS label,
  (SELECT count(*) FROM usable) AS rows_loaded,
  (SELECT count(*) FROM (SELECT DISTINCT ts, zone FROM usable)) AS snapshots_shown,
  coalesce((SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') || ' UTC' FROM usable), 'n/a')
    AS latest_window_end,
  (SELECT count(*) FROM parsed WHERE error IS NOT NULL) AS malformed_lines""",
    "report_ordered_log": reported(f"SELECT {ROW}, batch AS emit_batch FROM log ORDER BY t, batch"),
    "report_last_evaluations": reported(f"SELECT {ROW}, batch AS emit_batch FROM last_rows"),
    "report_display_rows": reported(
        f"""SELECT {ROW}, batch AS emit_batch, {iso('start_t')} AS window_start,
  round(ratio, 6) AS pressure_ratio, round(delta, 6) AS pressure_delta, label AS zone_label,
  CAST(rank AS BIGINT) AS status_rank FROM display"""
    ),
    "report_latest_by_zone": reported(f"SELECT {ROW}, batch AS emit_batch FROM latest"),
    "report_zone_status": reported(
        f"""SELECT label AS "Zone", c AS "Requests", {to_digits('base', 1)} AS "Baseline",
  {to_digits('ratio', 2)} AS "Pressure", status AS "Status" FROM latest"""
    ),
    "report_recent": reported(
        f"""SELECT {text_time('start_t')} AS "Window Start", {text_time('t')} AS "Window End",
  label AS "Zone", c AS "Requests", {to_digits('base', 1)} AS "Baseline",
  {to_digits('ratio', 2)} AS "Pressure", status AS "Status"
FROM (SELECT * FROM display ORDER BY t DESC, batch DESC, zone DESC LIMIT 20)"""
    ),
    "report_surge_counts": reported(
        "SELECT label AS zone, count(*) AS surge_alerts FROM display "
        "WHERE status = 'SURGE_ALERT' GROUP BY label"
    ),
    "report_summary": reported(
        """SELECT (SELECT count(*) FROM display) AS window_snapshots,
  (SELECT count(*) FROM latest WHERE status = 'SURGE_ALERT') AS active_zone_surges,
  (SELECT count(*) FROM display WHERE status = 'SURGE_ALERT') AS surge_alerts,
  (SELECT coalesce(max(c), 0) FROM display) AS peak_request_count"""
    ),
    "report_current_against_baseline": reported(
        """SELECT label AS zone, 'Current Requests' AS "Series", CAST(c AS DOUBLE) AS "Value"
FROM latest UNION ALL SELECT label, 'EMA Baseline', base FROM latest"""
    ),
    "report_trend": reported(
        f"""SELECT {iso('t')} AS window_end, label AS zone_label, c AS request_count,
  base AS ema_baseline, status, batch AS emit_batch FROM display"""
    ),
    "report_surge_points": reported(
        f"""SELECT {iso('t')} AS window_end, label AS zone_label, c AS request_count,
  base AS ema_baseline, status, batch AS emit_batch FROM display WHERE status = 'SURGE_ALERT'"""
    ),
    "report_zones_by_appearance": reported(
        f"""SELECT label AS zone_label, batch AS first_batch, {iso('t')} AS first_window_end
FROM display QUALIFY row_number() OVER (PARTITION BY label ORDER BY batch, t) = 1"""
    ),
    "arrival_audit": f"""WITH {ARRIVALS}
SELECT CAST(event_id AS VARCHAR) AS ride_id, arrival, wm AS watermark_ms, lag AS lag_ms,
  class AS arrival_class FROM audited""",
    "arrival_summary": f"""WITH {ARRIVALS}
SELECT zone, class AS arrival_class, count(*) AS events, max(lag) AS max_lag_ms,
  round(avg(CAST(flag AS INT)), 6) AS flagged_share FROM audited GROUP BY zone, class""",
    "late_event_lines": f"""WITH {ARRIVALS}
SELECT 'LATE_EVENT | zone=' || zone || ' | ride_id=' || event_id || ' | timestamp=' || ({iso('e')})
  || ' | is_simulated_late=' || flag AS value FROM audited WHERE class = 'dropped'""",
    "schedule_annotation": f"""WITH {SCHEDULE}
SELECT event_id, zone AS zone_id, cycle_ms, extra, 1 + extra AS expected_load FROM loads""",
    "schedule_versions": f"""WITH timed AS (
  SELECT event_id, event_type AS zone, {MS} AS e, {MS} % {DAY * 1000} AS cycle_ms FROM events),
versions AS (
  SELECT v, lead(v) OVER (ORDER BY v) AS until
  FROM unnest([{', '.join(str(int(t.timestamp() * 1000)) for t in VERSIONS)}]) AS x(v)),
dated AS (SELECT t.*, v FROM timed t LEFT JOIN versions ON e >= v AND (until IS NULL OR e < until)),
hourly AS (
  SELECT zone, v, cycle_ms // {HOUR * 1000} AS h, count(*) AS n FROM dated WHERE v IS NOT NULL
  GROUP BY ALL),
mean AS (SELECT zone, v, CAST(floor(sum(n) / 24) AS BIGINT) AS m FROM hourly GROUP BY zone, v),
entries AS (
  SELECT h.zone, h.v, h * {HOUR * 1000} AS a, least(h + 2, 24) * {HOUR * 1000} AS b, n - m AS extra
  FROM hourly h JOIN mean USING (zone, v) WHERE n > m)
SELECT event_id, d.zone AS zone_id, cycle_ms, CAST(coalesce(sum(x.extra), 0) AS BIGINT) AS extra,
  CAST(1 + coalesce(sum(x.extra), 0) AS BIGINT) AS expected_load
FROM dated d LEFT JOIN entries x ON x.zone = d.zone AND x.v = d.v AND cycle_ms >= a AND cycle_ms < b
GROUP BY ALL""",
    "stream_after_history": closed(-(10**15)),
    "stream_final": closed(LATE.watermark_ms + LATE.lateness_ms),
    "stream_refire": closed(LATE.watermark_ms),
    "stream_final_flush": closed(-(10**15)),
    "stream_refire_flush": closed(-(10**15)),
    "stream_refire_late": replay_refire(),
    "stream_final_late": replay_final(),
    "stream_refire_dropped": dropped(LATE.watermark_ms, f"wm > last_t + {LATE.lateness_ms}"),
    # The last end that the event's pane reaches has passed.
    "stream_final_dropped": dropped(
        LATE.watermark_ms + LATE.lateness_ms,
        floor_to(f"({floor_to('e', LATE.pane_ms)} + {LATE.window_ms})", LATE.slide_ms) + " <= wm",
    ),
    "stream_log_order": replay_refire(),
    "stream_arrival_audit": f"""WITH {_parts(LATE.watermark_ms)},
numbered AS (SELECT p, row_number() OVER (ORDER BY p) - 1 AS arrival FROM marks)
SELECT CAST(event_id AS VARCHAR) AS ride_id, arrival, wm AS watermark_ms,
  greatest(0, coalesce(wm + {LATE.watermark_ms} - e, 0)) AS lag_ms,
  CASE WHEN wm > last_t + {LATE.lateness_ms} THEN 'dropped' WHEN next_t <= wm THEN 'late_refire'
    WHEN e < wm + {LATE.watermark_ms} THEN 'out_of_order' ELSE 'on_time' END AS arrival_class
FROM judged JOIN numbered USING (p)""",
    "log_some_days": f"""WITH RECURSIVE {evaluated(BY_USER_ID, BY_USER)}
SELECT {iso('t')} AS window_end, zone, c AS request_count, {CENTS} AS ema_baseline, status
FROM out WHERE t >= {int(SOME_DAYS[0].timestamp() * 1000)} AND t < {int(SOME_DAYS[1].timestamp() * 1000)}""",
    "standing_rows": standing("SELECT * FROM last_rows"),
    "standing_summary": standing(
        """SELECT (SELECT count(*) FROM last_rows) AS window_snapshots,
  (SELECT count(*) FROM latest WHERE status = 'SURGE_ALERT') AS active_zone_surges,
  (SELECT count(*) FROM last_rows WHERE status = 'SURGE_ALERT') AS surge_alerts,
  (SELECT coalesce(max(request_count), 0) FROM last_rows) AS peak_request_count"""
    ),
    "standing_zone_status": standing(
        f"""SELECT label AS "Zone", request_count AS "Requests",
  {to_digits('ema_baseline', 1)} AS "Baseline", {to_digits('ratio', 2)} AS "Pressure",
  status AS "Status" FROM latest"""
    ),
    "standing_surge_counts": standing(
        "SELECT replace(zone, '_', ' ') AS zone, count(*) AS surge_alerts FROM last_rows "
        "WHERE status = 'SURGE_ALERT' GROUP BY 1"
    ),
}
