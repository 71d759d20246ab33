"""The queries that SQL can express, for checking them with DuckDB.

Windows, shingles and lines are listed and counted directly; nothing is hashed, bucketed or
sampled. Only parameters are shared with the operators.
"""

from __future__ import annotations

from spikewatch.llm import host_reputation as hosts
from spikewatch.llm import quality_rules as rules
from spikewatch.llm import substrings
from spikewatch.llm.jaccard_forest import SHINGLE

GAP = r"'[\x20\x09-\x0D]+'"
WORD = r"'[^\x20\x09-\x0D]'"
# Every row for itself, as numbers may repeat.
WORDS = f"""
docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT r, doc_id, t, list_filter(string_split_regex(t, {GAP}), lambda x: x <> '') AS w FROM docs)"""


def text_list(values: tuple[str, ...] | str) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


SUBSTRINGS = f"""WITH {WORDS},
windows AS (
  SELECT r, unnest(range(1, len(w) - {substrings.WINDOW - 2})) AS i, w FROM words),
hits AS (
  SELECT r, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY array_to_string(w[i:i + {substrings.WINDOW - 1}], ' ')) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {substrings.WINDOW})) AS i FROM hits),
each_word AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM words),
cut AS (
  SELECT e.r, count(g.i) AS n_removed,
    string_agg(e.word, ' ' ORDER BY e.i) FILTER (WHERE g.i IS NULL) AS kept
  FROM each_word e LEFT JOIN gone g ON g.r = e.r AND g.i = e.i GROUP BY e.r)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN cut USING (r)"""

QUALITY = f"""WITH {WORDS},
each_line AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs),
spaced AS (
  SELECT r, line, trim(regexp_replace(line, '[\\x09-\\x0D]', ' ', 'g')) AS s,
    len(list_filter(string_split_regex(line, {GAP}), lambda x: x <> '')) AS n FROM each_line),
judged AS (
  SELECT r, line, n, n = 0 OR (
    (right(s, 1) IN ({text_list(rules.LINE_ENDS)})
      OR {" OR ".join(f"contains(s, '{mark}')" for mark in rules.SENTENCE_ENDS)})
    AND NOT (length(s) - length(replace(s, '|', ''))) * 5 >= n
    AND NOT (length(s) - length(replace(s, '!', ''))) * 3 > n
    AND NOT (length(s) - length(regexp_replace(s, '{rules.THICK}', '', 'g'))) * 10
      > length(replace(s, ' ', ''))
    AND NOT (n <= {rules.SHORT_LINE} AND regexp_matches(lower(s), '{rules.FURNITURE}'))) AS ok
  FROM spaced),
by_line AS (
  SELECT r, coalesce(sum(n) FILTER (WHERE NOT ok), 0) AS n_lost_words,
    count(*) FILTER (WHERE n > 0) - count(DISTINCT line) FILTER (WHERE n > 0) AS n_dup_lines
  FROM judged GROUP BY r),
windows AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM words),
again AS (
  SELECT r, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY r, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) > 1),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM again, (SELECT unnest(range(3)) AS k) GROUP BY r),
counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(t) - length(regexp_replace(t, '{rules.SYMBOLS}', '', 'g')) AS n_symbols, n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(n_lost_words AS BIGINT) AS n_lost_words
  FROM words JOIN by_line USING (r) LEFT JOIN covered USING (r)),
based AS (
  SELECT *, n_words < {rules.FEWEST_WORDS}
    OR n_repeat_words * 100 > n_words * {rules.MOST_REPEATED} AS base_failed FROM counts)
SELECT *, NOT base_failed AND n_lost_words * 100 <= n_words * {rules.MOST_LOST} AS kept FROM based"""

_PATTERN = r"'^.*?://([^/?#]*)([^?#]*)'"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def urls(listed: list[hosts.Rule], tolerated: float = 0.35, deviations: float = 1.0) -> str:
    """Verdicts; the rules are tried from the longest to the shortest."""
    fits, verdicts = [], []
    for one in sorted(listed, key=lambda r: -len(r.name)):
        test = (
            f"(host = '{one.host}' OR ends_with(host, '.{one.host}'))"
            f" AND starts_with(path, '{one.path}')"
        )
        fits.append(f"WHEN {test} THEN '{one.name}'")
        verdicts.append(f"WHEN {test} THEN '{one.verdict}'")

    def strength(rows: str, centre: str) -> str:
        return f"""(SELECT CASE WHEN coalesce(room, 0) = 0 OR excess <= 0 THEN {hosts.STRONGEST}
    ELSE least(greatest(room / excess - 1, {hosts.WEAKEST}), {hosts.STRONGEST}) END
  FROM (SELECT sum(pow(bad - n * {centre}, 2) - n * {centre} * (1 - {centre})) AS excess,
    sum(n * (n - 1) * {centre} * (1 - {centre})) AS room FROM {rows}))"""

    return f"""WITH placed AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, {_PATTERN}, 1, 's'), '{_UPPER}', '{_UPPER.lower()}'), '')
      AS host,
    coalesce(regexp_extract(url, {_PATTERN}, 2, 's'), '') AS path FROM pages),
known AS (
  SELECT doc_id AS page_id, max(CAST(quality = 0 OR toxic = 1 AS DOUBLE)) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY doc_id),
counted AS (
  SELECT host, CAST(count(bad) AS DOUBLE) AS n, coalesce(sum(bad), 0) AS bad,
    string_split(host, '.') AS l
  FROM placed LEFT JOIN known USING (page_id) GROUP BY host),
last_two AS (
  SELECT *, CASE WHEN len(l) < 2 THEN host ELSE l[len(l) - 1] || '.' || l[len(l)] END AS two
  FROM counted),
hosts AS (
  SELECT host, n, bad, CASE WHEN two IN ({text_list(hosts.TWO_LABELS)}) THEN two
      ELSE l[len(l)] END AS suffix,
    CASE WHEN two IN ({text_list(hosts.TWO_LABELS)}) AND len(l) > 2
      THEN l[len(l) - 2] || '.' || two ELSE two END AS domain FROM last_two),
overall AS (SELECT CASE WHEN sum(n) > 0 THEN (sum(bad) + 1) / (sum(n) + 2) ELSE 0 END AS m FROM hosts),
suffixes AS (
  SELECT suffix, (sum(bad) + any_value(m) * {hosts.SUFFIX_STRENGTH})
    / (sum(n) + {hosts.SUFFIX_STRENGTH}) AS suffix_rate FROM hosts, overall GROUP BY suffix),
domains AS (
  SELECT domain, suffix_rate, sum(n) AS n, sum(bad) AS bad FROM hosts JOIN suffixes USING (suffix)
  GROUP BY suffix, domain, suffix_rate),
domain_rates AS (
  SELECT domain, (bad + suffix_rate * s) / (n + s) AS domain_rate
  FROM (SELECT *, {strength("domains", "suffix_rate")} AS s FROM domains)),
centred AS (SELECT host, n, bad, domain_rate FROM hosts JOIN domain_rates USING (domain)),
rated AS (
  SELECT host, (bad + domain_rate * s) / (n + s) AS rate, n + s AS weight
  FROM (SELECT *, {strength("centred", "domain_rate")} AS s FROM centred)),
judged AS (
  SELECT host, rate - {deviations} * sqrt(rate * (1 - rate) / (weight + 1)) > {tolerated} AS blocked
  FROM rated)
SELECT page_id, host, path, CASE {' '.join(fits)} END AS rule,
  CASE {' '.join(verdicts)} WHEN blocked THEN 'block' ELSE 'allow' END AS verdict
FROM placed JOIN judged USING (host)"""


JACCARD = f"""WITH RECURSIVE {WORDS},
shingles AS (
  SELECT DISTINCT r, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM words
    WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (
  SELECT a.r AS a, b.r AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s
  WHERE a.r <> b.r GROUP BY a.r, b.r),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
  WHERE common / (x.n + y.n - common) >= 0.8),
reached AS (SELECT r AS a, r AS b FROM docs UNION SELECT m.a, l.b FROM reached m JOIN links l ON l.a = m.b),
classes AS (
  SELECT a AS r, min(d.doc_id) AS class_id FROM reached JOIN docs d ON d.r = reached.b GROUP BY a),
degrees AS (SELECT a AS r, count(*) AS n_links FROM links GROUP BY a)
SELECT d.doc_id, class_id, coalesce(n_links, 0) AS n_links
FROM docs d JOIN classes USING (r) LEFT JOIN degrees USING (r)"""


def vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Product quantisation in whole numbers, all parts against all entries."""
    assigned = """
        SELECT p.n, p.part, min(d * 256 + entry) AS best
        FROM (
            SELECT p.n, p.part, b.entry, list_sum(list_transform(
                list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
            FROM parts AS p JOIN book{round} AS b ON p.part = b.part
        ) AS p
        GROUP BY p.n, p.part"""
    moved = """
        SELECT b.part, b.entry, coalesce(m.v, b.v) AS v
        FROM book{round} AS b LEFT JOIN (
            SELECT part, entry, list((s - ((s % c) + c) % c) // c ORDER BY pos) AS v
            FROM (
                SELECT p.part, a.best % 256 AS entry, p.pos, sum(p.x)::BIGINT AS s, count(*) AS c
                FROM (SELECT n, part, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM parts) AS p
                JOIN best{round} AS a ON a.n = p.n AND a.part = p.part
                GROUP BY ALL
            ) GROUP BY part, entry
        ) AS m ON m.part = b.part AND m.entry = b.entry"""
    steps = []
    for n in range(rounds):
        steps.append(f"best{n} AS MATERIALIZED ({assigned.format(round=n)})")
        steps.append(f"book{n + 1} AS MATERIALIZED ({moved.format(round=n)})")
    steps.append(f"best{rounds} AS MATERIALIZED ({assigned.format(round=rounds)})")
    return f"""
    WITH finite AS (
        SELECT vec_id, label, embedding FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % {parts} = 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    common AS (
        SELECT len(embedding) AS size FROM finite GROUP BY ALL ORDER BY count(*) DESC, size LIMIT 1
    ),
    kept AS MATERIALIZED (
        SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS n,
            list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v
        FROM finite WHERE len(embedding) = (SELECT size FROM common)
    ),
    parts AS MATERIALIZED (
        SELECT n, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] AS v
        FROM kept, unnest(range({parts})) AS t(part)
    ),
    book0 AS MATERIALIZED (SELECT part, n - 1 AS entry, v FROM parts WHERE n <= {entries}),
    {", ".join(steps)},
    coded AS (
        SELECT k.vec_id, k.label, string_agg(format('{{:02x}}', b.best % 256), '' ORDER BY part) AS code,
            sum(b.best // 256)::BIGINT AS error
        FROM kept AS k JOIN best{rounds} AS b ON b.n = k.n GROUP BY k.n, k.vec_id, k.label
    ),
    totals AS (SELECT label, sum(error)::BIGINT AS label_error FROM coded GROUP BY label)
    SELECT c.vec_id, c.code, c.error, t.label_error, (
        SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM (
            SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM book{rounds})
        ) AS codebooks_sha256
    FROM coded AS c JOIN totals AS t ON c.label IS NOT DISTINCT FROM t.label"""
