"""SQL twins of the core queries."""

from __future__ import annotations

from queuescope.plans import problem_sql as q
from queuescope.plans import reference

SQL: dict[str, str] = {
    "p1_found": f"""WITH {q.READINGS}, pairs AS ({q.PAIRS}), base AS (
  SELECT *, CASE WHEN kind = 'PRIORITY' THEN m BETWEEN -100 AND 2000 ELSE m BETWEEN 0 AND 1000 END AS ok FROM readings
  WHERE m IS NOT NULL AND NOT (kind = 'PRIORITY' AND m = 8888) AND ingest_seq NOT IN (SELECT ingest_seq_b FROM pairs)
), med AS (SELECT source, median(m) AS med, count(*) AS n FROM base WHERE ok GROUP BY source), chg AS (
  SELECT *, CASE WHEN lag(m) OVER w = m THEN 0 ELSE 1 END AS starts, lag(m) OVER w IS NOT NULL AS has FROM base WINDOW w AS (PARTITION BY source ORDER BY us, ingest_seq)
), runs AS (SELECT *, sum(starts) OVER (PARTITION BY source ORDER BY us, ingest_seq) AS run FROM chg), lens AS (
  SELECT *, count(*) OVER (PARTITION BY source, run) AS len FROM runs
), share AS (SELECT source, sum(CASE WHEN has THEN 1 - starts ELSE 0 END) * 1.0 / nullif(count(*) - 1, 0) AS eq FROM chg GROUP BY source)
SELECT l.ingest_seq FROM lens l LEFT JOIN med USING (source) LEFT JOIN share USING (source)
WHERE NOT ok OR (n >= 20 AND (m > 3 * med + 30 OR (kind = 'POSTED' AND med >= 40 AND m < med / 10))) OR (len >= 10 AND coalesce(eq, 0) <= 0.8)""",
    "p1_spikes": f"""WITH {q.READINGS}, pairs AS ({q.PAIRS}), base AS (
  SELECT *, CASE WHEN kind = 'PRIORITY' THEN m BETWEEN -100 AND 2000 ELSE m BETWEEN 0 AND 1000 END AS ok FROM readings
  WHERE m IS NOT NULL AND NOT (kind = 'PRIORITY' AND m = 8888) AND ingest_seq NOT IN (SELECT ingest_seq_b FROM pairs)
), med AS (SELECT source, median(m) AS med, count(*) AS n FROM base WHERE ok GROUP BY source), chg AS (
  SELECT *, CASE WHEN lag(m) OVER w = m THEN 0 ELSE 1 END AS starts, lag(m) OVER w IS NOT NULL AS has FROM base WINDOW w AS (PARTITION BY source ORDER BY us, ingest_seq)
), runs AS (SELECT *, sum(starts) OVER (PARTITION BY source ORDER BY us, ingest_seq) AS run FROM chg), lens AS (
  SELECT *, count(*) OVER (PARTITION BY source, run) AS len FROM runs
), share AS (SELECT source, sum(CASE WHEN has THEN 1 - starts ELSE 0 END) * 1.0 / nullif(count(*) - 1, 0) AS eq FROM chg GROUP BY source)
SELECT l.ingest_seq, l.source, l.m AS minutes, NOT ok AS impossible, coalesce(ok AND n >= 20 AND (m > 3 * med + 30 OR (kind = 'POSTED' AND med >= 40 AND m < med / 10)), FALSE) AS disproportionate,
  len >= 10 AND coalesce(eq, 0) <= 0.8 AS stuck, CASE WHEN len >= 10 AND coalesce(eq, 0) <= 0.8 THEN len ELSE 0 END AS run_length FROM lens l LEFT JOIN med USING (source) LEFT JOIN share USING (source)
WHERE NOT ok OR (n >= 20 AND (m > 3 * med + 30 OR (kind = 'POSTED' AND med >= 40 AND m < med / 10))) OR (len >= 10 AND coalesce(eq, 0) <= 0.8)""",
    "p2_found": f"""WITH {q.OBSERVED}, {q.HOURS}, both_ AS (SELECT * FROM seen UNION ALL SELECT * FROM opened)
SELECT field_name, row_id, us AS epoch_us FROM both_ WHERE us IS NOT NULL AND NOT {q.EXACT}""",
    "p4_found": f"""WITH {q.HOURS} SELECT row_id AS hours_id, field_name FROM opened WHERE us IS NULL
UNION ALL SELECT hours_id, 'source' FROM dimparkhours_with_donor WHERE source IS NULL OR lower(trim(source)) IN ('', '-', '--', 'nan', 'null', 'none', 'unknown', 'n/a', 'na', 'nat', 'tbd', '?')""",
    "p4_filled": f"""WITH {q.HOURS}, src AS (
  SELECT h.hours_id, {q.PARK} AS park, lower(trim(h.version_type)) AS kind, TRY_CAST(h.park_date AS DATE) AS day, h.created_at, {q.PARK_ZONE.format(p=q.PARK)} AS zone,
    CASE WHEN h.source IS NOT NULL AND lower(trim(h.source)) NOT IN {q.FILLER_LIST} THEN lower(trim(h.source)) END AS s FROM dimparkhours_with_donor h
), times AS (
  SELECT s.*, (epoch_us((make_timestamp(o.us) AT TIME ZONE 'UTC') AT TIME ZONE zone) - epoch_us(CAST(day AS TIMESTAMP))) / 60e6 AS o, (epoch_us((make_timestamp(c.us) AT TIME ZONE 'UTC') AT TIME ZONE zone) - epoch_us(CAST(day AS TIMESTAMP))) / 60e6 AS c
  FROM src s JOIN opened o ON o.row_id = s.hours_id AND o.field_name = 'opening_time' JOIN opened c ON c.row_id = s.hours_id AND c.field_name = 'closing_time'
), {q.filled("o")}, {q.filled("c")}, sources AS (
  SELECT *, last_value(CASE WHEN s IS NOT NULL AND day IS NOT NULL THEN {{'d': day, 'v': s}} END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
    first_value(CASE WHEN s IS NOT NULL AND day IS NOT NULL THEN {{'d': day, 'v': s}} END IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a
  FROM times WINDOW w AS (PARTITION BY park, kind ORDER BY day NULLS FIRST, created_at NULLS FIRST, hours_id)
), near AS (SELECT *, day - b.d AS back, a.d - day AS ahead FROM sources), carried AS (
  SELECT *, CASE WHEN back <= 30 AND (ahead IS NULL OR ahead > 30 OR back <= ahead) THEN b.v WHEN ahead <= 30 THEN a.v END AS v, CASE WHEN back <= 30 AND (ahead IS NULL OR ahead > 30 OR back <= ahead) THEN back WHEN ahead <= 30 THEN ahead END AS dist FROM near
), modes AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY g, park, kind, wd ORDER BY n DESC, s) AS rn FROM (
    SELECT 1 AS g, park, NULL AS kind, isodow(day) AS wd, s, count(*) AS n FROM times WHERE s IS NOT NULL GROUP BY ALL UNION ALL SELECT 2, NULL, kind, NULL, s, count(*) FROM times WHERE s IS NOT NULL GROUP BY ALL
    UNION ALL SELECT 3, park, NULL, NULL, s, count(*) FROM times WHERE s IS NOT NULL GROUP BY ALL)) WHERE rn = 1
), all_ AS (
  SELECT hours_id, 'source' AS field_name, coalesce(v, m1.s, m2.s, m3.s) AS value, CASE WHEN v IS NOT NULL THEN 'carried' WHEN coalesce(m1.s, m2.s, m3.s) IS NOT NULL THEN 'group' ELSE 'none' END AS method, CASE WHEN v IS NOT NULL THEN dist END AS distance_days
  FROM carried k LEFT JOIN modes m1 ON m1.g = 1 AND m1.park IS NOT DISTINCT FROM k.park AND m1.wd IS NOT DISTINCT FROM isodow(k.day) LEFT JOIN modes m2 ON m2.g = 2 AND m2.kind IS NOT DISTINCT FROM k.kind LEFT JOIN modes m3 ON m3.g = 3 AND m3.park IS NOT DISTINCT FROM k.park WHERE k.s IS NULL
  UNION ALL SELECT hours_id, 'opening_time', CAST(round_even(value, 0) AS VARCHAR), method, dist FROM o_out UNION ALL SELECT hours_id, 'closing_time', CAST(round_even(value, 0) AS VARCHAR), method, dist FROM c_out
) SELECT hours_id, field_name, value, method, CAST(distance_days AS DOUBLE) AS distance_days FROM all_""",
    "p5_history": f"""WITH {q.USABLE}, ordered AS (
  SELECT *, lag(hours_id) OVER w AS before, lag(open_us) OVER w AS b1, lag(close_us) OVER w AS b2, lag(em) OVER w AS b3, lag(ev) OVER w AS b4 FROM usable
  WINDOW w AS (PARTITION BY park, park_date, version_type ORDER BY valid_from, created_at, hours_id)
), begins AS (SELECT *, CASE WHEN before IS NULL THEN 'inserted' ELSE 'changed' END AS change FROM ordered WHERE before IS NULL OR b1 <> open_us OR b2 <> close_us OR b3 <> em OR b4 <> ev)
SELECT park, park_date, version_type, row_number() OVER v AS version_no, change, hours_id, CAST(epoch_us(valid_from) AS DOUBLE) AS valid_from_us, CAST(lead(epoch_us(valid_from)) OVER v AS DOUBLE) AS valid_until_us,
  CAST(lead(hours_id) OVER v AS DOUBLE) AS closed_by, open_us AS opening_us, close_us AS closing_us, em AS emh_morning, ev AS emh_evening FROM begins WINDOW v AS (PARTITION BY park, park_date, version_type ORDER BY valid_from, created_at, hours_id)""",
    "p5_found": f"""WITH {q.USABLE}, ordered AS (
  SELECT *, lag(hours_id) OVER w AS before, lag(open_us) OVER w AS b1, lag(close_us) OVER w AS b2, lag(em) OVER w AS b3, lag(ev) OVER w AS b4 FROM usable
  WINDOW w AS (PARTITION BY park, park_date, version_type ORDER BY valid_from, created_at, hours_id)
), begins AS (SELECT * FROM ordered WHERE before IS NULL OR b1 <> open_us OR b2 <> close_us OR b3 <> em OR b4 <> ev)
SELECT hours_id, CAST(coalesce(lead(hours_id) OVER (PARTITION BY park, park_date, version_type ORDER BY valid_from, created_at, hours_id), 0) AS BIGINT) AS closed_by FROM begins""",
    "p6_found": f"""WITH {q.READINGS}, {q.USABLE}, parks AS (
  SELECT ingest_seq, us, CASE regexp_extract(entity, '^[^0-9]*') WHEN 'USH' THEN 'UH' ELSE regexp_extract(entity, '^[^0-9]*') END AS park FROM readings
), dated AS (
  SELECT *, CAST(CAST((make_timestamp(us) AT TIME ZONE 'UTC') AT TIME ZONE {q.PARK_ZONE.format(p="park")} - INTERVAL 6 HOUR AS DATE) AS VARCHAR) AS park_date FROM parks
), ranked AS (
  SELECT d.ingest_seq, u.hours_id, row_number() OVER (PARTITION BY d.ingest_seq ORDER BY CASE u.version_type WHEN 'official' THEN 1 WHEN 'final' THEN 2 WHEN 'predicted' THEN 3 ELSE 4 END,
    u.valid_from DESC, u.created_at DESC, u.hours_id) AS rn
  FROM dated d JOIN usable u ON u.park = d.park AND u.park_date = d.park_date AND epoch_us(u.valid_from) <= d.us AND epoch_us(u.created_at) <= d.us
  WHERE u.version_type IN ('official', 'final', 'predicted', 'historical')
)
SELECT ingest_seq, hours_id FROM ranked WHERE rn = 1""",
    "p6_known_hours": f"""WITH {q.READINGS}, {q.USABLE}, parks AS (
  SELECT ingest_seq, us, CASE regexp_extract(entity, '^[^0-9]*') WHEN 'USH' THEN 'UH' ELSE regexp_extract(entity, '^[^0-9]*') END AS park FROM readings
), dated AS (
  SELECT *, CAST(CAST((make_timestamp(us) AT TIME ZONE 'UTC') AT TIME ZONE {q.PARK_ZONE.format(p="park")} - INTERVAL 6 HOUR AS DATE) AS VARCHAR) AS park_date FROM parks
), ranked AS (
  SELECT d.ingest_seq, u.*, row_number() OVER (PARTITION BY d.ingest_seq ORDER BY CASE u.version_type WHEN 'official' THEN 1 WHEN 'final' THEN 2 WHEN 'predicted' THEN 3 ELSE 4 END,
    u.valid_from DESC, u.created_at DESC, u.hours_id) AS rn
  FROM dated d JOIN usable u ON u.park = d.park AND u.park_date = d.park_date AND epoch_us(u.valid_from) <= d.us AND epoch_us(u.created_at) <= d.us
  WHERE u.version_type IN ('official', 'final', 'predicted', 'historical')
)
SELECT ingest_seq, park, park_date, hours_id, version_type, open_us AS opening_us, close_us AS closing_us, em AS emh_morning, ev AS emh_evening FROM ranked WHERE rn = 1""",
    **reference.SQL,
}
