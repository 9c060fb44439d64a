"""The readings and hours of the problem tables as SQL, for the twins; written another way where there is one."""

from __future__ import annotations

#: Texts to instants: local text and zone text are parted, the local text is read by formats, and of
#: the zone's two offsets the first that maps back is taken; none does inside a gap.
_FORMATS = (
    "%Y-%m-%dT%H:%M:%S",
    "%Y-%m-%dT%H:%M:%S.%f",
    "%Y-%m-%dt%H:%M:%S",
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%dT%H:%M",
    "%m/%d/%Y %I:%M %p",
    "%Y/%m/%d %H:%M:%S",
    "%a, %d %b %Y %H:%M:%S",
    "%d %b %Y %H:%M:%S",
    "%Y年%m月%d日 %H:%M",
    "%Y%m%dT%H%M%S",
)
_CLOCKS = ("%I:%M %p", "%I:%M%p", "%H:%M:%S", "%H:%M", "%H%M")


def _list(formats: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{f}'" for f in formats) + "]"


def _instants(name: str, source: str) -> str:
    """CTEs that end in ``name``: row_id, field_name, written, us of a source with row_id, field_name, written, zone, day."""
    return f"""
{name}_a AS (
  SELECT *, regexp_replace(written, '^\\s+|\\s+$', '', 'g') AS c FROM ({source}) s
), {name}_b AS (
  SELECT *, CASE WHEN regexp_matches(c, '^\\d{{10}}$') THEN c::BIGINT * 1000000 WHEN regexp_matches(c, '^\\d{{13}}$') THEN c::BIGINT * 1000 END AS epoch,
    regexp_extract(c, '([Zz]|[+-]\\d{{2}}:?\\d{{2}}| [A-Z]{{3}})$', 1) AS z
  FROM {name}_a
), {name}_c AS (
  SELECT *, replace(trim(z), ':', '') AS z2, left(c, length(c) - length(z)) AS l FROM {name}_b
), {name}_d AS (
  SELECT *, CASE z2 WHEN '' THEN NULL WHEN 'Z' THEN 0 WHEN 'EST' THEN -300 WHEN 'EDT' THEN -240 WHEN 'PST' THEN -480 WHEN 'PDT' THEN -420 WHEN 'JST' THEN 540
      ELSE CASE left(z2, 1) WHEN '-' THEN -1 ELSE 1 END * (TRY_CAST(substr(z2, 2, 2) AS INT) * 60 + TRY_CAST(substr(z2, 4, 2) AS INT)) END AS east,
    coalesce(try_strptime(trim(l), {_list(_FORMATS)}),
      CASE WHEN day IS NOT NULL AND regexp_matches(c, '^(\\d{{1,2}}:\\d{{2}}(:\\d{{2}})?( ?[AaPp][Mm])?|\\d{{4}})$') THEN day
        + CAST(CASE WHEN extract(hour FROM try_strptime(upper(c), {_list(_CLOCKS)})) < 6 THEN 1 ELSE 0 END AS INT) + CAST(try_strptime(upper(c), {_list(_CLOCKS)}) AS TIME) END) AS wall,
    CASE zone WHEN 'America/New_York' THEN -300 WHEN 'America/Los_Angeles' THEN -480 ELSE 540 END AS std,
    CASE zone WHEN 'Asia/Tokyo' THEN 0 ELSE 60 END AS dst
  FROM {name}_c
), {name}_e AS (
  SELECT *, wall - to_minutes(std + dst) AS u1, wall - to_minutes(std) AS u2 FROM {name}_d
), {name}_f AS (
  SELECT *, CASE WHEN epoch IS NOT NULL THEN epoch WHEN z2 <> '' THEN epoch_us(wall - to_minutes(east))
      WHEN (u1 AT TIME ZONE 'UTC') AT TIME ZONE zone = wall THEN epoch_us(u1)
      WHEN (u2 AT TIME ZONE 'UTC') AT TIME ZONE zone = wall THEN epoch_us(u2)
      ELSE epoch_us(date_trunc('hour', wall) - to_minutes(std)) END AS u
  FROM {name}_e
), {name} AS (
  SELECT row_id, field_name, written, CASE WHEN u <> 915177600000000 AND (wall IS NULL OR CAST(wall AS DATE) <> DATE '1999-01-01') THEN u END AS us FROM {name}_f
)"""


PROP_ZONE = "CASE lower(trim(prop)) WHEN 'dlr' THEN 'America/Los_Angeles' WHEN 'ush' THEN 'America/Los_Angeles' WHEN 'tdr' THEN 'Asia/Tokyo' ELSE 'America/New_York' END"
PARK = "upper(regexp_replace(park_code, '^\\s+|\\s+$', '', 'g'))"
PARK_ZONE = "CASE {p} WHEN 'DL' THEN 'America/Los_Angeles' WHEN 'CA' THEN 'America/Los_Angeles' WHEN 'UH' THEN 'America/Los_Angeles' WHEN 'TDL' THEN 'Asia/Tokyo' WHEN 'TDS' THEN 'Asia/Tokyo' ELSE 'America/New_York' END"
_ENTITY = "upper(regexp_replace(entity_code, '^\\s+|\\s+$', '', 'g'))"
_KIND = "upper(regexp_replace(wait_time_type, '^\\s+|\\s+$', '', 'g'))"

OBSERVED = _instants("seen", f"SELECT ingest_seq AS row_id, 'observed_at' AS field_name, observed_at AS written, {PROP_ZONE} AS zone, CAST(NULL AS DATE) AS day FROM dedupe_keys")
HOURS = _instants(
    "opened",
    " UNION ALL ".join(
        f"SELECT hours_id AS row_id, '{f}' AS field_name, {f} AS written, {PARK_ZONE.format(p=PARK)} AS zone, TRY_CAST(park_date AS DATE) AS day FROM dimparkhours_with_donor"
        for f in ("opening_time", "closing_time")
    ),
)

READINGS = f"""{OBSERVED}, readings AS (
  SELECT d.ingest_seq, {_ENTITY} AS entity, {_KIND} AS kind, {_ENTITY} || '|' || {_KIND} AS source, s.us, CAST(d.wait_time_minutes AS BIGINT) AS m, d.prop
  FROM dedupe_keys d JOIN seen s ON s.row_id = d.ingest_seq WHERE s.us IS NOT NULL AND d.entity_code IS NOT NULL
)"""

PAIRS = """SELECT a.ingest_seq AS ingest_seq_a, b.ingest_seq AS ingest_seq_b FROM readings a JOIN readings b
  ON a.source = b.source AND abs(a.us - b.us) <= 30000000 AND abs(a.m - b.m) <= 1 AND a.ingest_seq < b.ingest_seq"""

USABLE = f"""{HOURS}, usable AS (
  SELECT h.hours_id, {PARK} AS park, h.park_date, lower(trim(h.version_type)) AS version_type, h.valid_from, h.created_at, o.us AS open_us, c.us AS close_us,
    coalesce(CAST(h.emh_morning AS BOOLEAN), FALSE) AS em, coalesce(CAST(h.emh_evening AS BOOLEAN), FALSE) AS ev
  FROM dimparkhours_with_donor h
  JOIN opened o ON o.row_id = h.hours_id AND o.field_name = 'opening_time' JOIN opened c ON c.row_id = h.hours_id AND c.field_name = 'closing_time'
  WHERE o.us IS NOT NULL AND c.us IS NOT NULL
)"""

EXACT = "regexp_matches(written, '^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}[+-]\\d{2}:\\d{2}$')"

# Texts that stand for an absent source.
FILLER_LIST = "('', '-', '--', '--:--', 'nan', 'nat', 'null', 'none', 'n/a', 'na', 'unknown', 'tbd', 'closed?', '?')"


def filled(column: str) -> str:
    """CTEs that fill a column of minutes of ``times`` and end in ``{column}_out``: hours_id, value, method, dist of the rows that lacked it."""
    c = column
    known = f"CASE WHEN {c} IS NOT NULL AND day IS NOT NULL THEN {{'d': day, 'v': {c}}} END"
    return f"""{c}_near AS (
  SELECT *, last_value({known} IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b, first_value({known} IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a
  FROM times WINDOW w AS (PARTITION BY park, kind ORDER BY day NULLS FIRST, created_at NULLS FIRST, hours_id)
), {c}_far AS (SELECT *, coalesce(day - b.d <= 30, FALSE) AS nb, coalesce(a.d - day <= 30, FALSE) AS na, day - b.d AS back, a.d - day AS ahead FROM {c}_near WHERE {c} IS NULL
), {c}_got AS (
  SELECT *, CASE WHEN nb AND na THEN b.v + CASE WHEN a.d > b.d THEN (a.v - b.v) / (a.d - b.d) ELSE 0 END * back WHEN nb THEN b.v WHEN na THEN a.v END AS v, CASE WHEN nb AND na THEN least(back, ahead) WHEN nb THEN back WHEN na THEN ahead END AS dv FROM {c}_far
), {c}_m1 AS (SELECT park, isodow(day) AS wd, median({c}) AS v FROM times GROUP BY ALL), {c}_m2 AS (SELECT kind, median({c}) AS v FROM times GROUP BY ALL), {c}_m3 AS (SELECT park, median({c}) AS v FROM times GROUP BY ALL
), {c}_out AS (
  SELECT hours_id, coalesce(k.v, m1.v, m2.v, m3.v) AS value, CASE WHEN k.v IS NOT NULL THEN CASE WHEN nb AND na THEN 'interpolated' ELSE 'carried' END WHEN coalesce(m1.v, m2.v, m3.v) IS NOT NULL THEN 'group' ELSE 'none' END AS method, CASE WHEN k.v IS NOT NULL THEN dv END AS dist
  FROM {c}_got k LEFT JOIN {c}_m1 m1 ON m1.park IS NOT DISTINCT FROM k.park AND m1.wd IS NOT DISTINCT FROM isodow(k.day) LEFT JOIN {c}_m2 m2 ON m2.kind IS NOT DISTINCT FROM k.kind LEFT JOIN {c}_m3 m3 ON m3.park IS NOT DISTINCT FROM k.park)"""
