"""Queries for parsing, time, calendar, keys, aggregates and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuescope.functions import calendar, clean, parse, temporal
from queuescope.functions.codes import zone_of_park
from queuescope.functions.timestamps import instant_of_wall
from queuescope.operators import aggregates, dedupe, features, reports
from queuescope.plans.facts import FACT, facts, query
from queuescope.session import table

# ---- aggregates of readings


@query(f"""WITH {FACT} SELECT entity_code, CAST(park_date AS VARCHAR) AS park_date, CAST(extract(hour FROM local_ts) AS BIGINT) AS hour, count(*) AS n,
  round(avg(wait_time_minutes), 6) AS mean_minutes, median(wait_time_minutes) AS median_minutes
FROM fact WHERE wait_time_type = 'POSTED' GROUP BY ALL""")
def q_posted_hourly_stats(spark: SparkSession, d: str) -> DataFrame:
    """Statistics of posted times per entity, operational date and local hour."""
    rows = facts(spark, d).where(F.col("wait_time_type") == "POSTED")
    hour = (F.floor(F.col("local_us") / F.lit(3_600_000_000)) % 24).cast("bigint")
    return rows.groupBy("entity_code", F.col("park_date").cast("string").alias("park_date"), hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("wait_time_minutes"), 6).alias("mean_minutes"), F.median("wait_time_minutes").alias("median_minutes")
    )


@query("""WITH cum AS (SELECT l_returnflag, l_quantity, sum(l_extendedprice) OVER (PARTITION BY l_returnflag ORDER BY l_quantity RANGE UNBOUNDED PRECEDING) AS c,
  sum(l_extendedprice) OVER (PARTITION BY l_returnflag) AS t FROM lineitem)
SELECT l_returnflag, min(l_quantity) AS weighted_median FROM cum WHERE c >= t / 2 GROUP BY l_returnflag""")
def q_weighted_median(spark: SparkSession, d: str) -> DataFrame:
    """Lower weighted median of quantity, weighted by price."""
    return aggregates.weighted_median(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice")


@query("""SELECT l_shipmode_group, round(sum(l_quantity * l_extendedprice) / nullif(sum(l_extendedprice), 0), 6) AS weighted_mean
FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode_group FROM lineitem) GROUP BY 1""")
def q_weighted_mean(spark: SparkSession, d: str) -> DataFrame:
    """Mean quantity weighted by price."""
    rows = table(spark, d, "lineitem").withColumn("l_shipmode_group", F.concat("l_returnflag", "l_linestatus"))
    mean = F.sum(F.col("l_quantity") * F.col("l_extendedprice")) / F.nullif(F.sum("l_extendedprice"), F.lit(0.0))
    return rows.groupBy("l_shipmode_group").agg(F.round(mean, 6).alias("weighted_mean"))


_AS_OF = "2024-02-01"
_POSTED = f"""{FACT}, posted AS (
  SELECT f.entity_code, f.park_date, f.wait_time_minutes AS v, g.date_group_id AS dategroupid, CAST(extract(hour FROM local_ts) AS BIGINT) AS hour,
    1.0 / (1.0 + (DATE '{_AS_OF}' - f.park_date) / 365.0) AS w
  FROM fact f JOIN dimdategroupid g ON g.park_date = CAST(f.park_date AS VARCHAR) WHERE wait_time_type = 'POSTED'
), half AS (
  SELECT *, sum(w) OVER (PARTITION BY entity_code, dategroupid, hour ORDER BY v RANGE UNBOUNDED PRECEDING) AS c, sum(w) OVER (PARTITION BY entity_code, dategroupid, hour) AS t FROM posted
), agg AS (
  SELECT entity_code, dategroupid, hour, min(CASE WHEN c >= t / 2 - 1e-12 * t THEN v END) AS posted_median, round(sum(v * w) / sum(w), 6) AS posted_mean, median(v) AS posted_median_unweighted,
    round(avg(v), 6) AS posted_mean_unweighted, count(v) AS posted_count, round(avg(w), 6) AS avg_recency_weight, CAST(min(park_date) AS VARCHAR) AS min_park_date, CAST(max(park_date) AS VARCHAR) AS max_park_date
  FROM half GROUP BY ALL
)"""


def _posted(spark: SparkSession, d: str) -> DataFrame:
    groups = table(spark, d, "dimdategroupid").select(F.col("park_date").cast("date").alias("park_date"), F.col("date_group_id").alias("dategroupid"))
    rows = facts(spark, d).where(F.col("wait_time_type") == "POSTED").join(groups, "park_date")
    return rows.withColumns({
        "hour": (F.floor(F.col("local_us") / F.lit(3_600_000_000)) % 24).cast("bigint"),
        "weight": temporal.recency_weight(F.datediff(F.lit(_AS_OF).cast("date"), "park_date")),
    })


@query(f"WITH {_POSTED} SELECT * FROM agg")
def q_posted_aggregates(spark: SparkSession, d: str) -> DataFrame:
    """Weighted and plain statistics per entity, date group and local hour."""
    table_ = aggregates.posted_aggregates(_posted(spark, d))
    rounded = {c: F.round(c, 6) for c in ("posted_mean", "posted_mean_unweighted", "avg_recency_weight")}
    return table_.withColumns(rounded | {c: F.col(c).cast("string") for c in ("min_park_date", "max_park_date")})


@query(f"""WITH {_POSTED}, wanted AS (SELECT event_id, entity_code, CAST(NULL AS VARCHAR) AS none_, dategroupid, (event_id * 7) % 24 AS hour FROM (
    SELECT f.event_id, f.entity_code, g.date_group_id AS dategroupid FROM fact f JOIN dimdategroupid g ON g.park_date = CAST(f.park_date AS VARCHAR) WHERE wait_time_type = 'ACTUAL'))
SELECT w.event_id, round(coalesce(a.posted_median, b.v, c.v, e.v, p.v), 6) AS predicted,
  CAST(CASE WHEN a.posted_median IS NOT NULL THEN 1 WHEN b.v IS NOT NULL THEN 2 WHEN c.v IS NOT NULL THEN 3 WHEN e.v IS NOT NULL THEN 4 WHEN p.v IS NOT NULL THEN 5 END AS BIGINT) AS level
FROM wanted w
LEFT JOIN agg a ON a.entity_code = w.entity_code AND a.dategroupid = w.dategroupid AND a.hour = w.hour
LEFT JOIN (SELECT entity_code, dategroupid, median(posted_median) AS v FROM agg GROUP BY ALL) b ON b.entity_code = w.entity_code AND b.dategroupid = w.dategroupid
LEFT JOIN (SELECT entity_code, hour, median(posted_median) AS v FROM agg GROUP BY ALL) c ON c.entity_code = w.entity_code AND c.hour = w.hour
LEFT JOIN (SELECT entity_code, median(posted_median) AS v FROM agg GROUP BY ALL) e ON e.entity_code = w.entity_code
LEFT JOIN (SELECT left(entity_code, 2) AS pre, hour, median(posted_median) AS v FROM agg GROUP BY ALL) p ON p.pre = left(w.entity_code, 2) AND p.hour = w.hour""", nullable=("level",))
def q_fallback_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Posted medians for actual readings at other hours, over five levels."""
    groups = table(spark, d, "dimdategroupid").select(F.col("park_date").cast("date").alias("park_date"), F.col("date_group_id").alias("dategroupid"))
    wanted = facts(spark, d).where(F.col("wait_time_type") == "ACTUAL").join(groups, "park_date").select("event_id", "entity_code", "dategroupid", (F.col("event_id") * 7 % 24).alias("hour"))
    found = aggregates.fallback_lookup(wanted, aggregates.posted_aggregates(_posted(spark, d)))
    return found.select("event_id", F.round("predicted", 6).alias("predicted"), F.col("level").cast("bigint").alias("level"))


# ---- parsing


@query("""WITH wide AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(value AS VARCHAR) END AS posted, CASE WHEN event_id % 5 = 0 THEN 'x' WHEN event_id % 2 = 0 THEN CAST(value * 3 AS VARCHAR) END AS actual FROM events)
SELECT event_id, 'POSTED' AS wait_time_type, CAST(round_even(TRY_CAST(posted AS DOUBLE), 0) AS BIGINT) AS wait_time_minutes FROM wide WHERE round_even(TRY_CAST(posted AS DOUBLE), 0) BETWEEN 0 AND 1000
UNION ALL SELECT event_id, 'ACTUAL', CAST(round_even(TRY_CAST(actual AS DOUBLE), 0) AS BIGINT) FROM wide WHERE round_even(TRY_CAST(actual AS DOUBLE), 0) BETWEEN 0 AND 1000""")
def q_unpivot_standby(spark: SparkSession, d: str) -> DataFrame:
    """Wide submissions to one row per value."""
    i, v = F.col("event_id"), F.col("value")
    wide = table(spark, d, "events").select(
        "event_id",
        F.when(i % 3 == 0, None).otherwise(v.cast("string")).alias("submitted_posted_time"),
        F.when(i % 5 == 0, "x").when(i % 2 == 0, (v * 3).cast("string")).alias("submitted_actual_time"),
    )
    return parse.unpivot_standby(wide)


@query("""WITH raw AS (SELECT l_orderkey, l_linenumber, CAST(l_orderkey % 24 AS INT) * 100 + CAST(l_partkey % 60 AS INT) AS fhour,
    CASE WHEN l_linenumber = 7 THEN 8000 + CAST(l_suppkey % 900 AS INT) ELSE CAST(l_suppkey % 24 AS INT) * 10000 + CAST(l_partkey % 60 AS INT) * 100 + 30 END AS fwin,
    CAST(l_partkey % 12 + 1 AS INT) AS mo, CAST(l_suppkey % 31 + 1 AS INT) AS dy FROM lineitem
), s AS (SELECT *, CASE WHEN fhour >= 100 THEN fhour // 100 ELSE fhour END AS oh, CASE WHEN fhour >= 100 THEN fhour % 100 ELSE 0 END AS om,
    CASE WHEN fwin >= 10000 THEN fwin // 10000 WHEN fwin >= 100 THEN fwin // 100 ELSE fwin END AS rh, CASE WHEN fwin >= 10000 THEN fwin // 100 % 100 WHEN fwin >= 100 THEN fwin % 100 ELSE 0 END AS rm FROM raw
), g AS (SELECT *, least(rh, 23) * 60 + least(rm, 59) - least(oh, 23) * 60 - least(om, 59) AS gap FROM s)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CAST(CASE WHEN TRY_CAST(concat('2023-', mo, '-', dy) AS DATE) IS NULL THEN NULL WHEN fwin >= 8000 AND l_linenumber = 7 THEN 8888 WHEN fwin >= 8000 THEN 8888 WHEN gap < -15 THEN gap + 1440 ELSE gap END AS BIGINT) AS minutes FROM g""", nullable=("minutes",))
def q_priority_minutes(spark: SparkSession, d: str) -> DataFrame:
    """Minutes to the return time from compact clock numbers."""
    n = {c: F.col(c).cast("int") for c in ("l_orderkey", "l_partkey", "l_suppkey")}
    observed = n["l_orderkey"] % 24 * 100 + n["l_partkey"] % 60
    returns = F.when(F.col("l_linenumber") == 7, 8000 + n["l_suppkey"] % 900).otherwise(n["l_suppkey"] % 24 * 10_000 + n["l_partkey"] % 60 * 100 + 30)
    minutes = parse.priority_minutes(F.lit(2023), n["l_partkey"] % 12 + 1, n["l_suppkey"] % 31 + 1, observed, F.lit(None).cast("int"), returns, F.lit(None).cast("int"))
    return table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), minutes.alias("minutes"))


@query(f"""WITH {FACT} SELECT event_id, entity_code, wait_time_minutes FROM (
  SELECT *, row_number() OVER (PARTITION BY entity_code, CAST(park_date AS VARCHAR) ORDER BY event_id DESC) AS rn FROM fact WHERE wait_time_type = 'PRIORITY') WHERE rn = 1""")
def q_collapse_last(spark: SparkSession, d: str) -> DataFrame:
    """The last priority reading per entity and date."""
    rows = facts(spark, d).where(F.col("wait_time_type") == "PRIORITY").select("event_id", "entity_code", "park_date", "wait_time_minutes")
    return dedupe.keep_best(rows, ["entity_code", "park_date"], F.col("event_id"), last=True).drop("park_date")


# ---- time


@query(f"""WITH {FACT} SELECT event_id, park_code, CAST(park_date AS VARCHAR) AS park_date, CAST((extract(hour FROM local_ts) * 60 + extract(minute FROM local_ts) + 1080) % 1440 AS BIGINT) AS mins_since_6am,
  printf('%02d:%02d', extract(hour FROM local_ts), extract(minute FROM local_ts) // 5 * 5) AS time_slot, round(power(0.5, (epoch_us(TIMESTAMP '{_AS_OF} 00:00:00') - observed_us) / 86400e6 / 730), 9) AS geo_decay FROM fact""")
def q_time_features(spark: SparkSession, d: str) -> DataFrame:
    """Operational date, minutes since six, slot and decay weight of every reading."""
    local, now = F.col("local_us"), F.unix_date(F.lit(_AS_OF).cast("date")) * F.lit(86_400_000_000).cast("bigint")
    minute = (F.floor(local / F.lit(60_000_000)) % 1440).cast("bigint")
    return facts(spark, d).select(
        "event_id", "park_code", F.col("park_date").cast("string").alias("park_date"), temporal.minutes_since_start_of_day(local).alias("mins_since_6am"),
        temporal.slot_label(minute).alias("time_slot"), F.round(temporal.geometric_decay((now - F.col("observed_us")) / F.lit(86_400_000_000)), 9).alias("geo_decay"),
    )


@query("""WITH w AS (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + to_minutes(CAST(o_orderkey % 1440 AS INT)) AS wall, CASE o_orderkey % 3 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Los_Angeles' ELSE 'Asia/Tokyo' END AS zone FROM orders),
c AS (SELECT *, wall - to_minutes(CASE zone WHEN 'America/New_York' THEN -240 WHEN 'America/Los_Angeles' THEN -420 ELSE 540 END) AS u1, wall - to_minutes(CASE zone WHEN 'America/New_York' THEN -300 WHEN 'America/Los_Angeles' THEN -480 ELSE 540 END) AS u2,
  date_trunc('hour', wall) - to_minutes(CASE zone WHEN 'America/New_York' THEN -300 WHEN 'America/Los_Angeles' THEN -480 ELSE 540 END) AS u3 FROM w)
SELECT o_orderkey, CASE WHEN (u1 AT TIME ZONE 'UTC') AT TIME ZONE zone = wall THEN epoch_us(u1) WHEN (u2 AT TIME ZONE 'UTC') AT TIME ZONE zone = wall THEN epoch_us(u2) ELSE epoch_us(u3) END AS instant_us FROM c""")
def q_localize(spark: SparkSession, d: str) -> DataFrame:
    """Local order times in three zones to instants; gaps and repeated hours included."""
    key = F.col("o_orderkey")
    zone = F.when(key % 3 == 0, "America/New_York").when(key % 3 == 1, "America/Los_Angeles").otherwise("Asia/Tokyo")
    wall = temporal.wall_clock_us(F.col("o_orderdate")) + key % 1440 * F.lit(60_000_000).cast("bigint")
    return table(spark, d, "orders").select("o_orderkey", instant_of_wall(wall, zone).alias("instant_us"))


@query(f"""WITH {FACT} SELECT event_id, CAST(round_even(value, 0) AS BIGINT) AS shown_actual, CAST(round_even(value / 5, 0) * 5 AS BIGINT) AS shown_posted,
  CASE WHEN event_id % 7 = 0 THEN CAST(event_id % 26 * 60 + event_id % 60 AS BIGINT) END AS minute FROM fact WHERE event_id % 7 <> 0 OR event_id % 26 < 24""", nullable=("minute",))
def q_display_rounding(spark: SparkSession, d: str) -> DataFrame:
    """Rounded values as shown, and clock texts read back to minutes."""
    i = F.col("event_id")
    text = F.when(i % 7 == 0, F.concat(F.lpad((i % 26).cast("string"), 2, "0"), F.lit(":"), F.lpad((i % 60).cast("string"), 2, "0")))
    rows = facts(spark, d).select("event_id", temporal.display_actual(F.col("value")).alias("shown_actual"), temporal.display_posted(F.col("value")).alias("shown_posted"), temporal.clock_minutes(text).alias("minute"))
    return rows.where((i % 7 != 0) | F.col("minute").isNotNull())


# ---- calendar

_SPAN = ("2005-01-01", "2028-12-31")


@query(f"""SELECT CAST(d AS VARCHAR) AS park_date, extract(year FROM d) AS year, extract(month FROM d) AS month, extract(day FROM d) AS day, extract(isodow FROM d) AS day_of_week, extract(quarter FROM d) AS quarter,
  extract(week FROM d) AS week_of_year, extract(doy FROM d) AS day_of_year, strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_mmm, strftime(d, '%A') AS day_of_week_name, strftime(d, '%a') AS day_of_week_ddd,
  strftime(d, '%b-%Y') AS month_year, 'Q' || extract(quarter FROM d) || '-' || extract(year FROM d) AS quarter_year, '''' || strftime(d, '%y') AS year_yy, strftime(d, '%Y') || '_' || lpad(CAST(month(d) AS VARCHAR), 2, '0') || upper(left(strftime(d, '%B'), 3)) AS output_file_label, left(strftime(d, '%B'), 1) AS month_m, left(strftime(d, '%A'), 1) AS day_of_week_d
FROM (SELECT CAST(unnest(generate_series(DATE '{_SPAN[0]}', DATE '{_SPAN[1]}', INTERVAL 1 DAY)) AS DATE) AS d)""")
def q_date_spine(spark: SparkSession, d: str) -> DataFrame:
    """The calendar, one row per day."""
    return calendar.calendar_columns(calendar.date_spine(spark, *_SPAN)).withColumn("park_date", F.col("park_date").cast("string"))


@query(f"""SELECT CAST(d AS VARCHAR) AS park_date, CAST(d - DATE '{_AS_OF}' AS BIGINT) AS cur_day_offset, CAST((year(d) - 2024) * 12 + month(d) - 2 AS BIGINT) AS cur_month_offset, CAST((year(d) - 2024) * 4 + quarter(d) - 1 AS BIGINT) AS cur_quarter_offset,
  CAST(year(d) - 2024 AS BIGINT) AS cur_year_offset, CASE WHEN d > DATE '{_AS_OF}' THEN 'Future' ELSE 'Past' END AS future_date, dayofyear(d) <= 32 AS ytd_flag, day(d) <= 1 AS mtd_flag
FROM (SELECT CAST(unnest(generate_series(DATE '{_SPAN[0]}', DATE '{_SPAN[1]}', INTERVAL 1 DAY)) AS DATE) AS d)""")
def q_relative_dates(spark: SparkSession, d: str) -> DataFrame:
    """Offsets of every day to a given today."""
    return calendar.relative_columns(calendar.date_spine(spark, *_SPAN), _AS_OF).withColumn("park_date", F.col("park_date").cast("string"))


def _calendar(spark: SparkSession) -> DataFrame:
    return calendar.with_date_group(calendar.with_holidays(calendar.date_spine(spark, "2007-01-01", "2026-12-31")))


_HOLIDAYS = " ".join(
    [f"WHEN month(d) = {m} AND day(d) = {x} THEN '{c}'" for c, (m, x) in (("NYE", (12, 31)), ("BOX", (12, 26)), ("CMD", (12, 25)), ("CME", (12, 24)))]
    + ["WHEN month(d) = 11 AND isodow(d) = 4 AND day(d) BETWEEN 22 AND 28 THEN 'THK' WHEN month(d) = 11 AND day(d) = 11 THEN 'VET' WHEN month(d) = 11 AND isodow(d) BETWEEN 2 AND 6 AND day(d) BETWEEN 2 AND 8 THEN 'NJC'"]
    + ["WHEN month(d) = 10 AND day(d) = 31 THEN 'HAL' WHEN month(d) = 10 AND isodow(d) = 1 AND day(d) BETWEEN 8 AND 14 THEN 'COL' WHEN month(d) = 9 AND isodow(d) = 1 AND day(d) <= 7 THEN 'LAB'"]
    + ["WHEN month(d) = 7 AND day(d) = 4 THEN 'IND' WHEN month(d) = 5 AND isodow(d) = 1 AND day(d) >= 25 THEN 'MEM' WHEN d = e + 1 THEN 'ESM' WHEN d = e THEN 'ESS' WHEN d = e - 1 THEN 'EST' WHEN d = e - 2 THEN 'GFR'"]
    + ["WHEN d = e - 46 THEN 'ASH' WHEN d = e - 47 THEN 'MGR' WHEN month(d) = 2 AND isodow(d) = 1 AND day(d) BETWEEN 15 AND 21 THEN 'PRS' WHEN month(d) = 1 AND isodow(d) = 1 AND day(d) BETWEEN 15 AND 21 THEN 'MLK' WHEN month(d) = 1 AND day(d) = 1 THEN 'NYD'"]
)
_NAMES = " ".join("WHEN '{}' THEN '{}'".format(c, n.replace("'", "''")) for c, n in calendar.NAME_OF_HOLIDAY.items())
_GROUPS = " ".join(f"WHEN '{c}' THEN '{g}'" for c, g in calendar.GROUP_OF_HOLIDAY.items())


@query(f"""WITH days AS (SELECT CAST(park_date AS DATE) AS d FROM dimdategroupid), y AS (SELECT DISTINCT year(d) AS y FROM days),
a1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM y), a2 AS (SELECT *, b // 4 AS dd, b % 4 AS e, (b + 8) // 25 AS f FROM a1),
a3 AS (SELECT *, (b - f + 1) // 3 AS g FROM a2), a4 AS (SELECT *, (19 * a + b - dd - g + 15) % 30 AS h, c // 4 AS i, c % 4 AS k FROM a3), a5 AS (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM a4),
a6 AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM a5), east AS (SELECT y, make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS e FROM a6),
coded AS (SELECT d, e, CASE {_HOLIDAYS} ELSE 'NONE' END AS c FROM days JOIN east ON y = year(d)),
paired AS (SELECT d, e, CASE WHEN c = 'PRS' AND lead(c) OVER (ORDER BY d) = 'MGR' THEN 'PMP' WHEN c = 'MGR' AND lag(c) OVER (ORDER BY d) = 'PRS' THEN 'PMM' ELSE c END AS c FROM coded)
SELECT CAST(d AS VARCHAR) AS park_date, c AS holidaycode, CASE c {_NAMES} ELSE 'None' END AS holidayname, CASE WHEN month(d) = 12 AND day(d) BETWEEN 27 AND 30 THEN 'DEC' || day(d) WHEN c = 'NJC' THEN 'JERSEY_WEEK_' || upper(strftime(d, '%a'))
  ELSE CASE c {_GROUPS} ELSE CASE WHEN month(d) IN (3, 4) THEN CASE WHEN d >= e - 2 THEN 'AFTER_EASTER_' ELSE 'BEFORE_EASTER_' END ELSE '' END || upper(strftime(d, '%b')) || '_WEEK' ||
    CASE WHEN day(d) > 21 THEN '4OR5' ELSE ((day(d) - 1) // 7 + 1)::VARCHAR END || '_' || upper(strftime(d, '%a')) END END AS date_group_id FROM paired""")
def q_date_groups(spark: SparkSession, d: str) -> DataFrame:
    """Holiday and date group of every day of the date-group dimension."""
    return _calendar(spark).select(F.col("park_date").cast("string").alias("park_date"), "holidaycode", "holidayname", "date_group_id")


_CASES = "\n".join(
    f"SELECT {i} AS rank, '{p}' AS p, '{label}' AS label, {a} AS a, {b} AS b" + (" UNION ALL" if i < len(calendar.HOLIDAY_SEASONS) - 1 else "") for i, (p, label, a, b) in enumerate(calendar.HOLIDAY_SEASONS)
)
_PLAIN = " ".join(f"WHEN regexp_matches(g, '{p}') THEN '{label}'" for p, label in calendar.PLAIN_SEASONS)


SEASON_SQL = f"""WITH days AS (SELECT CAST(park_date AS DATE) AS d, date_group_id AS g FROM dimdategroupid), pats AS ({_CASES}),
first_ AS (SELECT x.d, arg_min(p.label, p.rank) AS label FROM days x JOIN days m ON m.d BETWEEN x.d - 3 AND x.d + 3 JOIN pats p ON regexp_matches(m.g, p.p) AND m.d - p.a <= x.d AND x.d <= m.d + p.b GROUP BY x.d),
base AS (SELECT days.d, g, CASE WHEN (month(days.d) = 12 AND day(days.d) >= 27) OR (month(days.d) = 1 AND day(days.d) = 1) THEN 'CHRISTMAS_PEAK' ELSE label END AS s FROM days LEFT JOIN first_ ON first_.d = days.d),
claim AS (SELECT DISTINCT x.d FROM base x JOIN base a ON a.s = 'PRESIDENTS_DAY' AND abs(x.d - a.d) <= 3 JOIN base b ON b.s = 'MARDI_GRAS' AND abs(a.d - b.d) <= 3),
full_ AS (SELECT base.d, CASE WHEN claim.d IS NOT NULL THEN 'PRESIDENTS_DAY_MARDI_GRAS' ELSE coalesce(s, CASE {_PLAIN} ELSE '' END) END AS season FROM base LEFT JOIN claim ON claim.d = base.d)
SELECT CAST(d AS VARCHAR) AS park_date, season, season || '_' || (year(d) - CASE WHEN month(d) = 1 AND season IN ('CHRISTMAS', 'CHRISTMAS_PEAK') THEN 1 ELSE 0 END) AS season_year FROM full_"""


@query(SEASON_SQL)
def q_season(spark: SparkSession, d: str) -> DataFrame:
    """Season and season year of every day of the date-group dimension."""
    days = table(spark, d, "dimdategroupid").select(F.col("park_date").cast("date").alias("park_date"), "date_group_id")
    return calendar.with_season(days).select(F.col("park_date").cast("string").alias("park_date"), "season", "season_year")


# ---- keys and state


@query(f"""WITH {FACT} SELECT event_id, entity_code FROM (
  SELECT *, row_number() OVER (PARTITION BY entity_code, wait_time_type, wait_time_minutes ORDER BY event_id) AS rn FROM fact WHERE event_id > 2000) b
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM fact k WHERE k.event_id <= 2000 AND k.entity_code = b.entity_code AND k.wait_time_type = b.wait_time_type AND k.wait_time_minutes = b.wait_time_minutes)""")
def q_new_rows_antijoin(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a batch whose key was not stored before, each key once."""
    rows = facts(spark, d).select("event_id", "entity_code", "wait_time_type", "wait_time_minutes")
    known, batch = rows.where(F.col("event_id") <= 2000), rows.where(F.col("event_id") > 2000)
    return dedupe.new_rows(batch, known, ["entity_code", "wait_time_type", "wait_time_minutes"], F.col("event_id")).select("event_id", "entity_code")


_INDEX = """SELECT entity_code, CAST(max(park_date) AS VARCHAR) AS latest_park_date, max(observed_us) AS latest_observed_us, min(observed_us) AS first_seen_us, count(*) AS row_count,
  count(*) FILTER (wait_time_type = 'ACTUAL') AS actual_count, count(*) FILTER (wait_time_type = 'POSTED') AS posted_count, count(*) FILTER (wait_time_type = 'PRIORITY') AS priority_count FROM fact GROUP BY entity_code"""


@query(f"WITH {FACT} {_INDEX}")
def q_entity_index(spark: SparkSession, d: str) -> DataFrame:
    """Latest values and counts per entity."""
    return dedupe.entity_index(facts(spark, d)).withColumn("latest_park_date", F.col("latest_park_date").cast("string"))


@query(f"WITH {FACT} {_INDEX}")
def q_index_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The index of a first batch merged with that of a later one; late rows count."""
    rows = facts(spark, d)
    state, delta = dedupe.entity_index(rows.where(F.col("event_id") % 3 != 0)), dedupe.entity_index(rows.where(F.col("event_id") % 3 == 0))
    return dedupe.upsert_index(state, delta).withColumn("latest_park_date", F.col("latest_park_date").cast("string"))


@query(f"""WITH {FACT}, idx AS ({_INDEX}), m AS (SELECT entity_code, max(observed_us) AS last_modeled_us FROM fact WHERE wait_time_type = 'ACTUAL' GROUP BY 1)
SELECT idx.entity_code, idx.latest_observed_us FROM idx LEFT JOIN m USING (entity_code) WHERE (last_modeled_us IS NULL OR latest_observed_us > last_modeled_us) AND actual_count >= 5""")
def q_needs_modeling(spark: SparkSession, d: str) -> DataFrame:
    """Entities with readings after their last model."""
    rows = facts(spark, d)
    modeled = rows.where(F.col("wait_time_type") == "ACTUAL").groupBy("entity_code").agg(F.max("observed_us").alias("last_modeled_us"))
    return dedupe.needs_modeling(dedupe.entity_index(rows), modeled, min_actual=5).select("entity_code", "latest_observed_us")


# ---- encodings and split


@query("""SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE (SELECT count(DISTINCT k.c_mktsegment) FROM customer k WHERE k.c_mktsegment < c.c_mktsegment AND k.c_mktsegment <> 'BUILDING') END AS code FROM customer c""", nullable=("code",))
def q_label_encode(spark: SparkSession, d: str) -> DataFrame:
    """Sorted label codes of segments; one segment is unknown to the mapping."""
    rows = table(spark, d, "customer")
    mapping = features.label_mapping(rows.where(F.col("c_mktsegment") != "BUILDING"), "c_mktsegment")
    return features.label_encode(rows, "c_mktsegment", mapping).select("c_custkey", F.col("c_mktsegment_code").alias("code"))


@query("""SELECT o_orderkey, CAST(coalesce(o_orderstatus = 'F', FALSE) AS INT) AS o_orderstatus_F, CAST(coalesce(o_orderstatus = 'O', FALSE) AS INT) AS o_orderstatus_O, CAST(coalesce(o_orderstatus = 'P', FALSE) AS INT) AS o_orderstatus_P FROM orders""")
def q_one_hot(spark: SparkSession, d: str) -> DataFrame:
    """Indicator columns of the order status."""
    return features.one_hot(table(spark, d, "orders"), "o_orderstatus", ["F", "O", "P"]).select("o_orderkey", "o_orderstatus_F", "o_orderstatus_O", "o_orderstatus_P")


@query(f"""WITH {FACT}, days AS (SELECT park_date, dense_rank() OVER (ORDER BY park_date) - 1 AS r FROM (SELECT DISTINCT park_date FROM fact)), n AS (SELECT count(*) AS n FROM days)
SELECT event_id, CASE WHEN r < floor(n * 0.7::DOUBLE) THEN 'train' WHEN r < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split FROM fact JOIN days USING (park_date), n""")
def q_chrono_split(spark: SparkSession, d: str) -> DataFrame:
    """Training, validation and test by whole dates."""
    return features.chronological_split(facts(spark, d).select("event_id", "park_date"), "park_date").select("event_id", "split")


@query("""SELECT event_id, CASE WHEN event_id % 11 = 0 THEN (SELECT median(value) FROM events WHERE event_id % 11 <> 0) ELSE value END AS value, CASE WHEN event_id % 13 = 0 THEN (
  SELECT event_type FROM (SELECT event_type, count(*) AS n FROM events WHERE event_id % 13 <> 0 GROUP BY 1) ORDER BY n DESC, event_type LIMIT 1) ELSE event_type END AS event_type FROM events""")
def q_impute(spark: SparkSession, d: str) -> DataFrame:
    """Nulls filled with the median and the mode."""
    i = F.col("event_id")
    rows = table(spark, d, "events").select("event_id", F.when(i % 11 != 0, F.col("value")).alias("value"), F.when(i % 13 != 0, F.col("event_type")).alias("event_type"))
    return features.impute(rows, ["value"], ["event_type"])


# ---- reports


@query(f"""WITH {FACT}, v AS (SELECT *, CASE wait_time_type WHEN 'POSTED' THEN wait_time_minutes BETWEEN 0 AND 1000 WHEN 'ACTUAL' THEN wait_time_minutes BETWEEN 0 AND 1000 WHEN 'PRIORITY' THEN wait_time_minutes BETWEEN -100 AND 2000 OR wait_time_minutes = 8888 ELSE FALSE END AS ok FROM fact)
SELECT wait_time_type, count(*) AS total, count(*) FILTER (NOT ok) AS invalid, count(*) FILTER (NOT ok OR (wait_time_type IN ('POSTED', 'ACTUAL') AND wait_time_minutes >= 300)) AS outliers FROM v GROUP BY 1""")
def q_validate(spark: SparkSession, d: str) -> DataFrame:
    """Valid and outlying readings per type."""
    valid, outlier = parse.validity(F.col("wait_time_type"), F.col("wait_time_minutes").cast("string"))
    return facts(spark, d).groupBy("wait_time_type").agg(F.count(F.lit(1)).alias("total"), F.count_if(~valid).alias("invalid"), F.count_if(outlier).alias("outliers"))


@query(f"""WITH {FACT} SELECT event_id, wait_time_type FROM (SELECT *, row_number() OVER (PARTITION BY wait_time_type ORDER BY wait_time_minutes DESC, event_id) AS rn FROM fact) WHERE rn <= 5""")
def q_sample_per_group(spark: SparkSession, d: str) -> DataFrame:
    """The five longest waits of each type."""
    return reports.first_per_group(facts(spark, d).select("event_id", "wait_time_type", "wait_time_minutes"), ["wait_time_type"], [F.col("wait_time_minutes").desc(), F.col("event_id")], 5).select("event_id", "wait_time_type")


@query("""SELECT CAST(CASE WHEN q < 10 THEN 0 WHEN q < 20 THEN 1 WHEN q < 40 THEN 2 ELSE 3 END AS BIGINT) AS bin, count(*) AS n, round(avg(abs(e)), 6) AS mae, round(median(abs(e)), 6) AS median_error, round(sqrt(avg(e * e)), 4) AS rmse, round(median(CASE WHEN o > 0 THEN abs(e) / o * 100 END), 6) AS median_ape,
  round(avg(CASE WHEN o > 0 THEN abs(e) / o * 100 END), 6) AS mape, round(1 - sum(e * e) / nullif(var_pop(o) * count(o), 0), 6) AS r2
FROM (SELECT l_quantity AS q, l_extendedprice AS o, l_quantity * 1500 - l_extendedprice AS e FROM lineitem) GROUP BY 1""")
def q_accuracy_bins(spark: SparkSession, d: str) -> DataFrame:
    """Error metrics of a price guess per quantity bin."""
    rows = table(spark, d, "lineitem").select(reports.bin_label(F.col("l_quantity"), [0, 10, 20, 40]).cast("bigint").alias("bin"), "l_extendedprice", (F.col("l_quantity") * 1500).alias("guess"))
    table_ = reports.error_metrics(rows, ["bin"], "l_extendedprice", "guess")
    return table_.withColumns({c: F.round(c, 4 if c == "rmse" else 6) for c in ("mae", "median_error", "rmse", "mape", "median_ape", "r2")})


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def q_unmapped(spark: SparkSession, d: str) -> DataFrame:
    """Orders without any line."""
    return table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, abs(l_quantity * 1500 - l_extendedprice) AS error FROM lineitem ORDER BY error DESC, l_orderkey, l_linenumber LIMIT 20""")
def q_topk_errors(spark: SparkSession, d: str) -> DataFrame:
    """The twenty worst price guesses."""
    error = F.abs(F.col("l_quantity") * 1500 - F.col("l_extendedprice")).alias("error")
    rows = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), error)
    return rows.orderBy(F.col("error").desc(), "l_orderkey", "l_linenumber").limit(20)


@query(f"""WITH {FACT}, parks AS (SELECT DISTINCT park_code FROM fact), days AS (SELECT DISTINCT park_date FROM fact), c AS (SELECT park_code, park_date, count(*) AS n FROM fact WHERE wait_time_type = 'ACTUAL' GROUP BY ALL)
SELECT park_code, CAST(park_date AS VARCHAR) AS park_date, coalesce(n, 0) AS n_rows FROM parks CROSS JOIN days LEFT JOIN c USING (park_code, park_date)""")
def q_coverage_grid(spark: SparkSession, d: str) -> DataFrame:
    """Actual readings per park and date, zeros included."""
    rows = facts(spark, d)
    parks = rows.agg(F.collect_set("park_code").alias("p"))
    grid = rows.select("park_date").distinct().withColumn("p", parks.scalar()).select("park_date", F.explode("p").alias("park_code"))
    return reports.coverage(grid, rows.where(F.col("wait_time_type") == "ACTUAL"), ["park_code", "park_date"]).withColumn("park_date", F.col("park_date").cast("string"))


_OPENED = " ".join(f"WHEN '{p}' THEN TIMESTAMP '{day}'" for p, day in clean.OPENED_BY_PARK.items())


@query(f"""SELECT entity_code, CASE WHEN trim(entity_name) IN ('', 'nan') THEN NULL ELSE trim(entity_name) END AS entity_name, CASE WHEN trim(park_code) IN ('', 'nan') THEN NULL ELSE lower(trim(park_code)) END AS park_code,
  CAST(coalesce(try_strptime(trim(opened_on), ['%Y-%m-%d', '%m/%d/%Y']), CASE lower(trim(park_code)) {_OPENED} ELSE TIMESTAMP '1955-07-17' END) AS DATE)::VARCHAR AS opened_on, CAST(coalesce(try_strptime(trim(extinct_on), ['%Y-%m-%d', '%m/%d/%Y']), TIMESTAMP '2099-01-01') AS DATE)::VARCHAR AS extinct_on,
  coalesce(lower(trim(fastpass_booth)) IN ('true', '1', 'yes', 'y', 't'), FALSE) AS fastpass_booth, CASE WHEN height_restriction >= 0 THEN CAST(height_restriction AS BIGINT) END AS height_restriction, CASE WHEN duration > 0 THEN duration END AS duration FROM dimentity""", nullable=("height_restriction",))
def q_clean_entities(spark: SparkSession, d: str) -> DataFrame:
    """The attraction dimension, cleaned."""
    rows = clean.clean_entities(table(spark, d, "dimentity"))
    return rows.select(
        F.trim(F.col("entity_code")).alias("entity_code"), "entity_name", "park_code", F.col("opened_on").cast("string").alias("opened_on"), F.col("extinct_on").cast("string").alias("extinct_on"), "fastpass_booth",
        F.col("height_restriction").cast("bigint").alias("height_restriction"), "duration",
    )


_PROFILED = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint", "message_id": "string", "in_reply_to": "string", "thread_id": "bigint", "date_header": "string", "from_addr": "string"}


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{kind}' AS type, count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_null, round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 6) AS null_percent, {f"count(*) FILTER ({c} = '')" if kind == "string" else "0"} AS n_empty,
  (SELECT coalesce(string_agg(v, ' | ' ORDER BY v), '') FROM (SELECT DISTINCT left(CAST({c} AS VARCHAR), 80) AS v FROM documents WHERE {c} IS NOT NULL ORDER BY v LIMIT 3)) AS samples FROM documents"""
    for c, kind in _PROFILED.items()
))
def q_profile(spark: SparkSession, d: str) -> DataFrame:
    """Type, nulls, empty texts and examples per column."""
    return reports.profile(table(spark, d, "documents"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL""")
def q_json_flatten(spark: SparkSession, d: str) -> DataFrame:
    """A number out of the JSON properties."""
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k")).where(F.col("k").isNotNull())


@query(f"""WITH {FACT} SELECT entity_code, wait_time_type, count(*) AS n FROM fact WHERE park_code = 'tdl' AND wait_time_type <> 'OTHER' GROUP BY ALL""")
def q_partition_scan(spark: SparkSession, d: str) -> DataFrame:
    """Counts of one park's entities."""
    return facts(spark, d).where((F.col("park_code") == "tdl") & (F.col("wait_time_type") != "OTHER")).groupBy("entity_code", "wait_time_type").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT s_suppkey, CASE n_name WHEN 'JAPAN' THEN 'Asia/Tokyo' ELSE 'America/New_York' END AS zone FROM (SELECT s_suppkey, upper(n_name) AS n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)""")
def q_dimension_join(spark: SparkSession, d: str) -> DataFrame:
    """A payload column of a small dimension on every fact."""
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.upper("n_name").alias("n_name"))
    joined = features.join_dimension(table(spark, d, "supplier"), nations, ["s_nationkey"], ["n_name"], require=True)
    park = F.when(F.col("n_name") == "JAPAN", "tdl").otherwise("mk")
    return joined.select("s_suppkey", zone_of_park(park).alias("zone"))
