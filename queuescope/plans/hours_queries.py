"""Queries over wait-time facts and versioned park hours together: features, curves, accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuescope.constants import VERSION_ORDER, ZONES
from queuescope.functions import calendar, temporal
from queuescope.functions.codes import zone_of_park
from queuescope.functions.timestamps import wall_us
from queuescope.operators import aggregates, curves, features, model, reports
from queuescope.operators.hours import usable_hours, with_hours_instants
from queuescope.operators.known import hours_as_known
from queuescope.operators.readings import typed_readings
from queuescope.plans import problem_sql as q
from queuescope.plans.core_queries import SEASON_SQL
from queuescope.plans.facts import query
from queuescope.session import cut, spread, table

NOW = "2024-02-01"
_NOW_US = f"epoch_us(TIMESTAMP '{NOW} 00:00:00')"


def _readings(spark: SparkSession, d: str) -> DataFrame:
    rows = typed_readings(table(spark, d, "dedupe_keys"), ("ingest_seq", "entity", "kind", "park", "park_day", "observed_us", "minutes"))
    return rows.withColumn("park", F.upper("park"))


def _hours(spark: SparkSession, d: str) -> DataFrame:
    return cut(usable_hours(with_hours_instants(spread(table(spark, d, "dimparkhours_with_donor")))))


def _groups(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dimdategroupid").select(F.col("park_date").cast("date").alias("park_date"), "date_group_id")


# ---- features

_LOCAL = "((make_timestamp({us}) AT TIME ZONE 'UTC') AT TIME ZONE zone)"
_PLACED = f"""placed AS (SELECT *, {q.PARK_ZONE.format(p="park")} AS zone FROM (
  SELECT ingest_seq, entity, kind, us, m, CASE regexp_extract(entity, '^[^0-9]*') WHEN 'USH' THEN 'UH' ELSE regexp_extract(entity, '^[^0-9]*') END AS park FROM readings)
), dated AS (SELECT *, CAST({_LOCAL.format(us="us")} - INTERVAL 6 HOUR AS DATE) AS day, {_LOCAL.format(us="us")} AS local_ts FROM placed)"""
_RANK = "CASE u.version_type WHEN 'official' THEN 1 WHEN 'final' THEN 2 WHEN 'predicted' THEN 3 ELSE 4 END, u.valid_from DESC, u.created_at DESC, u.hours_id"


@query(
    f"""WITH {q.READINGS}, {q.USABLE}, {_PLACED}, season AS ({SEASON_SQL}),
ranked AS (SELECT d.ingest_seq, u.*, row_number() OVER (PARTITION BY d.ingest_seq ORDER BY {_RANK}) AS rn FROM dated d JOIN usable u
  ON u.park = d.park AND u.park_date = CAST(d.day AS VARCHAR) AND epoch_us(u.valid_from) <= d.us AND epoch_us(u.created_at) <= d.us WHERE u.version_type IN ('official', 'final', 'predicted', 'historical'))
SELECT d.ingest_seq, lower(d.park) AS park_code, CAST(d.day AS VARCHAR) AS park_date, CAST((extract(hour FROM local_ts) * 60 + extract(minute FROM local_ts) + 1080) % 1440 AS BIGINT) AS pred_mins_since_6am,
  g.date_group_id AS pred_dategroupid, s.season AS pred_season, s.season_year AS pred_season_year, round(power(0.5, ({_NOW_US} - d.us) / 86400e6 / 730), 9) AS wgt_geo_decay, d.m AS observed_wait_time,
  round((d.us - h.open_us) / 60e6, 6) AS pred_mins_since_park_open, extract(hour FROM {_LOCAL.format(us="h.open_us")}) AS pred_park_open_hour, extract(hour FROM {_LOCAL.format(us="h.close_us")}) AS pred_park_close_hour,
  round((h.close_us - h.open_us) / 3600e6 + CASE WHEN h.close_us < h.open_us THEN 24 ELSE 0 END, 6) AS pred_park_hours_open, h.em AS pred_emh_morning, h.ev AS pred_emh_evening
FROM dated d JOIN dimdategroupid g ON g.park_date = CAST(d.day AS VARCHAR) LEFT JOIN season s ON s.park_date = g.park_date LEFT JOIN ranked h ON h.ingest_seq = d.ingest_seq AND h.rn = 1""",
    nullable=("observed_wait_time", "pred_park_open_hour", "pred_park_close_hour"),
)
def q_feature_row(spark: SparkSession, d: str) -> DataFrame:
    """Every feature of every reading, with the park hours as known at its time."""
    return _features(spark, d, _readings(spark, d)).withColumn("park_date", F.col("park_date").cast("string")).select(
        "ingest_seq", F.lower("park").alias("park_code"), "park_date", "pred_mins_since_6am", "pred_dategroupid", "pred_season", "pred_season_year", F.round("wgt_geo_decay", 9).alias("wgt_geo_decay"), "observed_wait_time",
        F.round("pred_mins_since_park_open", 6).alias("pred_mins_since_park_open"), "pred_park_open_hour", "pred_park_close_hour", F.round("pred_park_hours_open", 6).alias("pred_park_hours_open"), "pred_emh_morning", "pred_emh_evening",
    )


def _features(spark: SparkSession, d: str, readings: DataFrame) -> DataFrame:
    known = hours_as_known(readings, _hours(spark, d)).select("ingest_seq", "opening_us", "closing_us", "emh_morning", "emh_evening")
    rows = readings.join(known, "ingest_seq", "left").withColumnsRenamed({"entity": "entity_code", "park_day": "park_date", "minutes": "wait_time_minutes", "kind": "wait_time_type"})
    groups = _groups(spark, d)
    rows = rows.withColumns({"zone": zone_of_park(F.col("park")), "park_code": F.lower("park")})
    now = F.unix_date(F.lit(NOW).cast("date")) * F.lit(86_400_000_000).cast("bigint")
    return features.feature_pipeline(rows, groups, calendar.with_season(groups).select("park_date", "season", "season_year"), now)


# ---- curves

_DAYS = f"""days AS (SELECT DISTINCT park, day, zone FROM dated),
best AS (SELECT *, row_number() OVER (PARTITION BY u.park, u.park_date ORDER BY {_RANK}) AS rn FROM usable u WHERE u.version_type IN ('official', 'final', 'predicted', 'historical')),
hrs AS (SELECT d.*, coalesce(extract(hour FROM {_LOCAL.format(us="b.open_us")}) * 60 + extract(minute FROM {_LOCAL.format(us="b.open_us")}), 540) AS o, coalesce(extract(hour FROM {_LOCAL.format(us="b.close_us")}) * 60 + extract(minute FROM {_LOCAL.format(us="b.close_us")}), 1320) AS c
  FROM days d LEFT JOIN best b ON b.park = d.park AND b.park_date = CAST(d.day AS VARCHAR) AND b.rn = 1),
mins AS (SELECT unnest(generate_series(0, 2879)) AS mi),
grid AS (SELECT h.park, h.day, h.zone, mi, printf('%02d:%02d', mi % 1440 // 60, mi % 60) AS time_slot, CAST(h.day AS TIMESTAMP) + to_minutes(CAST(mi AS INT)) AS wall FROM hrs h JOIN mins
  ON mi BETWEEN h.o AND CASE WHEN h.c < h.o THEN h.c + 1440 ELSE h.c END AND (CASE WHEN mi // 60 = h.o // 60 THEN (mi - h.o) % 5 = 0 ELSE mi % 60 % 5 = 0 END)),
off AS (SELECT *, CASE zone WHEN 'America/New_York' THEN -300 WHEN 'America/Los_Angeles' THEN -480 ELSE 540 END AS std, CASE zone WHEN 'Asia/Tokyo' THEN 0 ELSE 60 END AS dst FROM grid),
timed AS (SELECT *, CASE WHEN ((wall - to_minutes(std + dst)) AT TIME ZONE 'UTC') AT TIME ZONE zone = wall THEN epoch_us(wall - to_minutes(std + dst)) WHEN ((wall - to_minutes(std)) AT TIME ZONE 'UTC') AT TIME ZONE zone = wall THEN epoch_us(wall - to_minutes(std))
  ELSE epoch_us(date_trunc('hour', wall) - to_minutes(std)) END AS at_us FROM off),
slots AS (SELECT e.entity, e.park, t.day, t.mi, t.time_slot, t.at_us FROM (SELECT DISTINCT entity, park, day FROM dated) e JOIN timed t ON t.park = e.park AND t.day = e.day),
means AS (SELECT entity, avg(m) AS prediction FROM dated WHERE kind = 'ACTUAL' AND m IS NOT NULL GROUP BY entity)"""


def _best(hours: DataFrame) -> tuple[DataFrame, Column]:
    kind = F.lower(F.trim("version_type"))
    place = F.array_position(F.array(*map(F.lit, VERSION_ORDER)), kind)
    rank = F.struct((-place).alias("p"), F.unix_micros("valid_from").alias("v"), F.unix_micros("created_at").alias("c"), (-F.col("hours_id")).alias("i"))
    return hours.where(place > 0), rank


def _slots(spark: SparkSession, d: str, readings: DataFrame) -> DataFrame:
    hours, rank = _best(_hours(spark, d))
    days = cut(curves.hours_of_day(hours, rank, wanted=readings.select("park", "park_day")))
    return cut(curves.slots_of(readings.select("entity", "park", "park_day"), days, zone_of_park(F.col("park"))))


def _mean_model(readings: DataFrame):
    means = readings.where((F.col("kind") == "ACTUAL") & F.col("minutes").isNotNull()).groupBy("entity").agg(F.avg("minutes").alias("prediction"))
    return lambda slots: slots.join(means, "entity", "left")


@query(f"""WITH {q.READINGS}, {q.USABLE}, {_PLACED}, {_DAYS},
act AS (SELECT s.entity, s.day, s.mi, arg_min(r.m, (abs(r.us - s.at_us), r.ingest_seq)) AS v FROM slots s JOIN dated r ON r.entity = s.entity AND r.day = s.day AND r.kind = 'ACTUAL' AND r.m IS NOT NULL AND abs(r.us - s.at_us) <= 300000000 GROUP BY ALL),
nx AS (SELECT s.entity, s.day, s.mi, arg_min(r.m, (r.us, r.ingest_seq)) AS v, min(r.us) - any_value(s.at_us) AS gap FROM slots s JOIN dated r ON r.entity = s.entity AND r.day = s.day AND r.kind = 'POSTED' AND r.m IS NOT NULL AND r.us >= s.at_us GROUP BY ALL),
pv AS (SELECT s.entity, s.day, s.mi, arg_min(r.m, (-r.us, r.ingest_seq)) AS v, any_value(s.at_us) - max(r.us) AS gap FROM slots s JOIN dated r ON r.entity = s.entity AND r.day = s.day AND r.kind = 'POSTED' AND r.m IS NOT NULL AND r.us < s.at_us GROUP BY ALL)
SELECT s.entity, CAST(s.day AS VARCHAR) AS park_date, s.time_slot, round(coalesce(act.v, CASE WHEN CASE WHEN nx.mi IS NOT NULL THEN nx.gap <= 600000000 ELSE pv.gap <= 900000000 END THEN greatest(means.prediction, 0) END), 6) AS actual,
  CASE WHEN act.v IS NOT NULL THEN 'observed' ELSE 'imputed' END AS source
FROM slots s LEFT JOIN act USING (entity, day, mi) LEFT JOIN nx USING (entity, day, mi) LEFT JOIN pv USING (entity, day, mi) LEFT JOIN means USING (entity)""")
def q_backfill_curve(spark: SparkSession, d: str) -> DataFrame:
    """Past curves of every entity and day: observed waits, else the entity's mean model where a posted time stands beside."""
    readings = cut(_readings(spark, d))
    seen = curves.slot_observations(_slots(spark, d, readings), readings)
    curve = curves.backfill_curve(seen, _mean_model(readings))
    return curve.select("entity", F.col("park_day").cast("string").alias("park_date"), "time_slot", F.round("actual", 6).alias("actual"), "source")


_AGG = f"""posted AS (SELECT d.entity AS entity_code, g.date_group_id AS dategroupid, CAST(extract(hour FROM local_ts) AS BIGINT) AS hour, m AS v, 1.0 / (1.0 + (DATE '{NOW}' - d.day) / 365.0) AS w, d.day
  FROM dated d JOIN dimdategroupid g ON g.park_date = CAST(d.day AS VARCHAR) WHERE kind = 'POSTED' AND m IS NOT NULL),
half AS (SELECT *, sum(w) OVER (PARTITION BY entity_code, dategroupid, hour ORDER BY v RANGE UNBOUNDED PRECEDING) AS cu, sum(w) OVER (PARTITION BY entity_code, dategroupid, hour) AS t FROM posted),
agg AS (SELECT entity_code, dategroupid, hour, min(CASE WHEN cu >= t / 2 - 1e-12 * t THEN v END) AS pm, count(v) AS posted_count, avg(w) AS avg_recency_weight FROM half GROUP BY ALL)"""
_LEVELS = """LEFT JOIN agg a ON a.entity_code = w.entity_code AND a.dategroupid = w.dategroupid AND a.hour = w.hour
LEFT JOIN (SELECT entity_code, dategroupid, median(pm) AS v FROM agg GROUP BY ALL) b ON b.entity_code = w.entity_code AND b.dategroupid = w.dategroupid
LEFT JOIN (SELECT entity_code, hour, median(pm) AS v FROM agg GROUP BY ALL) c ON c.entity_code = w.entity_code AND c.hour = w.hour
LEFT JOIN (SELECT entity_code, median(pm) AS v FROM agg GROUP BY ALL) e ON e.entity_code = w.entity_code
LEFT JOIN (SELECT left(entity_code, 2) AS pre, hour, median(pm) AS v FROM agg GROUP BY ALL) p ON p.pre = left(w.entity_code, 2) AND p.hour = w.hour"""
_PREDICTED = "coalesce(a.pm, b.v, c.v, e.v, p.v)"


def _posted(spark: SparkSession, d: str, readings: DataFrame) -> DataFrame:
    """Posted readings with date group, local hour and weight."""
    local = wall_us(F.col("observed_us"), zone_of_park(F.col("park")), ZONES)
    rows = readings.where((F.col("kind") == "POSTED") & F.col("minutes").isNotNull()).withColumnRenamed("park_day", "park_date").join(_groups(spark, d), "park_date")
    return rows.select(
        "ingest_seq", F.col("entity").alias("entity_code"), F.lower("park").alias("park_code"), "park_date", F.col("date_group_id").alias("dategroupid"), F.pmod(F.floor(local / F.lit(3_600_000_000)), F.lit(24)).cast("bigint").alias("hour"),
        F.col("minutes").alias("wait_time_minutes"), temporal.recency_weight(F.datediff(F.lit(NOW).cast("date"), "park_date")).alias("weight"),
    )


@query(
    f"""WITH {q.READINGS}, {q.USABLE}, {_PLACED}, {_DAYS}, {_AGG},
w AS (SELECT s.entity AS entity_code, s.day, s.mi, s.time_slot, g.date_group_id AS dategroupid, s.mi // 60 % 24 AS hour FROM slots s LEFT JOIN dimdategroupid g ON g.park_date = CAST(s.day AS VARCHAR))
SELECT * FROM (SELECT w.entity_code AS entity, CAST(w.day AS VARCHAR) AS park_date, w.time_slot, CAST(round_even(greatest(means.prediction, 0), 0) AS BIGINT) AS actual_predicted, CAST(round_even({_PREDICTED} / 5, 0) * 5 AS BIGINT) AS posted_predicted
  FROM w {_LEVELS} LEFT JOIN means ON means.entity = w.entity_code) WHERE actual_predicted IS NOT NULL OR posted_predicted IS NOT NULL""",
    nullable=("actual_predicted", "posted_predicted"),
)
def q_forecast_curve(spark: SparkSession, d: str) -> DataFrame:
    """Forecast curves of every entity, day and slot: mean model, and posted times over all five levels."""
    readings = cut(_readings(spark, d))
    groups = _groups(spark, d).select(F.col("park_date").alias("park_day"), F.col("date_group_id").alias("dategroupid"))
    posted = aggregates.posted_aggregates(_posted(spark, d, readings))
    curve = curves.forecast_curve(_slots(spark, d, readings), posted, groups, _mean_model(readings))
    return curve.select("entity", F.col("park_day").cast("string").alias("park_date"), "time_slot", "actual_predicted", "posted_predicted")


# ---- accuracy


_BINNED = """SELECT binning, bin, count(*) AS n, {what} FROM ({rows}) GROUP BY binning, bin"""


def _edges(value: str, edges: list, end: bool = True) -> str:
    inner = " ".join(f"WHEN {value} >= {a} AND {value} < {b} THEN '{a}-{b}'" for a, b in zip(edges, edges[1:], strict=False))
    return f"CASE {inner} {f"WHEN {value} >= {edges[-1]} THEN '{edges[-1]}+'" if end else ''} END"


def _unpivoted(source: str, binnings: dict[str, str], columns: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS binning, {value} AS bin, {columns} FROM {source} WHERE {value} IS NOT NULL" for name, value in binnings.items())


_POSTED_BINS = {
    "overall": "'all'", "weight": _edges("avg_recency_weight", [0.0, 0.3, 0.5, 0.7, 0.9, 1.0], False), "count": _edges("posted_count", [0, 10, 50, 100, 500]),
    "park": "park_code", "hour": "CAST(hour AS VARCHAR)", "days_ago": _edges("days_ago", [0, 7, 30, 90, 180, 365]),
}


@query(f"""WITH {q.READINGS}, {_PLACED}, {_AGG}, w AS (SELECT d.entity AS entity_code, lower(d.park) AS park_code, d.day, g.date_group_id AS dategroupid, CAST(extract(hour FROM local_ts) AS BIGINT) AS hour, d.m
  FROM dated d JOIN dimdategroupid g ON g.park_date = CAST(d.day AS VARCHAR) WHERE d.kind = 'POSTED' AND d.m IS NOT NULL),
acc AS (SELECT w.*, abs({_PREDICTED} - m) AS error, CASE WHEN m > 0 THEN abs({_PREDICTED} - m) / m * 100 END AS pct, a.avg_recency_weight, a.posted_count, DATE '{NOW}' - w.day AS days_ago FROM w {_LEVELS} WHERE {_PREDICTED} IS NOT NULL)
{_BINNED.format(what="round(avg(error), 6) AS mean_error, round(median(error), 6) AS median_error, round(avg(pct), 6) AS mean_pct_error, round(median(pct), 6) AS median_pct_error", rows=_unpivoted("acc", _POSTED_BINS, "error, pct"))}""")
def q_posted_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Observed against predicted posted times, overall and in five binnings."""
    rows = cut(_posted(spark, d, _readings(spark, d)))
    accuracy = cut(reports.posted_accuracy(rows.drop("weight"), cut(aggregates.posted_aggregates(rows)), NOW))
    table_ = reports.posted_accuracy_bins(accuracy)
    return table_.withColumns({c: F.round(c, 6) for c in ("mean_error", "median_error", "mean_pct_error", "median_pct_error")})


def _hours_minutes(spark: SparkSession, d: str) -> DataFrame:
    def of_day(us: str) -> Column:
        return F.pmod(F.floor(wall_us(F.col(us), F.col("zone"), ZONES) / F.lit(60_000_000)), F.lit(1440)).cast("bigint")

    return _hours(spark, d).withColumns({"opening_minute": of_day("opening_us"), "closing_minute": of_day("closing_us")})


_DONOR = f"""mins AS (SELECT u.*, extract(hour FROM {_LOCAL.format(us="open_us")}) * 60 + extract(minute FROM {_LOCAL.format(us="open_us")}) AS om, extract(hour FROM {_LOCAL.format(us="close_us")}) * 60 + extract(minute FROM {_LOCAL.format(us="close_us")}) AS cm
  FROM (SELECT *, {q.PARK_ZONE.format(p="park")} AS zone, TRY_CAST(park_date AS DATE) AS day FROM usable) u),
off AS (SELECT park, day, arg_min({{'om': om, 'cm': cm, 'em': em, 'ev': ev}}, hours_id) AS o FROM mins WHERE version_type = 'official' AND day IS NOT NULL GROUP BY ALL),
acc AS (SELECT m.hours_id, m.park, h.confidence, abs(m.om - o.om) AS opening_error, abs(m.cm - o.cm) AS closing_error, m.em = o.em AS em_match, m.ev = o.ev AS ev_match, m.day - CAST(m.created_at AS DATE) AS days_until
  FROM mins m JOIN off USING (park, day) JOIN dimparkhours_with_donor h USING (hours_id) WHERE m.version_type = 'predicted' AND coalesce(h.confidence, 0) >= 0)"""
_DONOR_BINS = {"overall": "'all'", "confidence": _edges("confidence", [0.0, 0.5, 0.7, 0.9, 1.0], False), "park": "park", "days_until": _edges("days_until", [0, 30, 60, 90, 180, 365])}


@query(f"""WITH {q.USABLE}, {_DONOR} {_BINNED.format(what="round(avg(opening_error), 6) AS mean_opening_error, round(median(opening_error), 6) AS median_opening_error, round(avg(closing_error), 6) AS mean_closing_error, round(median(closing_error), 6) AS median_closing_error, round(avg(CAST(em_match AS INT)) * 100, 6) AS emh_morning_match_rate, round(avg(CAST(ev_match AS INT)) * 100, 6) AS emh_evening_match_rate", rows=_unpivoted("acc", _DONOR_BINS, "opening_error, closing_error, em_match, ev_match"))}""")
def q_donor_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Predicted against official hours: errors of opening and closing, flag match rates, in all bins."""
    table_ = reports.donor_accuracy_bins(cut(reports.donor_accuracy(_hours_minutes(spark, d), source=None)))
    return table_.withColumns({c: F.round(c, 6) for c, kind in table_.dtypes if kind == "double"})


# ---- models


@query()
def q_model_pair(spark: SparkSession, d: str) -> DataFrame:
    """Means over the training set of the model pair: rows, rows with a posted time, and their mean target per entity."""
    readings = cut(_readings(spark, d))
    rows = model.training_set(readings, _features(spark, d, readings).select("ingest_seq", "pred_mins_since_6am", "pred_mins_since_park_open", "pred_park_hours_open", "pred_season"), ["pred_mins_since_park_open", "pred_park_hours_open"], ["pred_season"])
    return rows.groupBy("entity").agg(F.count(F.lit(1)).alias("n"), F.count("posted").alias("n_posted"), F.avg("observed_wait_time").alias("mean_target"), F.avg("pred_mins_since_park_open").alias("mean_since_open"))
