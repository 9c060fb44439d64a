"""Queries for versions, donors, nearest-in-time joins, curves, windows and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuescope.functions import calendar, temporal
from queuescope.functions.timestamps import wall_us
from queuescope.operators import asof, curves, features, flat_hours, model, reports, versions
from queuescope.plans.facts import FACT, PREFIXES, facts, query
from queuescope.session import cut, table

_DAY = 86_400_000_000

# ---- versions: three syncs of made-up hours per park and date, derived from orders

_VERSIONS = """vers AS (
  SELECT o_orderkey AS version_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS park_date, ['mk', 'ep', 'dl', 'tdl'][1 + o_custkey % 4] AS park_code,
    ['official', 'final', 'predicted', 'historical', 'draft'][1 + o_orderkey % 5] AS version_type, epoch_us(CAST(o_orderdate AS TIMESTAMP)) - (o_orderkey % 60) * 86400000000 AS valid_from_us,
    CASE WHEN o_orderkey % 3 = 0 THEN epoch_us(CAST(o_orderdate AS TIMESTAMP)) - (o_orderkey % 7) * 86400000000 END AS valid_until_us,
    epoch_us(CAST(o_orderdate AS TIMESTAMP)) - (o_orderkey % 90) * 86400000000 AS created_us, 480 + o_orderkey % 13 * 5 AS opening_minute FROM orders)"""


def _versions(spark: SparkSession, d: str) -> DataFrame:
    key, at = F.col("o_orderkey"), temporal.wall_clock_us(F.col("o_orderdate"))
    day = F.lit(_DAY).cast("bigint")
    parks, kinds = F.array(*map(F.lit, ("mk", "ep", "dl", "tdl"))), F.array(*map(F.lit, ("official", "final", "predicted", "historical", "draft")))
    return table(spark, d, "orders").select(
        key.alias("version_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("park_date"),
        F.get(parks, (F.col("o_custkey") % 4).cast("int")).alias("park_code"),
        F.get(kinds, (key % 5).cast("int")).alias("version_type"),
        (at - key % 60 * day).alias("valid_from_us"),
        F.when(key % 3 == 0, at - key % 7 * day).alias("valid_until_us"),
        (at - key % 90 * day).alias("created_us"),
        (480 + key % 13 * 5).alias("opening_minute"),
    )


@query(f"""WITH {_VERSIONS}, want AS (SELECT DISTINCT park_date, park_code, epoch_us(CAST(park_date AS TIMESTAMP)) - 3 * 86400000000 AS as_of_us FROM vers), r AS (
  SELECT w.*, v.version_id, v.opening_minute, row_number() OVER (PARTITION BY w.park_date, w.park_code ORDER BY CASE version_type WHEN 'official' THEN 1 WHEN 'final' THEN 2 WHEN 'predicted' THEN 3 WHEN 'historical' THEN 4 ELSE 99 END, created_us DESC, version_id DESC) AS rn
  FROM want w LEFT JOIN vers v ON v.park_date = w.park_date AND v.park_code = w.park_code AND v.valid_from_us <= w.as_of_us AND (v.valid_until_us IS NULL OR v.valid_until_us > w.as_of_us))
SELECT park_date, park_code, version_id, opening_minute FROM r WHERE rn = 1""", nullable=("version_id", "opening_minute"))
def q_hours_asof(spark: SparkSession, d: str) -> DataFrame:
    """The version of every park date that was valid three days before."""
    known = _versions(spark, d)
    at = F.unix_date(F.col("park_date").cast("date")) * F.lit(_DAY).cast("bigint") - 3 * F.lit(_DAY).cast("bigint")
    wanted = known.select("park_date", "park_code").distinct().withColumn("as_of_us", at)
    return versions.as_of(wanted, known, ["park_date", "park_code"], "as_of_us").select("park_date", "park_code", "version_id", "opening_minute")


@query("""WITH s AS (SELECT c_custkey AS id, c_nationkey AS n, c_mktsegment AS g, 1 AS step FROM customer WHERE c_custkey % 10 < 8
  UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_nationkey + 1 ELSE c_nationkey END, c_mktsegment, 2 FROM customer WHERE c_custkey % 10 > 1),
c AS (SELECT *, lag(n) OVER w AS pn, lag(g) OVER w AS pg, lag(step) OVER w AS ps FROM s WINDOW w AS (PARTITION BY id ORDER BY step)), v AS (SELECT * FROM c WHERE ps IS NULL OR pn <> n OR pg <> g)
SELECT id AS c_custkey, CAST(n AS BIGINT) AS c_nationkey, CAST(step * 1000 AS BIGINT) AS valid_from_us, CAST(lead(step) OVER (PARTITION BY id ORDER BY step) * 1000 AS BIGINT) AS valid_until_us FROM v""", nullable=("valid_until_us",))
def q_hours_scd2(spark: SparkSession, d: str) -> DataFrame:
    """A versioned table after two syncs: unchanged keys stay, changed ones are closed and reopened."""
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("c_nationkey"), "c_mktsegment")
    keys, values = ["c_custkey"], ["c_nationkey", "c_mktsegment"]
    empty = rows.where(F.lit(False)).withColumns({"valid_from_us": F.lit(0).cast("bigint"), "valid_until_us": F.lit(0).cast("bigint")})
    one = versions.append_versions(empty, rows.where(F.col("c_custkey") % 10 < 8), keys, values, 1000)
    moved = rows.where(F.col("c_custkey") % 10 > 1).withColumn("c_nationkey", F.when(F.col("c_custkey") % 4 == 0, F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey")))
    return versions.append_versions(one, moved, keys, values, 2000).drop("c_mktsegment")


@query("""WITH g AS (SELECT CAST(d AS DATE) AS d, (dayofyear(d) // 9)::VARCHAR AS grp FROM (SELECT unnest(generate_series(DATE '1994-01-01', DATE '2003-12-31', INTERVAL 1 DAY)) AS d)),
don AS (SELECT DISTINCT ['mk', 'ep', 'dl', 'tdl'][1 + o_custkey % 4] AS park_code, g.d, g.grp FROM orders JOIN g ON g.d = CAST(o_orderdate AS DATE)), tgt AS (SELECT * FROM don),
s AS (SELECT t.park_code, t.d, t.grp, x.d AS dd, CASE WHEN x.grp = t.grp THEN 1.0 ELSE 0.7 END / (1.0 + (t.d - x.d) / 365.0) AS conf FROM tgt t LEFT JOIN don x ON x.park_code = t.park_code AND x.d < t.d),
r AS (SELECT *, row_number() OVER (PARTITION BY park_code, d ORDER BY conf DESC, dd) AS rn FROM s)
SELECT park_code, CAST(d AS VARCHAR) AS park_date, CAST(dd AS VARCHAR) AS donor_date, round(conf, 9) AS confidence FROM r WHERE rn = 1""")
def q_best_donor(spark: SparkSession, d: str) -> DataFrame:
    """The past date that lends its hours to each date."""
    parks = F.array(*map(F.lit, ("mk", "ep", "dl", "tdl")))
    day = F.col("o_orderdate").cast("date")
    dates = table(spark, d, "orders").select(F.get(parks, (F.col("o_custkey") % 4).cast("int")).alias("park_code"), day.alias("park_date"), F.floor(F.dayofyear(day) / 9).cast("string").alias("date_group_id")).distinct()
    found = versions.best_donor(dates, dates)
    return found.select("park_code", F.col("park_date").cast("string").alias("park_date"), F.col("donor_date").cast("string").alias("donor_date"), F.round("confidence", 9).alias("confidence"))


@query("""WITH p AS (SELECT DISTINCT ['mk', 'ep', 'dl', 'tdl'][1 + o_custkey % 4] AS park_code FROM orders), g AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 DAY)) AS DATE) AS d)
SELECT CAST(d AS VARCHAR) AS park_date, park_code FROM p CROSS JOIN g EXCEPT SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR), ['mk', 'ep', 'dl', 'tdl'][1 + o_custkey % 4] FROM orders""")
def q_missing_hours(spark: SparkSession, d: str) -> DataFrame:
    """Dates of every park without any version."""
    present = _versions(spark, d).select("park_date", "park_code").distinct()
    spine = calendar.date_spine(spark, "1995-01-01", "2001-08-01").select(F.col("park_date").cast("string").alias("park_date"))
    return versions.missing_keys(spine, present, present).select("park_date", "park_code")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 120 <= 7 THEN 0.05 WHEN o_orderkey % 120 <= 30 THEN 0.2 WHEN o_orderkey % 120 <= 90 THEN 0.4 ELSE 0.6 END::DOUBLE AS probability FROM orders""")
def q_change_probability(spark: SparkSession, d: str) -> DataFrame:
    """Chance of a change by days ahead."""
    return table(spark, d, "orders").select("o_orderkey", versions.change_probability(F.col("o_orderkey") % 120).alias("probability"))


# ---- nearest in time

_KEYS = ["entity_code", "park_date"]


def _readings(spark: SparkSession, d: str, kind: str) -> DataFrame:
    return facts(spark, d).where(F.col("wait_time_type") == kind).select("event_id", *_KEYS, "observed_us", F.col("wait_time_minutes").alias("minutes"))


@query(f"""WITH {FACT}, r AS (SELECT a.event_id, p.wait_time_minutes AS minutes, abs(a.observed_us - p.observed_us) AS distance_us, row_number() OVER (PARTITION BY a.event_id ORDER BY abs(a.observed_us - p.observed_us) NULLS LAST, p.event_id) AS rn
  FROM fact a LEFT JOIN fact p ON p.entity_code = a.entity_code AND p.park_date = a.park_date AND p.wait_time_type = 'POSTED' WHERE a.wait_time_type = 'ACTUAL')
SELECT event_id, minutes, distance_us FROM r WHERE rn = 1""", nullable=("minutes", "distance_us"))
def q_nearest_posted(spark: SparkSession, d: str) -> DataFrame:
    """The posted time nearest to each actual one."""
    found = asof.nearest(_readings(spark, d, "ACTUAL"), _readings(spark, d, "POSTED"), _KEYS, "observed_us", "event_id", "minutes", "event_id")
    return found.select("event_id", "minutes", "distance_us")


_SLOTS = f"""{FACT}, slots AS (SELECT event_id AS slot_id, entity_code, park_date, observed_us + 420000000 AS at_us FROM fact WHERE wait_time_type = 'PRIORITY')"""


def _slot_marks(spark: SparkSession, d: str) -> DataFrame:
    return _readings(spark, d, "PRIORITY").select(F.col("event_id").alias("slot_id"), *_KEYS, (F.col("observed_us") + 420_000_000).alias("at_us"))


def _as_slots(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("observed_us", "at_us")


@query(f"""WITH {_SLOTS}, nx AS (SELECT s.slot_id, arg_min(p.wait_time_minutes, (p.observed_us, p.event_id)) AS v, min(p.observed_us) - any_value(s.at_us) AS gap FROM slots s JOIN fact p ON p.entity_code = s.entity_code AND p.park_date = s.park_date AND p.wait_time_type = 'POSTED' AND p.observed_us >= s.at_us GROUP BY 1),
pv AS (SELECT s.slot_id, arg_max(p.wait_time_minutes, p.observed_us) AS v, any_value(s.at_us) - max(p.observed_us) AS gap FROM slots s JOIN fact p ON p.entity_code = s.entity_code AND p.park_date = s.park_date AND p.wait_time_type = 'POSTED' AND p.observed_us < s.at_us GROUP BY 1)
SELECT s.slot_id, CASE WHEN nx.slot_id IS NOT NULL THEN CASE WHEN nx.gap <= 10800000000 THEN nx.v END WHEN pv.gap <= 14400000000 THEN pv.v END AS minutes FROM slots s LEFT JOIN nx USING (slot_id) LEFT JOIN pv USING (slot_id)""", nullable=("minutes",))
def q_slot_posted_forward(spark: SparkSession, d: str) -> DataFrame:
    """Posted time of a slot: the next within three hours, else, if none comes at all, the last within four."""
    hour = 3_600_000_000
    found = asof.forward_preferred(_slot_marks(spark, d), _as_slots(_readings(spark, d, "POSTED")), _KEYS, "at_us", "slot_id", "minutes", "event_id", 3 * hour, 4 * hour)
    return found.select("slot_id", "minutes")


@query(f"""WITH {_SLOTS}, r AS (SELECT s.slot_id, a.wait_time_minutes AS minutes, row_number() OVER (PARTITION BY s.slot_id ORDER BY abs(a.observed_us - s.at_us) NULLS LAST, a.event_id) AS rn
  FROM slots s LEFT JOIN fact a ON a.entity_code = s.entity_code AND a.park_date = s.park_date AND a.wait_time_type = 'ACTUAL' AND abs(a.observed_us - s.at_us) <= 7200000000)
SELECT slot_id, minutes FROM r WHERE rn = 1""", nullable=("minutes",))
def q_slot_actual_tolerance(spark: SparkSession, d: str) -> DataFrame:
    """Actual time nearest to a slot within two hours on either side."""
    found = asof.nearest(_slot_marks(spark, d), _as_slots(_readings(spark, d, "ACTUAL")), _KEYS, "at_us", "slot_id", "minutes", "event_id", tolerance_us=7_200_000_000)
    return found.select("slot_id", "minutes")


# ---- curves and index

_HOURS = """hrs AS (SELECT DISTINCT park_code, park_date, 480 + (ascii(park_code) % 7) * 8 + 3 AS o, CASE WHEN park_code IN ('tdl', 'mk') THEN 60 ELSE 1320 END AS c FROM fact)"""
_GRID = f"""{FACT}, {_HOURS}, mins AS (SELECT unnest(generate_series(0, 2879)) AS m), grid AS (
  SELECT h.park_code, h.park_date, m.m AS slot_minute, printf('%02d:%02d', m.m % 1440 // 60, m.m % 60) AS time_slot FROM hrs h JOIN mins m
  ON m.m BETWEEN h.o AND CASE WHEN h.c < h.o THEN h.c + 1440 ELSE h.c END AND (CASE WHEN m.m // 60 = h.o // 60 THEN (m.m - h.o) % 5 = 0 ELSE m.m % 60 % 5 = 0 END))"""


def _grid(spark: SparkSession, d: str) -> DataFrame:
    hours = facts(spark, d).select("park_code", "park_date").distinct().withColumns({
        "opening_minute": (F.lit(483) + F.ascii("park_code") % 7 * 8).cast("bigint"),
        "closing_minute": F.when(F.col("park_code").isin("tdl", "mk"), 60).otherwise(1320).cast("bigint"),
    })
    return curves.slot_grid(hours).select("park_code", "park_date", "slot_minute", "time_slot")


@query(f"WITH {_GRID} SELECT park_code, CAST(park_date AS VARCHAR) AS park_date, slot_minute, time_slot FROM grid")
def q_slot_grid(spark: SparkSession, d: str) -> DataFrame:
    """Five-minute slots of every park date."""
    return _grid(spark, d).withColumn("park_date", F.col("park_date").cast("string"))


_FLOOR = "printf('%02d:%02d', extract(hour FROM local_ts), extract(minute FROM local_ts) // 5 * 5)"
_CURVES = f"""{_GRID}, obs AS (SELECT entity_code, park_code, park_date, {_FLOOR} AS time_slot, avg(wait_time_minutes) AS actual FROM fact WHERE wait_time_type = 'ACTUAL' GROUP BY ALL),
pred AS (SELECT entity_code, park_code, park_date, {_FLOOR} AS time_slot, avg(wait_time_minutes) AS actual_predicted FROM fact WHERE wait_time_type = 'POSTED' GROUP BY ALL),
curve AS (SELECT coalesce(o.entity_code, p.entity_code) AS entity_code, coalesce(o.park_code, p.park_code) AS park_code, coalesce(o.park_date, p.park_date) AS park_date, coalesce(o.time_slot, p.time_slot) AS time_slot, coalesce(o.actual, p.actual_predicted) AS value,
  CASE WHEN o.actual IS NOT NULL THEN 'observed' ELSE 'imputed' END AS source FROM obs o FULL JOIN pred p ON o.entity_code = p.entity_code AND o.park_date = p.park_date AND o.time_slot = p.time_slot)"""


def _curve(spark: SparkSession, d: str, kind: str, out: str) -> DataFrame:
    slot = temporal.slot_label((F.floor(F.col("local_us") / F.lit(60_000_000)) % 1440).cast("bigint"))
    return facts(spark, d).where(F.col("wait_time_type") == kind).groupBy("entity_code", "park_code", "park_date", slot.alias("time_slot")).agg(F.avg("wait_time_minutes").alias(out))


_CURVE_KEYS = ["entity_code", "park_code", "park_date", "time_slot"]


@query(f"""WITH {_CURVES} SELECT g.park_code, CAST(g.park_date AS VARCHAR) AS park_date, g.time_slot, round(avg(c.value), 6) AS wti, count(c.value) AS n_entities, round(min(c.value), 6) AS min_actual, round(max(c.value), 6) AS max_actual
FROM (SELECT DISTINCT park_code, park_date, time_slot FROM grid) g LEFT JOIN curve c ON c.park_code = g.park_code AND c.park_date = g.park_date AND c.time_slot = g.time_slot GROUP BY ALL""")
def q_wti(spark: SparkSession, d: str) -> DataFrame:
    """The index of every park, date and slot over all entities' coalesced curves."""
    curve = curves.coalesce_curves(_curve(spark, d, "ACTUAL", "actual"), _curve(spark, d, "POSTED", "actual_predicted"), _CURVE_KEYS)
    index = curves.wait_index(_grid(spark, d), curve)
    return index.withColumns({c: F.round(c, 6) for c in ("wti", "min_actual", "max_actual")} | {"park_date": F.col("park_date").cast("string")})


_WINDOW = f"""{FACT}, {_HOURS}, win AS (SELECT park_code, park_date, min(o) + 200 AS a, max(CASE WHEN c < o THEN c + 1440 ELSE c END) - 300 AS b FROM hrs WHERE park_code <> 'eu' GROUP BY ALL)"""


@query(f"""WITH {_WINDOW} SELECT event_id FROM fact LEFT JOIN win USING (park_code, park_date)
WHERE coalesce(date_diff('second', CAST(park_date AS TIMESTAMP), local_ts) // 60 BETWEEN a - 90 AND b + 90, TRUE)""")
def q_open_window(spark: SparkSession, d: str) -> DataFrame:
    """Readings at most 90 minutes outside their park's shortened hours."""
    rows = facts(spark, d).withColumn("minute", F.floor((F.col("local_us") - F.unix_date("park_date") * F.lit(_DAY).cast("bigint")) / F.lit(60_000_000)))
    hours = rows.where(F.col("park_code") != "eu").select("park_code", "park_date").distinct().withColumns({
        "opening_minute": F.lit(483) + F.ascii("park_code") % 7 * 8,
        "closing_minute": F.when(F.col("park_code").isin("tdl", "mk"), 60).otherwise(1320),
    })
    window = flat_hours.open_window(hours).withColumns({"first_minute": F.col("first_minute") + 200, "last_minute": F.col("last_minute") - 300})
    return flat_hours.within_window(rows, window, "minute").select("event_id")


@query(f"""WITH {FACT}, c AS (SELECT park_code, entity_code, count(*) AS n FROM fact WHERE wait_time_type = 'ACTUAL' GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY park_code ORDER BY n DESC, entity_code) AS k FROM c)
SELECT park_code, count(*) AS n_entities, string_agg(CASE WHEN k <= 5 THEN entity_code END, ',' ORDER BY k) AS examples FROM r GROUP BY park_code""")
def q_entities_with_actual(spark: SparkSession, d: str) -> DataFrame:
    """Entities with actual readings per park."""
    return flat_hours.entities_with(facts(spark, d), "ACTUAL").withColumn("examples", F.concat_ws(",", "examples"))


# ---- features and models


@query(f"WITH {FACT} SELECT entity_code, round(coalesce(avg(wait_time_minutes), 0), 9) AS prediction, count(*) AS n FROM fact WHERE wait_time_type = 'ACTUAL' GROUP BY 1 HAVING count(*) < 500")
def q_mean_model(spark: SparkSession, d: str) -> DataFrame:
    """Mean models of sparse entities."""
    return model.mean_models(facts(spark, d).where(F.col("wait_time_type") == "ACTUAL")).withColumn("prediction", F.round("prediction", 9))


@query()
def q_boosted_model(spark: SparkSession, d: str) -> DataFrame:
    """Test-period predictions of the boosted model against the observed waits."""
    rows = facts(spark, d).where(F.col("wait_time_type") == "ACTUAL")
    coded = features.label_encode(rows, "entity_code", features.label_mapping(rows, "entity_code"))
    ready = cut(coded.select("event_id", "park_date", F.col("entity_code_code").cast("double").alias("entity"), temporal.minutes_since_start_of_day(F.col("local_us")).cast("double").alias("minute"), (F.weekday("park_date") + 0.0).alias("weekday"), F.col("wait_time_minutes").cast("double").alias("target")))
    split = cut(features.chronological_split(ready, "park_date"))
    names = ["entity", "minute", "weekday"]
    fitted = model.fit_boosted(split, names, "target", rounds=model.ROUNDS, depth=model.DEPTH)
    return model.predict(fitted, split.where(F.col("split") == "test"), names, fitted.bounds).select("event_id", "target", "prediction")


@query("""SELECT round(1 - sum(e * e) / sum((y - m) * (y - m)), 9) AS r2, round(avg(abs(e)), 9) AS mae, round(sqrt(avg(e * e)), 9) AS rmse, round(avg(CASE WHEN y > 0 THEN abs(e) / y * 100 END), 6) AS mape, round(corr(y, p), 9) AS r
FROM (SELECT y, p, p - y AS e, avg(y) OVER () AS m FROM (SELECT l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem))""")
def q_regression_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of a price guess over all lines."""
    rows = table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("p"))
    metrics = reports.error_metrics(rows, [], "y", "p")
    return metrics.withColumn("r", rows.agg(F.corr("y", "p")).scalar()).select(*[F.round(c, 6 if c == "mape" else 9).alias(c) for c in ("r2", "mae", "rmse", "mape", "r")])


# ---- windows of time, as batch twins of the streaming queries


@query("""SELECT epoch_us(time_bucket(INTERVAL 5 MINUTE, ts)) AS start_us, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def q_tumbling(spark: SparkSession, d: str) -> DataFrame:
    """Counts and sums per five minutes."""
    rows = table(spark, d, "events").groupBy(F.window("ts", "5 minutes").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return rows.select(temporal.wall_clock_us(F.col("w.start")).alias("start_us"), "event_type", "n", "total")


@query("""SELECT epoch_us(time_bucket(INTERVAL 30 MINUTE, ts) - k * INTERVAL 30 MINUTE) AS start_us, count(*) AS n FROM events, (SELECT unnest([0, 1]) AS k) GROUP BY 1""")
def q_sliding(spark: SparkSession, d: str) -> DataFrame:
    """Counts per hour, every half hour."""
    rows = table(spark, d, "events").groupBy(F.window("ts", "1 hour", "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select(temporal.wall_clock_us(F.col("w.start")).alias("start_us"), "n")


@query("""WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS s FROM events), g AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM o)
SELECT user_id, epoch_us(min(ts)) AS start_us, count(*) AS n FROM g GROUP BY user_id, k""")
def q_session(spark: SparkSession, d: str) -> DataFrame:
    """Sessions with gaps of two hours."""
    rows = table(spark, d, "events").groupBy("user_id", F.session_window("ts", "2 hours").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select("user_id", temporal.wall_clock_us(F.col("w.start")).alias("start_us"), "n")


@query(f"""SELECT s_suppkey, ['{"', '".join(PREFIXES)}'][1 + s_suppkey % 12] AS prefix, 9 * 60 + s_suppkey % 24 AS wall_minute FROM supplier""")
def q_utc_to_zone(spark: SparkSession, d: str) -> DataFrame:
    """Local minutes of instants in Tokyo, taken back to a plain number."""
    prefixes = F.array(*[F.lit(p) for p in PREFIXES])
    local = wall_us(F.col("s_suppkey") % 24 * F.lit(60_000_000).cast("bigint"), "Asia/Tokyo")
    return table(spark, d, "supplier").select("s_suppkey", F.get(prefixes, (F.col("s_suppkey") % 12).cast("int")).alias("prefix"), F.floor(local / F.lit(60_000_000)).alias("wall_minute"))

