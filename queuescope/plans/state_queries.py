"""Queries for files, state, cleaners, selection and small reports, over tables written and read again in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuescope.functions import clean, names, parse
from queuescope.functions.codes import code, park_of
from queuescope.operators import dedupe, flat_hours, history, reports, selection
from queuescope.operators.aggregates import exact_medians
from queuescope.operators.ordered import with_ordinal
from queuescope.plans.facts import FACT, facts, query
from queuescope.session import shared_folder, table
from queuescope.sources import files, sinks
from queuescope.streaming import live

# ---- files


@query("SELECT event_id, event_type, CAST(value AS VARCHAR) AS value_text FROM events")
def q_csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Events written as Parquet and CSV, the CSV read with folded headers."""
    place = f"{shared_folder(spark, 'csv')}/events"
    sinks.write_parquet_and_csv(table(spark, d, "events").select(F.col("event_id").alias(" Event_ID"), F.col("event_type").alias("EVENT_TYPE"), F.col("value").cast("string").alias("value_text")), place)
    return files.read_headed(spark, f"{place}.csv").select(F.col("event_id").cast("bigint").alias("event_id"), "event_type", "value_text")


_RAW = """raw AS (SELECT 'mk' || l_suppkey % 40 AS code, CAST(l_suppkey % 31 + 1 AS INT) AS dy, CAST(l_partkey % 12 + 1 AS INT) AS mo, CAST(l_orderkey % 24 AS INT) * 100 + CAST(l_partkey % 60 AS INT) AS fhour,
  CASE WHEN l_linenumber = 7 THEN 8000 ELSE CAST(l_suppkey % 24 AS INT) * 100 + CAST(l_partkey % 60 AS INT) END AS fwin FROM lineitem),
parts AS (SELECT *, least(CASE WHEN fhour >= 100 THEN fhour // 100 ELSE fhour END, 23) AS oh, CASE WHEN fhour >= 100 THEN fhour % 100 ELSE 0 END AS om, least(CASE WHEN fwin >= 100 THEN fwin // 100 ELSE fwin END, 23) AS rh, CASE WHEN fwin >= 100 THEN fwin % 100 ELSE 0 END AS rm,
  TRY_CAST(concat('2023-', mo, '-', dy) AS DATE) AS day FROM raw),
timed AS (SELECT *, rh * 60 + rm - oh * 60 - om AS gap, CAST(day AS TIMESTAMP) + to_minutes(CAST(oh * 60 + om - 540 AS INT)) AS tm FROM parts WHERE day IS NOT NULL)"""


@query(f"""WITH {_RAW} SELECT upper(code) AS entity_code, count(*) AS n, CAST(sum(CASE WHEN fwin >= 8000 THEN 8888 WHEN gap < -15 THEN gap + 1440 ELSE gap END) AS BIGINT) AS minutes, min(epoch_us(tm)) AS first_us, max(epoch_us(tm)) AS last_us FROM timed GROUP BY 1""")
def q_priority_rows(spark: SparkSession, d: str) -> DataFrame:
    """Raw return times in the headerless layout, read by position and made readings of Tokyo time."""
    n = {c: F.col(c).cast("int") for c in ("l_orderkey", "l_partkey", "l_suppkey")}
    none = F.lit(None).cast("int")
    raw = table(spark, d, "lineitem").select(
        F.concat(F.lit(" mk"), (n["l_suppkey"] % 40).cast("string")).alias("a"), (n["l_suppkey"] % 31 + 1).alias("b"), (n["l_partkey"] % 12 + 1).alias("c"), F.lit(2023).alias("d"),
        (n["l_orderkey"] % 24 * 100 + n["l_partkey"] % 60).alias("e"), none.alias("f"), F.when(F.col("l_linenumber") == 7, 8000).otherwise(n["l_suppkey"] % 24 * 100 + n["l_partkey"] % 60).alias("g"), none.alias("h"),
    )
    place = f"{shared_folder(spark, 'raw')}/fastpass"
    raw.write.option("header", True).csv(place)
    rows = parse.priority_rows(files.read_positional(spark, place), F.lit("Asia/Tokyo"))
    return rows.groupBy("entity_code").agg(F.count(F.lit(1)).alias("n"), F.sum("wait_time_minutes").alias("minutes"), F.min("observed_us").alias("first_us"), F.max("observed_us").alias("last_us"))


_PATHS = """paths AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'x/wait_times/wdw/' WHEN 1 THEN 'x/FASTPASS_times/tdr/' WHEN 2 THEN 'x/fastpass_times/dlr/' ELSE 'x/other/' END || 'f_' || (2010 + o_orderkey % 12) || '_' || lpad(CAST(o_orderkey % 5 + 1 AS VARCHAR), 2, '0') || '.csv' AS path FROM orders)"""


def _paths(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    folder = F.when(key % 4 == 0, "x/wait_times/wdw/").when(key % 4 == 1, "x/FASTPASS_times/tdr/").when(key % 4 == 2, "x/fastpass_times/dlr/").otherwise("x/other/")
    return table(spark, d, "orders").select("o_orderkey", F.concat(folder, F.lit("f_"), (2010 + key % 12).cast("string"), F.lit("_"), F.lpad((key % 5 + 1).cast("string"), 2, "0"), F.lit(".csv")).alias("path"))


@query(f"""WITH {_PATHS} SELECT o_orderkey, CASE WHEN path LIKE '%wait_times%' THEN 'Standby' WHEN lower(path) LIKE '%fastpass_times%' THEN CASE WHEN regexp_matches(path, '_201[2-8]|_2019_0[12]') THEN 'Old Fastpass' ELSE 'New Fastpass' END ELSE 'Unknown' END AS kind,
  CASE WHEN path LIKE '%/tdr/%' THEN 'Asia/Tokyo' WHEN path LIKE '%/dlr/%' THEN 'America/Los_Angeles' ELSE 'America/New_York' END AS zone FROM paths""")
def q_file_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Kind and zone of raw files by their paths."""
    return _paths(spark, d).select("o_orderkey", parse.file_kind(F.col("path")).alias("kind"), parse.zone_of_path(F.col("path")).alias("zone"))


@query("""WITH l AS (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS tm FROM orders)
SELECT o_orderkey FROM l WHERE (o_orderkey % 3 <> 0 OR o_orderkey % 9 = 3 OR o_orderkey % 9 = 6) AND NOT (o_orderkey % 5 = 0 AND DATE '1998-01-01' - CAST(tm AS DATE) >= 600)""")
def q_files_to_process(spark: SparkSession, d: str) -> DataFrame:
    """Files that are new, changed, or stored without a readable time, without the old ones that failed three times."""
    key, at = F.col("o_orderkey"), F.col("o_orderdate").cast("date").cast("timestamp")
    rows = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("p"), key.cast("string")).alias("path"), at.alias("modified"))
    stored = F.when(key % 9 == 0, F.col("modified").cast("string")).when(key % 9 == 3, "unreadable").otherwise(F.date_sub("modified", 1).cast("string"))
    processed = rows.where(key % 3 == 0).select("path", stored.alias("modified"))
    failed = rows.where(key % 5 == 0).select("path", F.lit(3).alias("failures"))
    return files.to_process(rows, processed, failed, as_of="1998-01-01").select("o_orderkey")


@query(f"WITH {FACT} SELECT park_code, CAST(park_date AS VARCHAR) AS park_date, count(*) AS n, CAST(sum(wait_time_minutes) AS BIGINT) AS minutes FROM fact WHERE park_code IN ('mk', 'dl') GROUP BY ALL")
def q_fact_table(spark: SparkSession, d: str) -> DataFrame:
    """Facts written in partitions, half of them again and the rest merged from staging, read with pruned partitions."""
    rows = facts(spark, d).select("event_id", "entity_code", F.timestamp_micros("observed_us").alias("observed_at"), "wait_time_type", "wait_time_minutes", "park_code", "park_date")
    place = shared_folder(spark, "facts")
    sinks.write_facts(rows.where(F.col("event_id") % 2 == 0), f"{place}/facts")
    rows.where(F.col("event_id") % 4 != 0).write.parquet(f"{place}/staging")
    # events are facts of their own here, so the id is part of the key
    sinks.merge_staging(spark, f"{place}/staging", f"{place}/facts", ("event_id", "entity_code", "observed_at"))
    kept = files.read_facts(spark, f"{place}/facts", park_code="mk").unionByName(files.read_facts(spark, f"{place}/facts", park_code="dl"))
    return kept.groupBy("park_code", F.col("park_date").cast("string").alias("park_date")).agg(F.count(F.lit(1)).alias("n"), F.sum("wait_time_minutes").alias("minutes"))


@query("SELECT n_nationkey, upper(n_name) AS n_name FROM nation")
def q_version_swap(spark: SparkSession, d: str) -> DataFrame:
    """The second version of a table, after the pointer was moved."""
    root, rows = shared_folder(spark, "dim"), table(spark, d, "nation").select("n_nationkey", "n_name")
    sinks.write_version(rows.limit(1), root, "1")
    sinks.write_version(rows.withColumn("n_name", F.upper("n_name")), root, "2")
    return sinks.read_version(spark, root)


@query(f"WITH {FACT} SELECT wait_time_type, count(DISTINCT (entity_code, observed_us, wait_time_minutes)) AS n FROM fact GROUP BY 1")
def q_exact_sink(spark: SparkSession, d: str) -> DataFrame:
    """Readings that came in three overlapping batches, one of them twice, each stored once."""
    rows = facts(spark, d).select("event_id", "entity_code", F.timestamp_micros("observed_us").alias("observed_at"), "wait_time_type", "wait_time_minutes")
    place = f"{shared_folder(spark, 'sink')}/readings"
    sink = live.exact_sink(place)
    for number, part in ((0, (0, 1)), (1, (1, 2)), (1, (1, 2)), (2, (2, 0))):
        sink(rows.where((F.col("event_id") % 3).isin(*part)), number)
    return spark.read.parquet(place).groupBy("wait_time_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {FACT} SELECT CASE WHEN event_id % 4 = 0 THEN 'MK' || event_id % 50 ELSE 'MK9' || lpad(CAST(event_id % 50 AS VARCHAR), 2, '0') END AS entity_code, count(*) AS n, CAST(sum(wait_time_minutes) AS BIGINT) AS minutes,
  count(*) FILTER (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(date_trunc('second', ts)) > 86400000000) AS n_stale FROM fact WHERE park_code = 'mk' AND event_id % 7 <> 0 AND event_id % 11 <> 0 GROUP BY 1""")
def q_live_readings(spark: SparkSession, d: str) -> DataFrame:
    """Rides of live payloads to readings: closed rides and passes are left out, unmapped rides get a code of park and id."""
    i = F.col("event_id")
    ride = F.struct(
        F.when(i % 4 == 0, i % 50).otherwise(900 + i % 50).alias("id"), F.when(i % 11 == 0, "Get Lightning Lane").otherwise("Ride").alias("name"), (i % 7 != 0).alias("is_open"),
        F.col("wait_time_minutes").cast("int").alias("wait_time"), F.date_format(F.timestamp_micros("observed_us"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_updated"),
    )
    rows = facts(spark, d).where("park_code = 'mk'").select((i % 2 == 0).alias("top"), (i % 997).alias("payload"), ride.alias("ride"))
    rides = lambda top: F.collect_list(F.when(F.col("top") == top, F.col("ride")))
    raw = rows.groupBy("payload").agg(F.lit("MK").alias("park_code"), rides(F.lit(True)).alias("rides"), rides(F.lit(False)).alias("nested"))
    lands = F.array(F.struct(F.lit(1).cast("bigint").alias("id"), F.lit("land").alias("name"), F.col("nested").alias("rides")))
    mapping = spark.range(50).select(F.col("id").alias("ride_id"), F.lit("mk").alias("park_code"), F.concat(F.lit("MK"), F.col("id").cast("string")).alias("entity_code"))
    readings = live.to_readings(raw.select("park_code", lands.alias("lands"), "rides"), mapping, {"mk": "MK"}, as_of="2024-02-01 00:00:00")
    return readings.groupBy("entity_code").agg(F.count(F.lit(1)).alias("n"), F.sum("wait_time_minutes").alias("minutes"), F.count_if("is_stale").alias("n_stale"))


@query("SELECT * FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate DESC, 'p' || o_orderkey) AS r, o_orderdate FROM orders) WHERE r > 100 AND CAST(o_orderdate AS DATE) < DATE '1996-01-01'".replace("SELECT *", "SELECT o_orderkey"))
def q_outdated_files(spark: SparkSession, d: str) -> DataFrame:
    """Files beyond the newest hundred of their kind and older than a date."""
    rows = table(spark, d, "orders").select(F.col("o_orderstatus").alias("kind"), F.concat(F.lit("p"), F.col("o_orderkey").cast("string")).alias("path"), F.col("o_orderdate").cast("timestamp").alias("modified"), "o_orderkey")
    return sinks.outdated(rows, 100, "1996-01-01").select("o_orderkey")


@query("SELECT 'nation' AS table_name, TRUE AS present, CAST((SELECT count(*) FROM nation) AS DOUBLE) AS n_rows UNION ALL SELECT 'orders', TRUE, CAST((SELECT count(*) FROM orders) AS DOUBLE) UNION ALL SELECT 'absent', FALSE, NULL")
def q_row_counts(spark: SparkSession, d: str) -> DataFrame:
    """Which tables are there, and their rows."""
    return reports.row_counts(spark, {n: f"{d}/{n}.parquet" for n in ("nation", "orders", "absent")}).withColumn("n_rows", F.col("n_rows").cast("double"))


# ---- cleaners and versions of flat hours

_FLAT = """flat AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN ' nan ' ELSE ' 09:0' || s_suppkey % 10 END AS o, CASE s_suppkey % 3 WHEN 0 THEN NULL ELSE '22:00' END AS c, CASE s_suppkey % 5 WHEN 0 THEN '08:00' END AS oe, s_suppkey % 2 AS em, CASE s_suppkey % 7 WHEN 0 THEN NULL ELSE s_suppkey % 3 END AS ev FROM supplier),
regular AS (SELECT *, CASE WHEN trim(o) IN ('', 'nan') OR o IS NULL THEN '1999-01-01T00:00:00-08:00' ELSE trim(o) END AS opening, coalesce(c, '1999-01-01T00:00:00-08:00') AS closing FROM flat)"""


def _flat(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(
        "s_suppkey", F.lit(" mk ").alias("park_code"), F.lit("2024-01-01").alias("park_date"),
        F.when(k % 4 == 1, " nan ").when(k % 4 > 1, F.concat(F.lit(" 09:0"), (k % 10).cast("string"))).alias("opening_time"), F.when(k % 3 != 0, "22:00").alias("closing_time"),
        F.when(k % 5 == 0, "08:00").alias("opening_time_with_emh"), F.lit(None).cast("string").alias("closing_time_with_emh_or_party"), (k % 2).alias("emh_morning"), F.when(k % 7 != 0, k % 3).alias("emh_evening"),
    )


@query(f"""WITH {_FLAT} SELECT s_suppkey, 'MK' AS park_code, opening AS opening_time, closing AS closing_time, coalesce(oe, CASE WHEN em <> 0 THEN '1999-01-01T00:00:00-08:00' ELSE opening END) AS opening_time_with_emh,
  CASE WHEN coalesce(ev, 0) <> 0 THEN '1999-01-01T00:00:00-08:00' ELSE closing END AS closing_time_with_emh_or_party, em <> 0 AS emh_morning, coalesce(ev, 0) <> 0 AS emh_evening, 'official' AS version_type, CAST(5 AS BIGINT) AS valid_from_us FROM regular""")
def q_flat_hours(spark: SparkSession, d: str) -> DataFrame:
    """Flat hours cleaned and made open official versions."""
    rows = flat_hours.to_versions(flat_hours.clean_hours(_flat(spark, d)), 5)
    return rows.select("s_suppkey", "park_code", "opening_time", "closing_time", "opening_time_with_emh", "closing_time_with_emh_or_party", "emh_morning", "emh_evening", "version_type", "valid_from_us")


_CLEAN = "CASE WHEN trim({c}) IN ('', 'nan') THEN NULL ELSE {f}(trim({c})) END"


@query(f"""SELECT c_custkey, {_CLEAN.format(c="lower(c_mktsegment)", f="upper")} AS event_code, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS event_name, lower(c_mktsegment) AS property_code, c_custkey % 2 <> 0 AS event_hard_ticket, upper(c_mktsegment) AS event_abbreviation FROM customer""")
def q_clean_events(spark: SparkSession, d: str) -> DataFrame:
    """The event dimension, cleaned."""
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(
        "c_custkey", F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("event_code"), F.when(k % 3 == 0, "  ").otherwise(F.concat(F.col("c_name"), F.lit(" "))).alias("event_name"), F.upper("c_mktsegment").alias("property_abbrev"),
        (k % 2).alias("event_hard_ticket"), F.lower("c_mktsegment").alias("event_abbreviation"),
    )
    return clean.clean_events(rows)


@query("""SELECT c_custkey, upper(trim(c_mktsegment)) AS park_code, lower(c_mktsegment) AS property_code, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE '2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') END AS park_date, c_custkey % 3 = 1 AS "EMHMORN", CAST(c_custkey % 5 AS VARCHAR) AS "EMHMORNOPEN" FROM customer""")
def q_clean_metatable(spark: SparkSession, d: str) -> DataFrame:
    """The day table, cleaned: flags by the pattern of their names."""
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(
        "c_custkey", F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("park"), F.upper("c_mktsegment").alias("property_abbrev"),
        F.when(k % 4 == 0, "never").otherwise(F.concat(F.lit("01/"), F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit("/2024"))).alias("date"),
        F.when(k % 3 == 1, "Yes").when(k % 3 == 2, "no").alias("EMHMORN"), F.concat((k % 5).cast("string"), F.lit(" ")).alias("EMHMORNOPEN"),
    )
    return clean.clean_metatable(rows)


@query("""WITH known AS (SELECT ['mk', 'ep', 'dl', 'tdl'][1 + o_custkey % 4] AS park_code, CAST(o_orderdate AS DATE) AS d, min((480 + o_orderkey % 13 * 5, 1200 + o_orderkey % 7)) AS h FROM orders GROUP BY ALL),
days AS (SELECT CAST(unnest(generate_series(DATE '1999-01-01', DATE '1999-01-20', INTERVAL 1 DAY)) AS DATE) AS d), tgt AS (SELECT p.park_code, days.d FROM (SELECT DISTINCT park_code FROM known) p CROSS JOIN days ANTI JOIN known k ON k.park_code = p.park_code AND k.d = days.d),
r AS (SELECT t.park_code, t.d, k.d AS dd, k.h, CASE WHEN month(k.d) = month(t.d) THEN 1.0 ELSE 0.7 END / (1.0 + (t.d - k.d) / 365.0) AS conf FROM tgt t JOIN known k ON k.park_code = t.park_code AND k.d < t.d), b AS (SELECT *, row_number() OVER (PARTITION BY park_code, d ORDER BY conf DESC, dd) AS rn FROM r)
SELECT park_code, CAST(d AS VARCHAR) AS park_date, CAST(dd AS VARCHAR) AS donor_date, round(conf, 9) AS confidence, h[1] AS opening_minute, h[2] AS closing_minute FROM b WHERE rn = 1""")
def q_fill_horizon(spark: SparkSession, d: str) -> DataFrame:
    """Predicted hours of future dates from their donors; the donor is read back from the note."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    parks = F.array(*map(F.lit, ("mk", "ep", "dl", "tdl")))
    known = table(spark, d, "orders").select(F.get(parks, (F.col("o_custkey") % 4).cast("int")).alias("park_code"), day.alias("park_date"), F.month(day).cast("string").alias("date_group_id"), (480 + key % 13 * 5).alias("opening_minute"), (1200 + key % 7).alias("closing_minute"))
    dates = spark.range(1).select(F.explode(F.sequence(F.lit("1999-01-01").cast("date"), F.lit("1999-01-20").cast("date"))).alias("park_date")).withColumn("date_group_id", F.month("park_date").cast("string"))
    filled = flat_hours.fill_horizon(dates, known)
    return filled.select("park_code", F.col("park_date").cast("string").alias("park_date"), flat_hours.donor_date_of(F.col("notes")).cast("string").alias("donor_date"), F.round("confidence", 9).alias("confidence"), "opening_minute", "closing_minute")


@query("""WITH s AS (SELECT c_custkey AS id, k AS tm, CASE WHEN k = 3 AND c_custkey % 4 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS v FROM customer, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE (c_custkey + k) % 5 <> 0),
all_ AS (SELECT ids.id, t.tm, s.v FROM (SELECT DISTINCT id FROM s) ids CROSS JOIN (SELECT DISTINCT tm FROM s) t LEFT JOIN s ON s.id = ids.id AND s.tm = t.tm), c AS (SELECT *, lag(v) OVER (PARTITION BY id ORDER BY tm) AS b FROM all_),
e AS (SELECT *, lead(tm) OVER (PARTITION BY id ORDER BY tm) AS until FROM c WHERE v IS DISTINCT FROM b)
SELECT id AS c_custkey, CASE WHEN b IS NULL THEN 'inserted' ELSE 'changed' END AS change, CAST(tm AS BIGINT) AS valid_from, CAST(until AS DOUBLE) AS valid_until, CAST(v AS BIGINT) AS c_nationkey FROM e WHERE v IS NOT NULL""")
def q_snapshot_history(spark: SparkSession, d: str) -> DataFrame:
    """A history from four full snapshots, in which customers come, change, go and come back."""
    k = F.explode(F.array(*[F.lit(i).cast("bigint") for i in (1, 2, 3, 4)]))
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("n"), k.alias("at")).where((F.col("c_custkey") + F.col("at")) % 5 != 0)
    shown = rows.select("c_custkey", "at", F.when((F.col("at") == 3) & (F.col("c_custkey") % 4 == 0), F.col("n") + 1).otherwise(F.col("n")).alias("c_nationkey"))
    versions_ = history.snapshot_history(shown, ["c_custkey"], "at", ["c_nationkey"])
    return versions_.select("c_custkey", "change", "valid_from", F.col("valid_until").cast("double").alias("valid_until"), "c_nationkey")


# ---- selection and order


@query(f"WITH {FACT} SELECT event_id FROM fact WHERE park_date >= DATE '2024-01-05' AND DATE '2024-01-20' - park_date BETWEEN 0 AND 10 AND entity_code IN (SELECT entity_code FROM fact WHERE wait_time_type = 'PRIORITY' AND wait_time_minutes > 90)")
def q_selected(spark: SparkSession, d: str) -> DataFrame:
    """Readings of a range of dates and a lookback, of entities in a set."""
    rows = facts(spark, d)
    wanted = rows.where("wait_time_type = 'PRIORITY' AND wait_time_minutes > 90")
    return selection.members(selection.lookback(selection.between_dates(rows, "park_date", "2024-01-05"), "park_date", 10, "2024-01-20"), wanted, ["entity_code"]).select("event_id")


@query(f"WITH {FACT} SELECT 'newest' AS pick, event_id FROM (SELECT event_id FROM fact ORDER BY observed_us DESC, event_id LIMIT 15) UNION ALL SELECT 'head', event_id FROM (SELECT event_id FROM fact ORDER BY entity_code, event_id LIMIT 7) UNION ALL SELECT 'least', event_id FROM (SELECT event_id FROM fact ORDER BY wait_time_minutes, event_id LIMIT 20)")
def q_newest_rows(spark: SparkSession, d: str) -> DataFrame:
    """The newest 15 readings, the first of a sorted list, and the 20 smallest."""
    rows = facts(spark, d)
    picks = {"newest": selection.newest(rows, F.col("observed_us"), 15, "event_id"), "head": selection.head(rows, ["entity_code", "event_id"], 7), "least": selection.head(rows, ["wait_time_minutes", "event_id"], 20)}
    named = [frame.select(F.lit(name).alias("pick"), "event_id") for name, frame in picks.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


_INDEX = """idx AS (SELECT entity_code, any_value(park_code) AS park_code, max(observed_us) AS latest, count(*) AS row_count, count(*) FILTER (wait_time_type = 'ACTUAL') AS actual_count, count(*) FILTER (wait_time_type = 'POSTED') AS posted_count, count(*) FILTER (wait_time_type = 'PRIORITY') AS priority_count FROM fact GROUP BY entity_code)"""


@query(f"""WITH {FACT}, {_INDEX}, p AS (SELECT *, CASE park_code WHEN 'mk' THEN 0 WHEN 'ep' THEN 1 WHEN 'hs' THEN 2 ELSE 3 END AS pr FROM idx)
SELECT entity_code, pr AS priority, row_number() OVER (ORDER BY pr, actual_count DESC, entity_code) AS place, row_number() OVER (ORDER BY latest DESC, entity_code) AS recency FROM p""")
def q_training_order(spark: SparkSession, d: str) -> DataFrame:
    """The order in which entities are trained, and their place by latest reading."""
    index = dedupe.entity_index(facts(spark, d))
    ordered = selection.training_order(index, ("mk", "ep", "hs"), park_of(F.col("entity_code")))
    places = with_ordinal(ordered.select("entity_code", "priority", "actual_count"), [], [F.col("priority"), F.col("actual_count").desc(), F.col("entity_code")], F.col("priority"), "place")
    day = -F.floor(F.col("latest_observed_us") / F.lit(86_400_000_000))
    recency = with_ordinal(dedupe.latest_first(index).select("entity_code", "latest_observed_us"), [], [F.col("latest_observed_us").desc(), F.col("entity_code")], day, "recency")
    return places.select("entity_code", "priority", "place").join(recency.select("entity_code", "recency"), "entity_code")


@query(f"WITH {FACT}, {_INDEX} SELECT column_name, count(*) AS entities, count(*) FILTER (v > 0) AS with_any, CAST(sum(v) AS BIGINT) AS total, round(avg(v), 6) AS mean FROM (UNPIVOT idx ON actual_count, posted_count, priority_count INTO NAME column_name VALUE v) GROUP BY 1")
def q_index_summary(spark: SparkSession, d: str) -> DataFrame:
    """Entities, totals and means of the index's counts."""
    return reports.index_summary(dedupe.entity_index(facts(spark, d))).withColumn("mean", F.round("mean", 6))


@query(f"WITH {FACT}, {_INDEX} SELECT entity_code, CAST(CASE WHEN actual_count > 3 THEN 2000 WHEN actual_count > 1 THEN 1000 END AS DOUBLE) AS last_modeled_us FROM idx WHERE actual_count > 1")
def q_mark_modeled(spark: SparkSession, d: str) -> DataFrame:
    """Marks of last models after two rounds of training; an old mark that comes late changes nothing."""
    index = dedupe.entity_index(facts(spark, d))
    marks = index.select("entity_code", F.lit(None).cast("bigint").alias("last_modeled_us")).limit(0)
    for least, at in ((1, 1000), (3, 2000), (3, 500)):
        marks = dedupe.mark_modeled(marks, index.where(F.col("actual_count") > least), at)
    return marks.withColumn("last_modeled_us", F.col("last_modeled_us").cast("double"))


# ---- names and reports


@query(f"""WITH {FACT}, e AS (SELECT upper(regexp_replace(entity_code, '^\\s+|\\s+$', '', 'g')) AS code, min((short_name, fastpass_booth)) AS p FROM dimentity WHERE entity_code IS NOT NULL GROUP BY 1),
k AS (SELECT DISTINCT upper(regexp_replace(entity_code, '^\\s+|\\s+$', '', 'g')) AS code FROM dedupe_keys WHERE entity_code IS NOT NULL)
SELECT k.code AS entity_code, CASE WHEN coalesce(trim(p[1]), '') = '' THEN k.code ELSE k.code || ' - ' || trim(p[1]) END AS display, coalesce(lower(trim(p[2])) IN ('true', 't', 'yes', 'y') OR TRY_CAST(trim(p[2]) AS DOUBLE) <> 0, FALSE) AS is_priority_queue FROM k LEFT JOIN e USING (code)""")
def q_entity_properties(spark: SparkSession, d: str) -> DataFrame:
    """Display name and priority-queue flag of every entity that has readings, looked up without regard to case."""
    seen = table(spark, d, "dedupe_keys").where(F.col("entity_code").isNotNull()).select(F.lower(code(F.col("entity_code"))).alias("entity_code")).distinct()
    rows = names.with_properties(seen, table(spark, d, "dimentity"), ["short_name", "fastpass_booth"])
    upper = F.upper("entity_code")
    return rows.select(upper.alias("entity_code"), names.display_name(upper, F.col("short_name")).alias("display"), names.truthy(F.col("fastpass_booth")).alias("is_priority_queue"))


@query(f"""WITH {FACT}, {_INDEX}, e AS (SELECT entity_code FROM idx UNION SELECT 'ZZ' || n_nationkey FROM nation)
SELECT entity_code, coalesce(row_count, 0) AS row_count, coalesce(actual_count, 0) AS actual_count, CAST(latest AS DOUBLE) AS latest_observed_us FROM e LEFT JOIN idx USING (entity_code)""")
def q_entity_list(spark: SparkSession, d: str) -> DataFrame:
    """The entity list with the counts of the index; entities without readings have zeros."""
    index = dedupe.entity_index(facts(spark, d))
    listed = index.select("entity_code").union(table(spark, d, "nation").select(F.concat(F.lit("ZZ"), F.col("n_nationkey").cast("string"))))
    return dedupe.with_index(listed, index).select("entity_code", "row_count", "actual_count", F.col("latest_observed_us").cast("double").alias("latest_observed_us"))


@query(f"""WITH {FACT} SELECT 'wait_time_type' AS column_name, wait_time_type AS value, count(*) AS n FROM fact GROUP BY 2 UNION ALL SELECT 'park_code', park_code, count(*) FROM fact GROUP BY 2
UNION ALL SELECT 'distinct', 'entity_code', count(DISTINCT entity_code) FROM fact UNION ALL SELECT 'distinct', 'park_code_wait_time_type', count(DISTINCT (park_code, wait_time_type)) FROM fact""")
def q_value_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows per type and per park; different entities and combinations."""
    rows = facts(spark, d)
    distinct = reports.distinct_counts(rows, ["entity_code"], [["park_code", "wait_time_type"]])
    listed = distinct.select(F.inline(F.array(*[F.struct(F.lit("distinct").alias("column_name"), F.lit(c[2:]).alias("value"), F.col(c).alias("n")) for c in distinct.columns])))
    return reports.value_counts(rows, ["wait_time_type", "park_code"]).unionByName(listed)


@query(f"WITH {FACT} SELECT park_code, count(DISTINCT event_id % 7) AS n_files, count(*) AS n_rows, count(DISTINCT park_date) AS n_dates, CAST(min(park_date) AS VARCHAR) AS first_date, CAST(max(park_date) AS VARCHAR) AS last_date FROM fact GROUP BY 1")
def q_coverage_summary(spark: SparkSession, d: str) -> DataFrame:
    """Files, rows and dates per park."""
    return reports.coverage_summary(facts(spark, d), F.col("event_id") % 7).withColumns({c: F.col(c).cast("string") for c in ("first_date", "last_date")})


@query(f"""WITH {FACT}, v AS (SELECT CAST(event_id % 7 AS VARCHAR) AS file, wait_time_type AS t, wait_time_minutes AS m FROM fact), w AS (SELECT *, CASE WHEN t IN ('POSTED', 'ACTUAL') THEN m BETWEEN 0 AND 1000 WHEN t = 'PRIORITY' THEN m BETWEEN -100 AND 2000 OR m = 8888 ELSE FALSE END AS ok FROM v)
SELECT coalesce(file, 'all') AS file, count(*) AS total, count(*) FILTER (NOT ok) AS invalid, count(*) FILTER (NOT ok OR (t IN ('POSTED', 'ACTUAL') AND m >= 300)) AS outliers FROM w GROUP BY GROUPING SETS ((file), ())""")
def q_validation_report(spark: SparkSession, d: str) -> DataFrame:
    """Invalid and outlying values per file and in all."""
    found = reports.validation_report(facts(spark, d), (F.col("event_id") % 7).cast("string"), F.col("wait_time_type"), F.col("wait_time_minutes").cast("string"))
    return found.select(F.when(F.col("is_total") == 1, "all").otherwise(F.col("file")).alias("file"), "total", "invalid", "outliers")


@query(f"""WITH {FACT}, c AS (SELECT park_code, entity_code, count(*) AS n FROM fact GROUP BY ALL), b AS (SELECT *, row_number() OVER (ORDER BY n DESC, entity_code) AS place FROM c), k AS (SELECT *, row_number() OVER (PARTITION BY park_code ORDER BY place) AS i FROM b WHERE place <= 30)
SELECT park_code, entity_code, n, place FROM k WHERE place <= 20 OR i = 1""")
def q_diverse_pick(spark: SparkSession, d: str) -> DataFrame:
    """The busiest twenty entities, and of the next ten those of parks not seen before."""
    counted = facts(spark, d).groupBy("park_code", "entity_code").agg(F.count(F.lit(1)).alias("n"))
    return flat_hours.diverse_pick(counted).withColumn("place", F.col("place").cast("bigint"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN '09:00' ELSE printf('%02d:%02d', event_id % 24, event_id % 60) END AS hhmm, 'Donor' AS mark FROM events""")
def q_clock_text(spark: SparkSession, d: str) -> DataFrame:
    """Hour and minute out of date-time and clock texts, with a default."""
    i = F.col("event_id")
    hm = F.concat(F.lpad((i % 24).cast("string"), 2, "0"), F.lit(":"), F.lpad((i % 60).cast("string"), 2, "0"))
    text = F.when(i % 4 == 1, F.concat(F.lit("2024-01-01T"), hm, F.lit(":00-05:00"))).when(i % 4 == 2, hm).when(i % 4 == 3, F.concat(F.lit("2024-01-01 "), hm, F.lit(":30")))
    return table(spark, d, "events").select("event_id", parse.clock_text(text).alias("hhmm"), F.lit("Donor").alias("mark"))


@query("SELECT o_custkey % 5 AS k, median(o_totalprice) AS m FROM orders GROUP BY 1")
def q_exact_medians(spark: SparkSession, d: str) -> DataFrame:
    """Exact medians of a continuous value, by bracket and count."""
    return exact_medians(table(spark, d, "orders").select((F.col("o_custkey") % 5).alias("k"), "o_totalprice"), ["k"], "o_totalprice", "m")
