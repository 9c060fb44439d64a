"""The fact view over the event stream table, and the registry of queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuescope.functions.codes import park_of, zone_of_park
from queuescope.functions.temporal import wall_clock_us
from queuescope.functions.timestamps import wall_us
from queuescope.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Prefixes that events are dealt over, and the reading type of each event type.
PREFIXES = ("MK", "EP", "HS", "AK", "DL", "CA", "TDL", "TDS", "IA", "UF", "EU", "USH")
TYPE_OF_EVENT = {"view": "POSTED", "click": "POSTED", "purchase": "ACTUAL", "signup": "PRIORITY", "error": "OTHER"}


def query(sql: str | None = None, nullable: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Registers a query under its name, with its SQL twin if SQL can express it.

    ``nullable`` names whole-number columns that may be null: both sides give them
    as doubles, the one type that every client represents alike with nulls.
    """

    def register(f: Query) -> Query:
        def run(spark: SparkSession, d: str) -> DataFrame:
            return f(spark, d).withColumns({c: F.col(c).cast("double") for c in nullable})

        QUERIES[f.__name__] = run if nullable else f
        if sql is not None:
            doubled = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in nullable)
            SQL[f.__name__] = f"SELECT * REPLACE ({doubled}) FROM ({sql}) AS twin" if nullable else sql
        return f

    return register


def facts(spark: SparkSession, d: str) -> DataFrame:
    """Events as readings: event_id, entity_code, park_code, zone, observed_us, local_us, park_date, wait_time_type, wait_time_minutes."""
    events = table(spark, d, "events")
    prefixes = F.array(*[F.lit(p) for p in PREFIXES])
    kinds = F.create_map(*[F.lit(x) for pair in TYPE_OF_EVENT.items() for x in pair])
    rows = events.select(
        "event_id",
        F.concat(F.get(prefixes, (F.col("user_id") % len(PREFIXES)).cast("int")), F.col("user_id").cast("string")).alias("entity_code"),
        wall_clock_us(F.col("ts")).alias("observed_us"),
        F.coalesce(F.try_element_at(kinds, "event_type"), F.lit("OTHER")).alias("wait_time_type"),
        F.bround("value", 0).cast("bigint").alias("wait_time_minutes"),
        "value",
        "user_id",
    )
    placed = rows.withColumn("park_code", park_of(F.col("entity_code"))).withColumn("zone", zone_of_park(F.col("park_code")))
    local = placed.withColumn("local_us", wall_us(F.col("observed_us"), F.col("zone")))
    return local.withColumn("park_date", F.date_from_unix_date(F.floor((F.col("local_us") - F.lit(21_600_000_000)) / F.lit(86_400_000_000)).cast("int")))


_LIST = "[" + ", ".join(f"'{p}'" for p in PREFIXES) + "]"
#: The same view as SQL; a statement goes on after ``WITH {FACT}``.
FACT = f"""fact AS (
  SELECT *, CAST(local_ts - INTERVAL 6 HOUR AS DATE) AS park_date, epoch_us(ts) AS observed_us FROM (
    SELECT *, (ts AT TIME ZONE 'UTC') AT TIME ZONE zone AS local_ts FROM (
      SELECT *, CASE WHEN park_code IN ('dl', 'ca', 'uh') THEN 'America/Los_Angeles' WHEN park_code IN ('tdl', 'tds') THEN 'Asia/Tokyo' ELSE 'America/New_York' END AS zone FROM (
        SELECT event_id, user_id, ts, value, {_LIST}[1 + user_id % 12] || user_id AS entity_code,
          CASE {_LIST}[1 + user_id % 12] WHEN 'USH' THEN 'uh' ELSE lower({_LIST}[1 + user_id % 12]) END AS park_code,
          CASE event_type WHEN 'view' THEN 'POSTED' WHEN 'click' THEN 'POSTED' WHEN 'purchase' THEN 'ACTUAL' WHEN 'signup' THEN 'PRIORITY' ELSE 'OTHER' END AS wait_time_type,
          CAST(round_even(value, 0) AS BIGINT) AS wait_time_minutes
        FROM events))))"""
