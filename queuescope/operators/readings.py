"""Wait-time readings as typed rows, and readings that report a known one again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queuescope.constants import DAY_FIRST_PROPERTIES, DEFAULT_ZONE, ZONE_OF_PROPERTY, ZONES
from queuescope.functions.codes import code, park_date_of, park_of_code, zone_of_park
from queuescope.functions.timestamps import lookup, trimmed, with_instant
from queuescope.session import cut, spread


def zone_of_property(prop: Column) -> Column:
    """Zone in which a property writes its local times."""
    return lookup(ZONE_OF_PROPERTY, F.lower(trimmed(prop)), DEFAULT_ZONE)


def with_reading_instant(frame: DataFrame) -> DataFrame:
    """Adds observed_us and observed_notation to raw readings; local times are in the property's zone."""
    prop = F.lower(trimmed(F.col("prop")))
    return with_instant(frame, "observed_at", zone_of_property(F.col("prop")), "observed", day_first=prop.isin(*DAY_FIRST_PROPERTIES), zones=ZONES)


def with_source_key(readings: DataFrame) -> DataFrame:
    """Adds source_key, the 64-bit hash of source by which shuffles group, where it is absent."""
    return readings if "source_key" in readings.columns else readings.withColumn("source_key", F.xxhash64("source"))


def typed_readings(frame: DataFrame, columns: Sequence[str] = ("ingest_seq", "batch_id", "source", "source_key", "entity", "kind", "park", "park_day", "observed_us", "minutes")) -> DataFrame:
    """Readings with an instant and an entity; ``columns`` are those to be written.

    ``source`` is entity and wait_time_type, trimmed and in upper case, ``source_key`` its
    64-bit hash, ``park_day`` the operational date at the park.  A null type is a source of its
    own; minutes may be null.
    """
    raw = frame.where(F.col("entity_code").isNotNull()).select("ingest_seq", "batch_id", "prop", "entity_code", "observed_at", "wait_time_type", "wait_time_minutes")
    coded = with_reading_instant(spread(raw)).withColumns({"entity": code(F.col("entity_code")), "kind": code(F.col("wait_time_type"))})
    coded = coded.withColumn("park", park_of_code(F.col("entity")))
    source = F.concat_ws("|", "entity", "kind")
    # cut before the filter: pushed down, it would parse every text a second time
    typed = cut(
        coded.select(
            "ingest_seq", "batch_id", source.alias("source"), F.xxhash64(source).alias("source_key"), "entity", "kind",
            "park", park_date_of(F.col("observed_us"), zone_of_park(F.col("park"))).alias("park_day"), "observed_us", F.col("wait_time_minutes").cast("bigint").alias("minutes"),
        ).select(*dict.fromkeys([*columns, "observed_us"]))
    )
    return typed.where(F.col("observed_us").isNotNull()).select(*columns)


def later_repeats(readings: DataFrame, seconds: int = 30, minutes: int = 1, block_us: int = 6 * 3_600_000_000) -> DataFrame:
    """ingest_seq of readings that an earlier-arrived reading of the source already reported.

    Two readings are one report when their instants are at most ``seconds`` and
    their values at most ``minutes`` apart; any tolerance from 0 up will do.

    Only readings with another one of their source in reach of ``seconds`` can be
    repeats: one sorted pass over blocks of time finds them (those near the edge
    of a block always go on).  Of these the earlier side stands in one cell of
    time and value and keeps one row per different instant and value, the first
    to arrive; the later side asks its own cell and those neighbours that are in
    reach.  A semi-join then tells whether an earlier reading exists; no pairs
    come out.
    """
    reach = seconds * 1_000_000
    rows = with_source_key(readings).where(F.col("minutes").isNotNull() & F.col("observed_us").isNotNull()).select("ingest_seq", "source_key", "observed_us", "minutes")
    us, block = F.col("observed_us"), F.floor(F.col("observed_us") / F.lit(block_us))
    ordered = Window.partitionBy("source_key", "__block").orderBy("observed_us")
    near = rows.withColumn("__block", block).withColumns({"__before": us - F.lag(us).over(ordered), "__after": F.lead(us).over(ordered) - us})
    edge = (F.pmod(us, F.lit(block_us)) <= reach) | (F.pmod(us, F.lit(block_us)) >= block_us - reach)
    near = cut(near.where((F.col("__before") <= reach) | (F.col("__after") <= reach) | edge).drop("__block", "__before", "__after"))

    width, step = max(4 * reach, 1), 8 * max(minutes, 1)

    def cell(value: Column, size: int) -> Column:
        return F.floor(value / F.lit(size)).cast("bigint")

    def asked(value: Column, apart: int, size: int) -> Column:
        """The one or two cells that hold all values within reach."""
        return F.sequence(cell(value - F.lit(apart), size), cell(value + F.lit(apart), size))

    early = near.groupBy("source_key", "observed_us", "minutes").agg(F.min("ingest_seq").alias("first_seq"))
    early = early.select(F.xxhash64("source_key", cell(us, width), cell(F.col("minutes"), step)).alias("cell"), F.col("source_key").alias("e_key"), F.col("observed_us").alias("e_us"), F.col("minutes").alias("e_minutes"), "first_seq")
    late = near.withColumn("t", F.explode(asked(us, reach, width))).withColumn("v", F.explode(asked(F.col("minutes"), minutes, step)))
    late = late.withColumn("cell", F.xxhash64("source_key", "t", "v"))
    same = (
        (late["cell"] == early["cell"])
        & (F.col("source_key") == F.col("e_key"))
        & (F.col("first_seq") < F.col("ingest_seq"))
        & (F.abs(us - F.col("e_us")) <= reach)
        & (F.abs(F.col("minutes") - F.col("e_minutes")) <= minutes)
    )
    return late.join(early, same, "left_semi").select("ingest_seq").distinct()
