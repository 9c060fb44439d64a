"""Five-minute curves: slots, observed before predicted, and the index over entities."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuescope.constants import ZONES
from queuescope.functions.temporal import display_actual, display_posted, label
from queuescope.functions.timestamps import instant_of_wall, wall_us
from queuescope.operators.aggregates import fallback_lookup
from queuescope.operators.asof import forward_preferred, nearest


def slot_minutes(opening: Column, closing: Column, width: int = 5) -> Column:
    """Array of slot minutes from opening to closing, both included.

    Within the first hour slots count from the opening minute; every later hour
    starts at its full hour.  Closing before opening is on the next day, where
    slots run on from midnight (minutes 1440 and more).
    """
    end = F.when(closing < opening, closing + 1440).otherwise(closing)
    hour_end = F.floor(opening / 60) * 60 + 59
    none = F.array().cast("array<bigint>")
    first = F.sequence(opening, F.least(hour_end, end), F.lit(width).cast("bigint"))
    rest = F.when(end > hour_end, F.sequence(hour_end + 1, end, F.lit(width).cast("bigint"))).otherwise(none)
    return F.concat(first, rest)


def slot_grid(hours: DataFrame, opening: str = "opening_minute", closing: str = "closing_minute", width: int = 5) -> DataFrame:
    """Rows of hours times their slots: ``slot_minute`` and ``time_slot``; rows with a null time have no slots."""
    rows = hours.where(F.col(opening).isNotNull() & F.col(closing).isNotNull())
    exploded = rows.withColumn("slot_minute", F.explode(slot_minutes(F.col(opening).cast("bigint"), F.col(closing).cast("bigint"), width)))
    return exploded.withColumn("time_slot", label(F.col("slot_minute")))


def coalesce_curves(backfill: DataFrame, forecast: DataFrame, keys: Sequence[str] = ("entity_code", "park_date", "time_slot")) -> DataFrame:
    """One value per slot: the backfilled actual where there is one, else the forecast."""
    joined = backfill.select(*keys, "actual").join(forecast.select(*keys, "actual_predicted"), list(keys), "full_outer")
    return joined.select(*keys, F.coalesce("actual", "actual_predicted").alias("value"))


def wait_index(grid: DataFrame, curve: DataFrame) -> DataFrame:
    """Mean, count, least and greatest value over the entities of a park per date and slot.

    ``grid``: park_code, park_date, time_slot; ``curve`` has the same keys per entity and
    ``value``.  A slot without values is kept with a null index and 0 entities.
    """
    keys = ["park_code", "park_date", "time_slot"]
    per = curve.groupBy(*keys).agg(F.avg("value").alias("wti"), F.count("value").alias("n_entities"), F.min("value").alias("min_actual"), F.max("value").alias("max_actual"))
    return grid.select(*keys).distinct().join(per, keys, "left").withColumn("n_entities", F.coalesce("n_entities", F.lit(0)))


def hours_of_day(hours: DataFrame, rank: Column, keys: Sequence[str] = ("park", "park_day"), default: tuple[int, int] = (540, 1320), wanted: DataFrame | None = None) -> DataFrame:
    """One row per park and day: opening_minute and closing_minute of the local day from the row of the greatest rank.

    ``hours``: keys, zone, opening_us, closing_us.  Keys of ``wanted`` that no row has get the ``default`` hours.
    """
    minute = F.lit(60_000_000)

    def of_day(us: str) -> Column:
        return F.pmod(F.floor(wall_us(F.col(us), F.col("zone"), ZONES) / minute), F.lit(1440)).cast("bigint")

    best = hours.groupBy(*keys).agg(F.max_by(F.struct(of_day("opening_us").alias("opening_minute"), of_day("closing_us").alias("closing_minute")), rank).alias("__h"))
    known = best.select(*keys, "__h.*")
    if wanted is None:
        return known
    joined = wanted.select(*keys).distinct().join(known, list(keys), "left")
    return joined.withColumns({"opening_minute": F.coalesce("opening_minute", F.lit(default[0])), "closing_minute": F.coalesce("closing_minute", F.lit(default[1]))})


def slots_of(entities: DataFrame, days: DataFrame, zone: Column) -> DataFrame:
    """Slots of every entity on every day it has hours for: entity, park, park_day, slot_minute, time_slot, at_us and slot_id.

    ``entities``: entity, park, park_day; ``days``: park, park_day, opening_minute, closing_minute.  A slot's
    instant is its local time; slots past midnight are on the next calendar day.
    """
    rows = slot_grid(entities.select("entity", "park", "park_day").distinct().join(days, ["park", "park_day"])).drop("opening_minute", "closing_minute")
    wall = F.unix_date("park_day") * F.lit(86_400_000_000).cast("bigint") + F.col("slot_minute") * F.lit(60_000_000).cast("bigint")
    timed = rows.withColumn("at_us", instant_of_wall(wall, zone))
    return timed.withColumn("slot_id", F.concat_ws(" ", "entity", F.col("park_day").cast("string"), F.lpad("slot_minute", 4, "0")))


def slot_observations(slots: DataFrame, readings: DataFrame, ahead_us: int = 600_000_000, back_us: int = 900_000_000, actual_us: int = 300_000_000) -> DataFrame:
    """Slots with ``posted`` and ``actual``.

    Posted: the next reading of the day if it is at most ten minutes later; only if none comes later at all, the
    nearest before, at most 15 minutes back.  Actual: the nearest within five minutes.  Of
    readings at one moment, and of two equally near ones, the lowest ingest_seq counts.
    """
    keys = ["entity", "park_day"]
    rows = readings.where(F.col("minutes").isNotNull()).select(*keys, F.col("observed_us").alias("at_us"), "ingest_seq", "kind", "minutes")
    narrow = slots.select(*keys, "at_us", "slot_id")
    posted = forward_preferred(narrow, rows.where("kind = 'POSTED'"), keys, "at_us", "slot_id", "minutes", "ingest_seq", ahead_us, back_us)
    actual = nearest(narrow, rows.where("kind = 'ACTUAL'"), keys, "at_us", "slot_id", "minutes", "ingest_seq", tolerance_us=actual_us)
    seen = posted.select("slot_id", F.col("minutes").alias("posted")).join(actual.select("slot_id", F.col("minutes").alias("actual")), "slot_id")
    return slots.join(seen, "slot_id")


def backfill_curve(slots: DataFrame, predict: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Past curve: the observed actual wait, else the model's from the posted one; ``actual`` is null where there is neither.

    ``slots`` come from :func:`slot_observations`; ``predict`` adds ``prediction`` to slots (of the model with posted times).
    """
    value = F.coalesce("actual", F.when(F.col("posted").isNotNull(), F.greatest(F.col("prediction"), F.lit(0.0))))
    return predict(slots).select("entity", "park", "park_day", "time_slot", value.alias("actual"), F.when(F.col("actual").isNotNull(), "observed").otherwise("imputed").alias("source"))


def forecast_curve(slots: DataFrame, aggregates: DataFrame, date_groups: DataFrame, predict: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Future curve: the model's actual wait in whole minutes and the posted one of the five-level lookup as a multiple of five.

    ``aggregates``: entity_code, dategroupid, hour, posted_median; ``date_groups``: park_day, dategroupid.  A slot is kept
    if it has either value.
    """
    hour = F.pmod(F.floor(F.col("slot_minute") / 60), F.lit(24)).cast("bigint")
    keyed = slots.join(date_groups, "park_day", "left").select("slot_id", F.col("entity").alias("entity_code"), "dategroupid", hour.alias("hour"))
    posted = fallback_lookup(keyed, aggregates).select("slot_id", display_posted(F.col("predicted")).alias("posted_predicted"))
    rows = predict(slots).join(posted, "slot_id")
    predicted = display_actual(F.greatest(F.col("prediction"), F.lit(0.0)))
    out = rows.select("entity", "park", "park_day", "time_slot", F.when(F.col("prediction").isNotNull(), predicted).alias("actual_predicted"), "posted_predicted")
    return out.where(F.col("actual_predicted").isNotNull() | F.col("posted_predicted").isNotNull())
