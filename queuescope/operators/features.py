"""Feature columns: dimension joins, encodings, chronological split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queuescope.constants import ZONES
from queuescope.functions.codes import park_of
from queuescope.functions.temporal import geometric_decay, minutes_since_start_of_day
from queuescope.functions.timestamps import wall_us
from queuescope.operators.aggregates import exact_medians


def label_mapping(frame: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null texts and their numbers from 0: ``column``, ``code``.

    The numbers are counted in ranges of the sorted texts, so no task sees all of them.
    """
    from queuescope.operators.ordered import with_ordinal

    texts = frame.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias(column)).distinct()
    numbered = with_ordinal(texts, [], [F.col(column)], F.substring(column, 1, 2), "__n")
    return numbered.select(column, (F.col("__n") - 1).alias("code"))


def label_encode(frame: DataFrame, column: str, mapping: DataFrame, unknown: str = "ignore") -> DataFrame:
    """Adds ``{column}_code``; unknown texts are null (``ignore``), an error, or appended after the last (``encode``)."""
    rows = frame.withColumn("__t", F.col(column).cast("string"))
    known = mapping.select(F.col(column).alias("__t"), "code")
    if unknown == "encode":
        extra = label_mapping(rows.join(known, "__t", "left_anti"), column).select(F.col(column).alias("__t"), "code")
        start = known.agg((F.coalesce(F.max("code"), F.lit(-1)) + 1).alias("__from"))
        shifted = extra.withColumn("__from", start.scalar()).select("__t", (F.col("code") + F.col("__from")).alias("code"))
        known = known.unionByName(shifted)
    joined = rows.join(known, "__t", "left").withColumnRenamed("code", f"{column}_code").drop("__t")
    if unknown == "error":
        missed = F.col(column).isNotNull() & F.col(f"{column}_code").isNull()
        joined = joined.withColumn(f"{column}_code", F.when(missed, F.raise_error(F.concat(F.lit("unknown value of "), F.lit(column)))).otherwise(F.col(f"{column}_code")))
    return joined


def one_hot(frame: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """An indicator column per value, compared as text; null is none of them."""
    return frame.withColumns({f"{column}_{v}": F.coalesce((F.col(column).cast("string") == v).cast("int"), F.lit(0)) for v in values})


def chronological_split(frame: DataFrame, date: str, train: float = 0.7, validation: float = 0.15) -> DataFrame:
    """Adds ``split`` by distinct dates in order: train, validation, test; counts are cut down to whole dates.

    Rows of one date are never parted; the ranked table holds one row per date.
    """
    dates = frame.where(F.col(date).isNotNull()).select(date).distinct()
    ranked = dates.withColumn("__r", F.row_number().over(Window.orderBy(date)) - 1)
    sized = ranked.withColumn("__n", dates.agg(F.count(F.lit(1))).scalar())
    one, two = F.floor(F.col("__n") * F.lit(train)), F.floor(F.col("__n") * (F.lit(train) + F.lit(validation)))
    split = F.when(F.col("__r") < one, "train").when(F.col("__r") < two, "validation").otherwise("test")
    return frame.join(sized.select(date, split.alias("split")), date, "left")


def join_dimension(facts: DataFrame, dimension: DataFrame, keys: Sequence[str], columns: Sequence[str], require: bool = False) -> DataFrame:
    """Left join of payload columns; with ``require`` a fact without a dimension row is an error.

    Catalyst broadcasts the dimension where its size allows it.
    """
    payload = dimension.select(*keys, *columns, F.lit(True).alias("__hit"))
    joined = facts.join(payload, list(keys), "left")
    if require:
        joined = joined.where(F.when(F.col("__hit").isNull(), F.raise_error(F.lit("a fact has no dimension row"))).otherwise(F.lit(True)))
    return joined.drop("__hit")


def impute(frame: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """Nulls of numbers become the median (0 if there is none), of categories the mode."""
    fills = {c: exact_medians(frame, [], c).scalar() for c in numeric}
    joined = frame
    if categorical:
        modes = [F.mode(c, deterministic=True).alias(f"__{c}") for c in categorical]
        joined = frame.withColumn("__fill", frame.agg(F.struct(*modes)).scalar())
    filled = {c: F.coalesce(F.col(c), fills[c], F.lit(0)) for c in numeric} | {c: F.coalesce(F.col(c), F.col(f"__fill.__{c}")) for c in categorical}
    return joined.withColumns(filled).drop("__fill") if filled else frame


def with_park_code(frame: DataFrame) -> DataFrame:
    """Adds park_code from entity_code where the column is absent."""
    return frame if "park_code" in frame.columns else frame.withColumn("park_code", park_of(F.col("entity_code")))


def with_target(frame: DataFrame) -> DataFrame:
    """Adds the target column observed_wait_time."""
    return frame.withColumn("observed_wait_time", F.col("wait_time_minutes"))


def with_hours_features(frame: DataFrame) -> DataFrame:
    """Features of a row's park hours (observed_us, opening_us, closing_us, emh_morning, emh_evening, zone); null where it has none.

    Minutes since opening, local hour of opening and closing, hours open (a closing before the
    opening is on the next day) and the flags.
    """
    opening, closing = F.col("opening_us"), F.col("closing_us")
    hour = F.lit(3_600_000_000)

    def local_hour(us: Column) -> Column:
        return F.pmod(F.floor(wall_us(us, F.col("zone"), ZONES) / hour), F.lit(24)).cast("bigint")

    return frame.withColumns({
        "pred_mins_since_park_open": (F.col("observed_us") - opening) / F.lit(60_000_000),
        "pred_park_open_hour": local_hour(opening),
        "pred_park_close_hour": local_hour(closing),
        "pred_park_hours_open": (closing - opening) / hour + F.when(closing < opening, 24.0).otherwise(0.0),
        "pred_emh_morning": F.col("emh_morning"),
        "pred_emh_evening": F.col("emh_evening"),
    })


def feature_pipeline(facts: DataFrame, date_groups: DataFrame, seasons: DataFrame, now_us: int) -> DataFrame:
    """All features of readings: operational day, date group, season, decay weight, target and park hours.

    ``facts``: entity_code, park_code, zone, park_date (date), observed_us, wait_time_minutes, and
    opening_us, closing_us and flags where the hours are known.  ``date_groups``: park_date, date_group_id, one row
    for every date in the facts (a missing one is an error); ``seasons``: park_date, season, season_year.
    """
    local = wall_us(F.col("observed_us"), F.col("zone"), ZONES)
    rows = with_target(with_park_code(facts)).withColumns({
        "pred_mins_since_6am": minutes_since_start_of_day(local),
        "wgt_geo_decay": geometric_decay((F.lit(now_us) - F.col("observed_us")) / F.lit(86_400_000_000)),
    })
    grouped = join_dimension(rows, date_groups.select("park_date", F.col("date_group_id").alias("pred_dategroupid")), ["park_date"], ["pred_dategroupid"], require=True)
    named = seasons.select("park_date", F.col("season").alias("pred_season"), F.col("season_year").alias("pred_season_year"))
    return with_hours_features(join_dimension(grouped, named, ["park_date"], ["pred_season", "pred_season_year"]))
