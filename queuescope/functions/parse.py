"""Raw submissions and return times to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuescope.constants import SOLD_OUT
from queuescope.functions.codes import code
from queuescope.functions.temporal import wall_clock_us
from queuescope.functions.timestamps import instant_of_wall


def unpivot_standby(frame: DataFrame, posted: str = "submitted_posted_time", actual: str = "submitted_actual_time", low: int = 0, high: int = 1000) -> DataFrame:
    """Wide submissions to one row per value: type POSTED or ACTUAL and whole minutes.

    Texts are coerced and rounded half-even; nulls, texts that are no numbers and
    values outside ``low`` to ``high`` are dropped.
    """
    keep = [c for c in frame.columns if c not in (posted, actual)]

    def whole(c: str) -> Column:
        return F.bround(F.col(c).try_cast("double"), 0).try_cast("bigint")

    values = F.array(*[F.struct(F.lit(kind).alias("wait_time_type"), whole(c).alias("wait_time_minutes")) for kind, c in (("POSTED", posted), ("ACTUAL", actual))])
    return frame.select(*keep, F.inline(values)).where(F.col("wait_time_minutes").between(low, high))


def split_compact(value: Column) -> tuple[Column, Column]:
    """Hour and minute of a compact time: HHMMSS from 10000, HHMM from 100, else the hour alone (minute null)."""
    hour = F.when(value >= 10_000, F.floor(value / 10_000)).when(value >= 100, F.floor(value / 100)).otherwise(value)
    minute = F.when(value >= 10_000, F.floor(value / 100) % 100).when(value >= 100, value % 100)
    return hour.cast("int"), minute.cast("int")


def priority_minutes(year: Column, month: Column, day: Column, observed: Column, observed_minute: Column, returns: Column, return_minute: Column, rollover: int = -15) -> Column:
    """Minutes from observation to return.

    Compact times are split, missing minutes are 0, hours and minutes are clipped
    to the clock; a return more than 15 minutes before the observation is on the
    next day.  A raw return hour from 8000 means sold out and is tested first.
    An impossible date gives null.
    """

    def clock(value: Column, own: Column) -> Column:
        hour, minute = split_compact(value)
        minute = F.coalesce(minute, own, F.lit(0))
        return F.least(F.greatest(hour, F.lit(0)), F.lit(23)) * 60 + F.least(F.greatest(minute, F.lit(0)), F.lit(59))

    none = F.lit(0)
    real = F.try_make_timestamp_ntz(year, month, day, none, none, none.cast("decimal(16,6)")).isNotNull()
    gap = clock(returns, return_minute) - clock(observed, observed_minute)
    rolled = F.when(gap < rollover, gap + 1440).otherwise(gap)
    return F.when(~real, F.lit(None)).when(returns >= 8000, F.lit(SOLD_OUT)).otherwise(rolled).cast("bigint")


def validity(kind: Column, text: Column) -> tuple[Column, Column]:
    """(valid, outlier) of a value by its type; an unknown type or a value that is no whole number is neither.

    POSTED and ACTUAL are valid from 0 to 1000 and outliers from 300; PRIORITY is
    valid from -100 to 2000 or at 8888.
    """
    number = text.try_cast("double")
    whole = number.isNotNull() & (number == F.floor(number))
    wait = kind.isin("POSTED", "ACTUAL")
    priority = kind == "PRIORITY"
    good = F.when(wait, number.between(0, 1000)).when(priority, number.between(-100, 2000) | (number == SOLD_OUT)).otherwise(False)
    valid = F.coalesce(whole & good, F.lit(False))
    outlier = F.when(~valid, True).otherwise(wait & (number >= 300))
    return valid, outlier


def file_kind(path: Column) -> Column:
    """Standby, Old Fastpass, New Fastpass or Unknown by a file's path."""
    # Marks of the old layout in file names.
    old = "_2012|_2013|_2014|_2015|_2016|_2017|_2018|_2019_01|_2019_02|_201901|_201902"
    low = F.lower(path)
    return (
        F.when(low.contains("wait_times"), "Standby")
        .when(low.contains("fastpass_times"), F.when(low.rlike(old), "Old Fastpass").otherwise("New Fastpass"))
        .otherwise("Unknown")
    )


def zone_of_path(path: Column) -> Column:
    """Zone of the property folder that follows wait_times or fastpass_times in a path."""
    from queuescope.operators.readings import zone_of_property

    return zone_of_property(F.regexp_extract(F.lower(path), r"(?:wait_times|fastpass_times)/([^/]+)/", 1))


def priority_rows(frame: DataFrame, zone: Column) -> DataFrame:
    """Raw return-time rows (``PRIORITY_SCHEMA``) as readings: entity_code, observed_us, wait_time_type, wait_time_minutes.

    Codes are trimmed and in upper case; the observation is local time in ``zone``, hour and
    minute clipped to the clock.  Rows without a code, a possible time or minutes are dropped.
    """
    hour, minute = split_compact(F.col("FHOUR"))
    hour = F.least(F.greatest(F.coalesce(hour, F.lit(0)), F.lit(0)), F.lit(23))
    minute = F.least(F.greatest(F.coalesce(minute, F.col("FMIN"), F.lit(0)), F.lit(0)), F.lit(59))
    seconds = F.lit(0).cast("decimal(16,6)")
    wall = wall_clock_us(F.try_make_timestamp_ntz(F.col("FYEAR"), F.col("FMONTH"), F.col("FDAY"), hour, minute, seconds))
    rows = frame.select(
        F.nullif(code(F.col("FATTID")), F.lit("")).alias("entity_code"),
        instant_of_wall(wall, zone).alias("observed_us"),
        F.lit("PRIORITY").alias("wait_time_type"),
        priority_minutes(F.col("FYEAR"), F.col("FMONTH"), F.col("FDAY"), F.col("FHOUR"), F.col("FMIN"), F.col("FWINHR"), F.col("FWINMIN")).alias("wait_time_minutes"),
    )
    return rows.dropna(subset=["entity_code", "observed_us", "wait_time_minutes"])


def clock_text(text: Column, default: str = "09:00") -> Column:
    """HH:MM of a date-time or clock text; the default where it holds none."""
    found = F.regexp_extract(F.coalesce(text, F.lit("")), r"(?:^|[T ])(\d{2}:\d{2})", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(default))
