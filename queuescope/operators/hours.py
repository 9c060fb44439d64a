"""Park hours as typed rows: instants, flags and what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuescope.constants import FILLERS, ZONES
from queuescope.functions.codes import code, zone_of_park
from queuescope.functions.timestamps import trimmed, with_instant

TIME_FIELDS = ("opening_time", "closing_time")


def text_date(text: Column) -> Column:
    """The date of a YYYY-MM-DD text; null where it is none."""
    return F.when(trimmed(text).rlike(r"^\d{4}-\d{2}-\d{2}$"), trimmed(text)).try_cast("date")


def is_filler(text: Column) -> Column:
    """Whether a text is null, blank or stands for an absent value."""
    return text.isNull() | F.lower(trimmed(text)).isin(*FILLERS)


def with_hours_instants(frame: DataFrame) -> DataFrame:
    """Adds park (trimmed, upper case), zone, park_day (date) and opening/closing instants in microseconds.

    A bare clock time belongs to the row's park_date, before 06:00 to the next
    day.  Rows with unreadable dates keep null instants for bare times.
    """
    base = (
        frame.withColumn("park", code(F.col("park_code")))
        .withColumn("zone", zone_of_park(F.col("park_code")))
        .withColumn("park_day", text_date(F.col("park_date")))
    )
    for field in TIME_FIELDS:
        base = with_instant(base, field, F.col("zone"), field.split("_")[0], base_date=F.col("park_day"), zones=ZONES)
    return base


def usable_hours(frame: DataFrame) -> DataFrame:
    """The rows whose opening and closing time are both real times."""
    return frame.where(F.col("opening_us").isNotNull() & F.col("closing_us").isNotNull())
