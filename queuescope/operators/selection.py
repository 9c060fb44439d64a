"""Row selection: date ranges, lookback, membership, newest and ranked rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def between_dates(frame: DataFrame, date: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows of a range of dates, both ends included and either one optional; with a bound, null dates are out."""
    kept = frame
    if first is not None:
        kept = kept.where(F.col(date) >= F.lit(first).cast("date"))
    if last is not None:
        kept = kept.where(F.col(date) <= F.lit(last).cast("date"))
    return kept


def lookback(frame: DataFrame, date: str, days: int, today: str) -> DataFrame:
    """Rows of today and the ``days`` days before it; the future and null dates are out."""
    return frame.where(F.datediff(F.lit(today).cast("date"), F.col(date)).between(0, days))


def members(frame: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys stand in ``wanted``; repeats there repeat nothing, null keys are in no set."""
    return frame.join(wanted.select(*keys), list(keys), "left_semi")


def newest(frame: DataFrame, at: Column, n: int, *ties: str) -> DataFrame:
    """The ``n`` newest rows, null times last; ties by the given columns.  Each task keeps its own ``n`` at most."""
    return frame.orderBy(at.desc_nulls_last(), *ties).limit(n)


def head(frame: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return frame.orderBy(*order).limit(n)


def training_order(index: DataFrame, parks: Sequence[str], park: Column, count: str = "actual_count") -> DataFrame:
    """Adds ``priority`` (place of the park in ``parks``; all others after them), and sorts by it, the greater count and the entity."""
    place = F
    for i, name in enumerate(parks):
        place = place.when(park == name, i)
    return index.withColumn("priority", place.otherwise(len(parks)).cast("int")).orderBy("priority", F.col(count).desc(), "entity_code")
