"""Filling missing values from neighbours in time, with a mark on every filled value.

Numbers are interpolated between the observed neighbours of their entity;
where one side is missing the other is carried within ``carry_days``.
Categories are carried from the nearer neighbour within ``carry_days``.  What
is left takes the median (numbers) or the most frequent value (categories) of
the widest group that has one: entity group and weekday, then entity group,
then group alone.  Each fill has a method and the distance in days it was
borrowed over; statistics have no distance.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuescope.operators.hours import is_filler
from queuescope.operators.ordered import null_safe_join, with_neighbours
from queuescope.session import cut


class Field(NamedTuple):
    """A column to fill and where the result goes."""

    value: str
    out: str
    numeric: bool


def fill_in_time(
    frame: DataFrame,
    entity: Sequence[str],
    day: str,
    order: Sequence[Column],
    fields: Sequence[Field],
    *,
    carry_days: int = 30,
    fallbacks: Sequence[Sequence[str]] = (),
) -> DataFrame:
    """Adds per field ``{out}`` (value or fill), ``{out}_method`` and ``{out}_distance``.

    ``day`` is a date column (rows with a null day have no distances and are
    filled by statistics only); ``order`` must end with a unique column.
    The method is ``observed``, ``interpolated``, ``carried``, ``group`` or ``none``.
    """
    at = F.unix_date(F.col(day))
    known = {
        f.out: F.when(F.col(f.value).isNotNull() & F.col(day).isNotNull(), F.struct(at.alias("at"), F.col(f.value).alias("v")))
        for f in fields
    }
    work = with_neighbours(frame, entity, order, F.trunc(F.col(day), "month"), known)
    for i, keys in enumerate(fallbacks):
        typical = [(F.median(f.value) if f.numeric else F.mode(f.value, deterministic=True)).alias(f"__s{i}_{f.out}") for f in fields]
        work = null_safe_join(work, frame.groupBy(*keys).agg(*typical), keys)
    results: dict[str, Column] = {}
    for f in fields:
        before, after = F.col(f"{f.out}_before"), F.col(f"{f.out}_after")
        back, ahead = at - before["at"], after["at"] - at
        near_back, near_ahead = F.coalesce(back <= carry_days, F.lit(False)), F.coalesce(ahead <= carry_days, F.lit(False))
        nearer_back = near_back & (~near_ahead | (back <= ahead))
        between = near_back & near_ahead & F.lit(f.numeric)
        span = after["at"] - before["at"]
        carried = F.when(nearer_back, before["v"]).when(near_ahead, after["v"])
        if f.numeric:
            slope = F.when(span > 0, (after["v"] - before["v"]) / span).otherwise(F.lit(0.0))
            filled = F.when(between, before["v"] + slope * back).otherwise(carried)
        else:
            filled = carried
        last = F.coalesce(*[F.col(f"__s{i}_{f.out}") for i in range(len(fallbacks))], F.lit(None))
        seen = F.col(f.value).isNotNull()
        how = F.when(between, "interpolated").otherwise("carried")
        results |= {
            f.out: F.coalesce(F.col(f.value), filled, last),
            f"{f.out}_method": F.when(seen, "observed").when(filled.isNotNull(), how).when(last.isNotNull(), "group").otherwise("none"),
            f"{f.out}_distance": F.when(seen, 0).when(filled.isNotNull(), F.when(between, F.least(back, ahead)).when(nearer_back, back).otherwise(ahead)),
        }
    spare = [f"{f.out}_{side}" for f in fields for side in ("before", "after")] + [f"__s{i}_{f.out}" for f in fields for i in range(len(fallbacks))]
    return work.withColumns(results).drop(*spare)


def fill_hours(frame: DataFrame, carry_days: int = 30) -> DataFrame:
    """Park hours (with instants) with opening_time, closing_time and source filled.

    Times are interpolated as minutes after the local midnight of park_date per
    park and version_type, so a fill means the same on every date, and come out
    as ``{field}_minute``, rounded to whole minutes.  ``source`` is carried as
    lower-case text in ``source_filled``.
    """
    midnight = F.unix_date(F.col("park_day")) * F.lit(86_400_000_000).cast("bigint")
    work = frame.withColumns({"kind": F.lower(F.trim("version_type")), "weekday": F.weekday("park_day")})
    for field in ("opening", "closing"):
        wall = F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(f"{field}_us"), F.col("zone")))
        work = work.withColumn(f"__{field}", ((wall - midnight) / F.lit(60_000_000)).cast("double"))
    work = cut(work.withColumn("__source", F.when(~is_filler(F.col("source")), F.lower(F.trim("source")))))
    fields = [Field("__opening", "opening_minute", True), Field("__closing", "closing_minute", True), Field("__source", "source_filled", False)]
    order = [F.col("park_day"), F.col("created_at"), F.col("hours_id")]
    filled = fill_in_time(work, ["park", "kind"], "park_day", order, fields, carry_days=carry_days, fallbacks=(["park", "weekday"], ["kind"], ["park"]))
    return filled.withColumns({f"{f}_minute": F.bround(F.col(f"{f}_minute"), 0) for f in ("opening", "closing")}).drop("__opening", "__closing", "__source")
