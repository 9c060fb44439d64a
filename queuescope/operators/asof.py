"""Nearest-in-time joins, without comparing pairs.

Left and right rows are united in one order of time; each left row then takes
the nearest right row on either side.  Groups are cut into blocks of time, so a
hot key spreads over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuescope.operators.ordered import with_neighbours


def beside(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, left_id: str, value: str, order: str, block_us: int = 3_600_000_000) -> DataFrame:
    """Left rows (keys, at, id) with ``before`` and ``after``: structs (at, order, value) of the right rows around.

    A right row at the same time is ``before``; of several at one time the lowest ``order`` counts.
    """
    points = right.groupBy(*keys, at).agg(F.min_by(F.struct(F.col(at).alias("at"), F.col(order).alias("order"), F.col(value).alias("value")), order).alias("point"))
    marks = left.select(*keys, at, left_id).withColumn("point", F.lit(None).cast(points.schema["point"].dataType))
    both = marks.unionByName(points.withColumn(left_id, F.lit(None).cast(left.schema[left_id].dataType)))
    order_by = [F.col(at), F.col("point").isNull().cast("int"), F.col(left_id)]
    seen = with_neighbours(both, keys, order_by, F.floor(F.col(at) / F.lit(block_us)), {"p": F.col("point")})
    return seen.where(F.col("point").isNull()).select(*keys, at, left_id, F.col("p_before").alias("before"), F.col("p_after").alias("after"))


def nearest(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, left_id: str, value: str, order: str, tolerance_us: int | None = None) -> DataFrame:
    """Left id, the nearest right value and its distance; a tie goes to the lower ``order``.

    Left rows without a right row (within the tolerance) keep nulls.
    """
    around = beside(left, right, keys, at, left_id, value, order)
    back, ahead = F.col(at) - F.col("before.at"), F.col("after.at") - F.col(at)
    first = F.col("after").isNull() | (back < ahead) | ((back == ahead) & (F.col("before.order") < F.col("after.order")))
    pick = F.when(F.col("before").isNotNull() & first, F.col("before")).otherwise(F.col("after"))
    chosen = around.withColumn("__p", pick).withColumn("distance_us", F.abs(F.col("__p.at") - F.col(at)))
    if tolerance_us is not None:
        chosen = chosen.withColumn("__p", F.when(F.col("distance_us") <= tolerance_us, F.col("__p"))).withColumn("distance_us", F.when(F.col("__p").isNotNull(), F.col("distance_us")))
    return chosen.select(*keys, at, left_id, F.col("__p.value").alias(value), "distance_us")


def forward_preferred(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, left_id: str, value: str, order: str, ahead_us: int, back_us: int) -> DataFrame:
    """Left id and the right value at or after it within ``ahead_us``; only if none comes later at all, the one before within ``back_us``."""
    around = beside(left, right, keys, at, left_id, value, order)
    same = F.col("before.at") == F.col(at)
    later: Column = F.when(F.coalesce(same, F.lit(False)), F.col("before")).otherwise(F.col("after"))
    found = around.withColumn("__l", later)
    forward = F.when(F.col("__l.at") - F.col(at) <= ahead_us, F.col("__l.value"))
    backward = F.when(F.col(at) - F.col("before.at") <= back_us, F.col("before.value"))
    return found.select(*keys, at, left_id, F.when(F.col("__l").isNotNull(), forward).otherwise(backward).alias(value))
