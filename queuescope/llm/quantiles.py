"""Percentiles of very large numeric columns by mergeable randomized compactors.

The sketch is the KLL compactor hierarchy that Spark carries: each level keeps a
sorted buffer, a full buffer passes every other value (odd or even by a coin)
to the level above at double weight, and two sketches are merged level by level.  Partial sketches are
built before the shuffle, so a hot group sends one sketch per task, however
many rows it has.

With ``k`` items in the top buffer the rank of an answer is within
``rank_error(k)`` of the asked rank (as a share of n) with 99 % confidence, that
is for 99 of 100 answers; up to about ``k`` values the answers are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items of the top compactor; the bound is 0.383 % of n.
DEFAULT_K = 1200

# Coefficient and exponent of the published error fit for single ranks at 99 % confidence.
_COEFFICIENT, _EXPONENT = 2.296, 0.9021


def rank_error(k: int) -> float:
    """The bound on an answer's rank, as a share of n, at 99 % confidence."""
    return _COEFFICIENT / k**_EXPONENT


def sketches(frame: DataFrame, keys: Sequence[str], value: str, k: int = DEFAULT_K) -> DataFrame:
    """One sketch per group: keys, ``sketch``, ``n`` values.

    Null and NaN are no values; a group without values has no row.  Null keys
    are a group.
    """
    real = F.col(value).cast("double")
    rows = frame.where(real.isNotNull() & ~F.isnan(real))
    return rows.groupBy(*keys).agg(F.kll_sketch_agg_double(real, k).alias("sketch"), F.count(F.lit(1)).alias("n"))


def merge(frame: DataFrame, keys: Sequence[str], k: int = DEFAULT_K) -> DataFrame:
    """Sketches of finer groups (partitions, days, builds) combined into those of ``keys``."""
    return frame.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n"))


def percentiles(frame: DataFrame, ranks: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95), k: int = DEFAULT_K) -> DataFrame:
    """Adds ``pNN`` per rank, the bound ``rank_error``, and ``median_low``/``median_high`` at the bound's edges."""
    error = rank_error(k)
    # all answers of a sketch are read in one call: it is decoded once
    asked = [*ranks, max(0.0, 0.5 - error), min(1.0, 0.5 + error)]
    read = frame.withColumn("__q", F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(r)) for r in asked])))
    named = {f"p{round(r * 100):02d}": F.col("__q")[i] for i, r in enumerate(ranks)}
    return read.withColumns(named | {
        "rank_error": F.lit(error),
        "median_low": F.col("__q")[len(ranks)],
        "median_high": F.col("__q")[len(ranks) + 1],
    }).drop("__q", "sketch")
