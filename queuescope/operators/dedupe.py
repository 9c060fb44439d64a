"""Keys kept once, state tables merged, and the per-entity index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_best(frame: DataFrame, keys: Sequence[str], rank: Column, last: bool = False) -> DataFrame:
    """One row per key: that of the lowest rank, or of the highest with ``last``.

    ``rank`` should be unique within a key.  An aggregate of whole rows, so
    partial results shrink the shuffle; null keys are a key.
    """
    rest = [c for c in frame.columns if c not in keys]
    row = F.struct(*rest)
    best = F.max_by(row, rank) if last else F.min_by(row, rank)
    return frame.groupBy(*keys).agg(best.alias("__row")).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*frame.columns)


def new_rows(batch: DataFrame, known: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """Rows of a batch whose key is not known, the first per key.  Null keys are never known."""
    return keep_best(batch, keys, order).join(known.select(*keys).distinct(), list(keys), "left_anti")


def entity_index(facts: DataFrame) -> DataFrame:
    """Latest date and instant and the counts per type of each entity.

    Input: entity_code, park_date, observed_us, wait_time_type.  One pass with
    partial aggregation, hot entities included.
    """
    counts = {f"{k.lower()}_count": F.count_if(F.col("wait_time_type") == k).alias(f"{k.lower()}_count") for k in ("ACTUAL", "POSTED", "PRIORITY")}
    return facts.groupBy("entity_code").agg(
        F.max("park_date").alias("latest_park_date"),
        F.max("observed_us").alias("latest_observed_us"),
        F.min("observed_us").alias("first_seen_us"),
        F.count(F.lit(1)).alias("row_count"),
        *counts.values(),
    )


def upsert_index(state: DataFrame, delta: DataFrame) -> DataFrame:
    """The index after a batch: latest values are the greater ones, counts add up.

    Late batches count too; instants are compared, not texts.
    """
    maxima, minima = ("latest_park_date", "latest_observed_us"), ("first_seen_us",)
    sums = ("row_count", "actual_count", "posted_count", "priority_count")
    merged = state.unionByName(delta)
    return merged.groupBy("entity_code").agg(*[F.max(c).alias(c) for c in maxima], *[F.min(c).alias(c) for c in minima], *[F.sum(c).alias(c) for c in sums])


def needs_modeling(index: DataFrame, modeled: DataFrame, *, min_age_us: int = 0, as_of_us: int | None = None, min_actual: int = 0, min_priority: int = 0) -> DataFrame:
    """Entities that have data newer than their last model (``modeled``: entity_code, last_modeled_us)."""
    joined = index.join(modeled, "entity_code", "left")
    stale = F.col("last_modeled_us").isNull() | (F.col("latest_observed_us") > F.col("last_modeled_us"))
    if as_of_us is not None:
        stale &= F.col("latest_observed_us") <= as_of_us - min_age_us
    if min_actual or min_priority:
        stale &= (F.col("actual_count") >= min_actual if min_actual else F.lit(False)) | (F.col("priority_count") >= min_priority if min_priority else F.lit(False))
    return joined.where(stale)


def mark_modeled(modeled: DataFrame, done: DataFrame, at_us: int) -> DataFrame:
    """The table of last models (entity_code, last_modeled_us) after the entities in ``done`` were modelled at a time; an older mark never replaces a newer one."""
    marks = done.select("entity_code").distinct().withColumn("last_modeled_us", F.lit(at_us).cast("bigint"))
    return modeled.select("entity_code", "last_modeled_us").unionByName(marks).groupBy("entity_code").agg(F.max("last_modeled_us").alias("last_modeled_us"))


def latest_first(index: DataFrame) -> DataFrame:
    """The index in order of its entities' latest reading, newest first."""
    return index.orderBy(F.col("latest_observed_us").desc_nulls_last(), "entity_code")


def with_index(entities: DataFrame, index: DataFrame) -> DataFrame:
    """The entity list with each one's counts and latest reading; entities without readings have zero counts."""
    counts = ("row_count", "actual_count", "posted_count", "priority_count")
    joined = entities.join(index, "entity_code", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts})


def sample(frame: DataFrame, key: str, size: int) -> DataFrame:
    """A repeatable sample: the ``size`` rows of lowest key hash."""
    return frame.orderBy(F.xxhash64(key), key).limit(size)
