"""Weighted aggregates, and lookups that fall back to coarser groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from queuescope.operators.ordered import null_safe_join
from queuescope.session import cut


def _half(weight: str, up: WindowSpec, whole: WindowSpec) -> Column:
    """Whether the cumulative weight has reached half of the total."""
    total = F.sum(weight).over(whole)
    return F.sum(weight).over(up) >= total / 2 - 1e-12 * total


def weighted_median(frame: DataFrame, keys: Sequence[str], value: str, weight: str, out: str = "weighted_median") -> DataFrame:
    """The lower weighted median: the first value at which the cumulative weight reaches half.

    Weights of equal values are summed first, with partial aggregation, so the
    ordered step sees one row per distinct value.  Null values, null weights
    and weights that are not positive count for nothing.
    """
    rows = frame.where(F.col(value).isNotNull() & (F.col(weight) > 0))
    per_value = rows.groupBy(*keys, value).agg(F.sum(weight).alias("__w"))
    whole = Window.partitionBy(*keys)
    up = whole.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return per_value.withColumn("__h", _half("__w", up, whole)).groupBy(*keys).agg(F.min(F.when(F.col("__h"), F.col(value))).alias(out))


def posted_aggregates(facts: DataFrame, keys: Sequence[str] = ("entity_code", "dategroupid", "hour"), value: str = "wait_time_minutes", weight: str = "weight") -> DataFrame:
    """Weighted and plain statistics per group; rows with a null key are left out.

    Rows are first reduced to one per group and distinct value; everything,
    medians included, comes from that table with one further shuffle.  Rows
    without a value count for the mean weight and the dates only.
    """
    per_value = facts.dropna(subset=list(keys)).groupBy(*keys, value).agg(
        F.sum(F.when(F.col(value).isNotNull() & (F.col(weight) > 0), F.col(weight))).alias("__w"),
        F.count(value).alias("__n"),
        F.sum(weight).alias("__all_w"),
        F.count(weight).alias("__all_n"),
        F.min("park_date").alias("__first"),
        F.max("park_date").alias("__last"),
    )
    whole = Window.partitionBy(*keys)
    up = whole.orderBy(F.col(value).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    v, n = F.col(value), F.col("__n")
    return per_value.withColumn("__h", _half("__w", up, whole)).groupBy(*keys).agg(
        F.min(F.when(F.col("__h"), v)).alias("posted_median"),
        (F.sum(v * F.col("__w")) / F.nullif(F.sum("__w"), F.lit(0.0))).alias("posted_mean"),
        F.percentile(v, F.lit(0.5), n).alias("posted_median_unweighted"),
        (F.sum(v * n) / F.nullif(F.sum(n), F.lit(0))).alias("posted_mean_unweighted"),
        F.sum(n).alias("posted_count"),
        (F.sum("__all_w") / F.nullif(F.sum("__all_n"), F.lit(0))).alias("avg_recency_weight"),
        F.min("__first").alias("min_park_date"),
        F.max("__last").alias("max_park_date"),
    )


#: Levels of the fallback, finest first; each takes the median of the aggregates below it.
LEVELS = (("entity_code", "dategroupid", "hour"), ("entity_code", "dategroupid"), ("entity_code", "hour"), ("entity_code",), ("prefix", "hour"))


def fallback_lookup(wanted: DataFrame, aggregates: DataFrame, value: str = "posted_median", prefix_length: int = 2) -> DataFrame:
    """Adds ``predicted`` and ``level`` (1 to 5, null if nothing fits) to rows of entity_code, dategroupid, hour.

    ``aggregates`` is the table of finest groups; every coarser level is aggregated
    from it and joined by its own keys.  Rows with null keys fall through to the
    levels that do not use them.  The tables of entities grow with the readings and pack
    well in files, so they are merged, not broadcast by the size of the files.
    """
    base = cut(aggregates.select("entity_code", "dategroupid", "hour", value, F.substring("entity_code", 1, prefix_length).alias("prefix")))
    # the levels are joined to the different keys only; the wanted rows themselves are joined once
    asked = wanted.select("entity_code", "dategroupid", "hour").distinct().withColumn("prefix", F.substring("entity_code", 1, prefix_length))
    for i, keys in enumerate(LEVELS, 1):
        level = base.groupBy(*keys).agg(F.median(value).alias(f"__v{i}"))
        asked = asked.join(level.hint("merge") if "entity_code" in keys else level, list(keys), "left")
    values = [F.col(f"__v{i}") for i in range(1, len(LEVELS) + 1)]
    chosen = F
    for i, v in enumerate(values, 1):
        chosen = chosen.when(v.isNotNull(), i)
    found = asked.select("entity_code", "dategroupid", "hour", F.coalesce(*values).alias("predicted"), chosen.alias("level"))
    return null_safe_join(wanted, found.hint("merge"), ["entity_code", "dategroupid", "hour"])


def exact_medians(frame: DataFrame, keys: Sequence[str], value: str, out: str = "median", accuracy: int = 10_000) -> DataFrame:
    """keys and the exact median of a continuous value per group; null and NaN are no values, null keys are a key.

    A sketch of bounded size brackets the median's rank first; values below the
    bracket are only counted, and the exact answer is read from the few values inside.
    So no task holds a group's values, as an exact percentile would.  Every row has a bracket,
    but they are joined as a left join that stays one, so that Catalyst can send the brackets to
    the rows, never the rows by way of the driver.
    """
    rows = frame.select(*keys, F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    slack = 2.0 / accuracy
    bracket = F.percentile_approx("__v", F.array(F.lit(0.5 - slack), F.lit(0.5 + slack)), accuracy)
    brackets = rows.groupBy(*keys).agg(bracket.alias("__b"), F.count(F.lit(1)).alias("__n")).select(*keys, F.col("__b")[0].alias("__low"), F.col("__b")[1].alias("__high"), "__n")
    placed = null_safe_join(rows, brackets, keys) if keys else rows.withColumn("__b", brackets.select(F.struct("__low", "__high", "__n")).scalar()).select("__v", "__b.*")
    below = F.when(F.col("__v") < F.col("__low"), F.lit(None).cast("double")).otherwise(F.col("__v"))
    # a plain comparison rejects nulls, which would turn the left join into an inner one
    counted = placed.where(F.col("__v") <= F.coalesce("__high", F.lit(float("inf")))).groupBy(*keys, "__n", below.alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    up = Window.partitionBy(*keys).orderBy(F.col("__v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    reached = counted.withColumn("__to", F.sum("__c").over(up))
    first, second = F.floor((F.col("__n") - 1) / 2) + 1, F.floor(F.col("__n") / 2) + 1
    at = [F.min(F.when(F.col("__to") >= place, F.col("__v"))) for place in (first, second)]
    return reached.groupBy(*keys).agg(((at[0] + at[1]) / 2).alias(out))
