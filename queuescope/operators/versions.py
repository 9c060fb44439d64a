"""Versioned park hours: resolution as of a moment, appended versions, donors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuescope.functions.temporal import recency_weight

# Rank of each kind of version; others are last.
VERSION_RANK = {"official": 1, "final": 2, "predicted": 3, "historical": 4}


def version_rank(kind: Column) -> Column:
    """1 for the kind of version that wins, 99 for unknown ones."""
    rank = F
    for name, value in VERSION_RANK.items():
        rank = rank.when(kind == name, value)
    return rank.otherwise(99)


def as_of(wanted: DataFrame, versions: DataFrame, keys: Sequence[str], as_of_us: str) -> DataFrame:
    """Wanted rows (keys, moment) with the version valid then: best kind, then latest created, then highest id.

    ``versions``: keys, version_id, version_type, valid_from_us, valid_until_us
    (null = open), created_us and payload.  Keys without a valid version keep
    nulls.  The best version is an aggregate, so no row is ranked or sorted.
    """
    payload = [c for c in versions.columns if c not in keys]
    distinct = wanted.select(*keys, as_of_us).distinct()
    valid = distinct.join(versions, list(keys)).where((F.col("valid_from_us") <= F.col(as_of_us)) & (F.col("valid_until_us").isNull() | (F.col("valid_until_us") > F.col(as_of_us))))
    rank = F.struct(version_rank(F.col("version_type")).alias("r"), (-F.col("created_us")).alias("c"), (-F.col("version_id")).alias("i"))
    best = valid.groupBy(*keys, as_of_us).agg(F.min_by(F.struct(*payload), rank).alias("__v"))
    return wanted.join(best, [*keys, as_of_us], "left").select(*wanted.columns, *[F.col(f"__v.{c}").alias(c) for c in payload])


def append_versions(state: DataFrame, incoming: DataFrame, keys: Sequence[str], attributes: Sequence[str], now_us: int) -> DataFrame:
    """The table after a sync: changed keys get their open version closed and a new one appended.

    ``state``: keys, attributes, valid_from_us, valid_until_us; ``incoming``: keys, attributes,
    one row per key.  Unchanged keys stay as they are; keys that are missing from
    the sync stay open.
    """
    fresh = incoming.select(*keys, F.struct(*attributes).alias("__new"))
    joined = state.withColumn("__open", F.col("valid_until_us").isNull()).join(fresh, list(keys), "left")
    changed = F.col("__open") & F.col("__new").isNotNull() & ~F.struct(*attributes).eqNullSafe(F.col("__new"))
    closed = joined.withColumn("valid_until_us", F.when(changed, F.lit(now_us)).otherwise(F.col("valid_until_us"))).select(*state.columns)
    same = state.where(F.col("valid_until_us").isNull()).select(*keys, F.struct(*attributes).alias("__old"))
    added = fresh.join(same, list(keys), "left").where(F.col("__old").isNull() | ~F.col("__old").eqNullSafe(F.col("__new")))
    opened = added.select(*keys, *[F.col(f"__new.{a}").alias(a) for a in attributes], F.lit(now_us).cast("bigint").alias("valid_from_us"), F.lit(None).cast("bigint").alias("valid_until_us"))
    return closed.unionByName(opened.select(*state.columns))


def missing_keys(dates: DataFrame, parks: DataFrame, present: DataFrame, keys: Sequence[str] = ("park_date", "park_code")) -> DataFrame:
    """Dates of every park that has no row in ``present``.

    The distinct parks (a fixed property of the domain) are one array, read by a
    scalar subquery and exploded per date, so no cross join is planned.
    """
    listed = parks.agg(F.sort_array(F.collect_set("park_code")).alias("__parks"))
    grid = dates.withColumn("__parks", listed.scalar()).select("park_date", F.explode("__parks").alias("park_code"))
    return grid.join(present, list(keys), "left_anti")


def change_probability(days_ahead: Column) -> Column:
    """Chance that published hours change, by how far ahead the date is."""
    return F.when(days_ahead <= 7, 0.05).when(days_ahead <= 30, 0.20).when(days_ahead <= 90, 0.40).otherwise(0.60)


def donor_confidence(same_group: Column, days: Column) -> Column:
    """1.0 for a donor of the date's group, 0.7 for another; times the recency weight."""
    return F.when(same_group, 1.0).otherwise(0.7) * recency_weight(days)


def best_donor(targets: DataFrame, donors: DataFrame) -> DataFrame:
    """Targets (park_code, park_date, date_group_id) with the past date that lends its hours.

    Per target only two donors can win: the latest of its own group and the
    latest of all, because confidence falls with age in either class.  Both
    come from running maxima over targets and donors together; no pairs are made.
    """
    from queuescope.operators.ordered import with_running

    marked = targets.select("park_code", "park_date", "date_group_id", F.lit(1).alias("__target"), F.lit(None).cast("date").alias("__d"))
    given = donors.select("park_code", "park_date", "date_group_id", F.lit(0).alias("__target"), F.col("park_date").alias("__d"))
    both = marked.unionByName(given)
    # targets before donors of the same date: a donor must be in the past
    order, block = [F.col("park_date"), F.col("__target").desc()], F.trunc(F.col("park_date"), "year")
    seen = with_running(both, ["park_code"], order, block, F.col("__d"), "__any", "max")
    seen = with_running(seen, ["park_code", "date_group_id"], order, block, F.col("__d"), "__same", "max")
    wanted = seen.where(F.col("__target") == 1)
    any_score = donor_confidence(F.lit(False), F.datediff("park_date", "__any"))
    same_score = donor_confidence(F.lit(True), F.datediff("park_date", "__same"))
    takes_same = F.col("__same").isNotNull() & (same_score >= any_score)
    return wanted.select(
        "park_code", "park_date", "date_group_id",
        F.when(takes_same, F.col("__same")).otherwise(F.col("__any")).alias("donor_date"),
        F.when(takes_same, same_score).otherwise(any_score).alias("confidence"),
    )
