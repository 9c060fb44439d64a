"""Ordered computations over groups of any size.

A plain window sorts a whole group in one task.  These operators split every
group into blocks that follow the order, run the window inside the blocks, and
carry the state over with a second window over one summary row per block.  So
the work on one hot group spreads over as many tasks as it has blocks, and what
a second-level task sees is the number of blocks, not of rows.

``block`` must be a column that never falls along the order (a day, a month, a
range of numbers); nulls are a block of their own and come first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which null keys match; the right side's keys are dropped."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = None
    for k in keys:
        same = left[k].eqNullSafe(renamed[f"__r_{k}"])
        on = same if on is None else on & same
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


def _blocked(frame: DataFrame, block: Column) -> DataFrame:
    return frame.withColumn("__block", block)


def with_running(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    block: Column,
    value: Column,
    out: str,
    how: str = "sum",
) -> DataFrame:
    """Adds the running ``sum`` or ``max`` of a value in a group's order, the row included.

    Ties in the order are in no defined sequence unless ``order`` ends with a
    unique column.  Nulls add nothing; a running max before any value is null,
    a running sum 0.
    """
    agg: Callable[[Column], Column] = {"sum": F.sum, "max": F.max}[how]
    inner = Window.partitionBy(*keys, "__block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    work = _blocked(frame, block).withColumn("__v", F.coalesce(value, F.lit(0)) if how == "sum" else value)
    totals = work.groupBy(*keys, "__block").agg(agg("__v").alias("__total"))
    outer = Window.partitionBy(*keys).orderBy(F.col("__block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, "__block", agg("__total").over(outer).alias("__carried"))
    local = agg("__v").over(inner)
    joined = null_safe_join(work, carried, [*keys, "__block"])
    if how == "sum":
        result = local + F.coalesce(F.col("__carried"), F.lit(0))
    else:
        result = F.greatest(local, F.col("__carried"))
    return joined.withColumn(out, result).drop("__block", "__v", "__carried")


def with_ordinal(frame: DataFrame, keys: Sequence[str], order: Sequence[Column], block: Column, out: str = "ordinal") -> DataFrame:
    """Adds each row's number (from 1) in its group's order."""
    return with_running(frame, keys, order, block, F.lit(1).cast("bigint"), out, "sum")


def with_neighbours(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    block: Column,
    values: dict[str, Column],
) -> DataFrame:
    """Adds, per named value, ``{name}_before`` and ``{name}_after``.

    They are the last non-null value strictly before and the first strictly
    after each row.  All values share one pass.  ``order`` must end with a
    unique column for a defined result among ties.
    """
    held = {n: f"__v_{n}" for n in values}
    inner = Window.partitionBy(*keys, "__block").orderBy(*order)
    work = _blocked(frame, block).withColumns({held[n]: v for n, v in values.items()})
    numbered = work.withColumn("__i", F.row_number().over(inner))
    ends = numbered.groupBy(*keys, "__block").agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), F.col("__i"))).alias(f"__last_{n}") for n, v in held.items()],
        *[F.min_by(v, F.when(F.col(v).isNotNull(), F.col("__i"))).alias(f"__first_{n}") for n, v in held.items()],
    )
    outer = Window.partitionBy(*keys).orderBy(F.col("__block").asc_nulls_first())
    left = outer.rowsBetween(Window.unboundedPreceding, -1)
    # what follows a row is what precedes it in the reverse order: no frame is held in memory
    right = Window.partitionBy(*keys).orderBy(F.col("__block").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *keys,
        "__block",
        *[F.last(f"__last_{n}", ignorenulls=True).over(left).alias(f"__left_{n}") for n in values],
        *[F.last(f"__first_{n}", ignorenulls=True).over(right).alias(f"__right_{n}") for n in values],
    )
    up = inner.rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*keys, "__block").orderBy(F.col("__i").desc()).rowsBetween(Window.unboundedPreceding, -1)
    local = numbered.withColumns({f"{n}_before": F.last(v, ignorenulls=True).over(up) for n, v in held.items()})
    local = local.withColumns({f"{n}_after": F.last(v, ignorenulls=True).over(down) for n, v in held.items()})
    joined = null_safe_join(local, carried, [*keys, "__block"])
    both = {f"{n}_before": F.coalesce(F.col(f"{n}_before"), F.col(f"__left_{n}")) for n in values}
    both |= {f"{n}_after": F.coalesce(F.col(f"{n}_after"), F.col(f"__right_{n}")) for n in values}
    return joined.withColumns(both).drop("__block", "__i", *held.values(), *[f"__{side}_{n}" for side in ("left", "right") for n in values])
