"""Histories of changing attributes from snapshots or appended versions.

Method: every key has a numbered sequence of snapshots; each snapshot is
compared with the one before by a null-safe full outer join on key and number.
A key without predecessor is ``inserted``, one that differs is ``changed``, one
that is missing where it was present before is ``deleted``, one that is equal is no event.
The change events are united, and each one's validity ends where the next event of the key begins;
a deletion ends a version and begins none.

:func:`snapshot_history` takes periodic snapshots of a whole table, numbered by
time.  :func:`change_history` takes appended rows: each is a snapshot of its own
key, the number is its place in the key's order, and a key's end is no deletion.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queuescope.operators.ordered import null_safe_join, with_ordinal
from queuescope.session import cut


def _events(numbered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change events of snapshots (keys, __n, __id, __at, __new): keys, __n, change, __id, __at, __new; of a deletion only keys and __n."""
    before = numbered.select(*[F.col(k).alias(f"__b_{k}") for k in keys], (F.col("__n") + 1).alias("__b_n"), F.col("__new").alias("__old"), F.lit(True).alias("__had"))
    on = F.col("__n").eqNullSafe(F.col("__b_n"))
    for k in keys:
        on &= numbered[k].eqNullSafe(before[f"__b_{k}"])
    compared = numbered.withColumn("__has", F.lit(True)).join(before, on, "full_outer")
    change = F.when(F.col("__had").isNull(), "inserted").when(F.col("__has").isNull(), "deleted").when(~F.col("__new").eqNullSafe(F.col("__old")), "changed")
    own = {k: F.when(F.col("__has").isNull(), F.col(f"__b_{k}")).otherwise(F.col(k)) for k in keys}
    return compared.select(*[own[k].alias(k) for k in keys], F.coalesce("__n", "__b_n").alias("__n"), change.alias("change"), "__id", "__at", "__new").where(F.col("change").isNotNull())


def _closed(events: DataFrame, keys: Sequence[str], row_id: str, attributes: Sequence[str], lead_block: int) -> DataFrame:
    """Versions of change events in order of __n, each with the next event's row and time."""
    events = cut(with_ordinal(events, keys, [F.col("__n")], F.floor(F.col("__n") / lead_block), "__k_no"))
    # lead inside blocks of events; a block's last one takes the first of the next block
    blocked = events.withColumn("__k", F.floor((F.col("__k_no") - 1) / lead_block))
    ahead = Window.partitionBy(*keys, "__k").orderBy("__k_no")
    led = blocked.withColumns({"__next_id": F.lead("__id").over(ahead), "__next_at": F.lead("__at").over(ahead)})
    firsts = blocked.where((F.col("__k_no") - 1) % lead_block == 0).select(*keys, (F.col("__k") - 1).alias("__k"), F.col("__id").alias("__f_id"), F.col("__at").alias("__f_at"))
    joined = null_safe_join(led, firsts.where(F.col("__k") >= 0), [*keys, "__k"])
    return joined.where(F.col("change") != "deleted").select(
        *keys,
        F.col("__k_no").alias("version_no"),
        "change",
        F.col("__id").alias(row_id),
        F.col("__at").alias("valid_from"),
        F.coalesce("__next_at", "__f_at").alias("valid_until"),
        F.coalesce("__next_id", "__f_id").alias("closed_by"),
        *[F.col(f"__new.{a}").alias(a) for a in attributes],
    )


def change_history(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Column,
    attributes: Sequence[str],
    row_id: str,
    starts: str,
    lead_block: int = 10_000,
) -> DataFrame:
    """One row per true version of a key, gapless, from appended rows.

    Columns: keys, ``version_no``, ``change`` (inserted or changed), ``row_id``,
    ``valid_from`` (= ``starts`` of the row that begins it), ``valid_until``
    (start of the next, null if open), ``closed_by`` (row that begins the next,
    null if open) and the attributes.  Null keys are keys, null attributes are
    values.  ``order`` names columns, the last of them unique; ``block`` never falls along it.
    """
    rows = frame.select(*[c for c in dict.fromkeys([*keys, *attributes, row_id, starts, *order])], block.alias("__in"))
    numbered = cut(with_ordinal(rows, keys, [F.col(c) for c in order], F.col("__in"), "__n").select(*keys, "__n", F.col(row_id).alias("__id"), F.col(starts).alias("__at"), F.struct(*attributes).alias("__new")))
    # the end of a key's rows says nothing about its existence
    return _closed(_events(numbered, keys).where(F.col("change") != "deleted"), keys, row_id, attributes, lead_block)


def snapshot_history(snapshots: DataFrame, keys: Sequence[str], taken: str, attributes: Sequence[str], lead_block: int = 10_000) -> DataFrame:
    """One row per version of a key, from full snapshots of a table taken at the times in ``taken``.

    Columns: keys, ``version_no`` (deletions are counted too), ``change``, ``valid_from`` (snapshot that shows it
    first), ``valid_until`` (snapshot that shows something else or nothing, null if open) and
    the attributes.  A key that is missing from a snapshot was deleted; if it comes back it
    is inserted anew.  Of rows that repeat a key in one snapshot the least counts; rows
    without a time are left out.  Null keys are keys, null attributes are values.
    """
    rows = snapshots.where(F.col(taken).isNotNull())
    kept = rows.groupBy(*keys, F.col(taken).alias("__at")).agg(F.min(F.struct(*attributes)).alias("__new"))
    times = rows.select(F.col(taken).alias("__at")).distinct()
    # one row for each snapshot
    numbers = cut(times.withColumn("__n", F.row_number().over(Window.orderBy("__at")).cast("bigint")))
    numbered = cut(kept.join(numbers, "__at").select(*keys, "__n", F.lit(None).cast("bigint").alias("__id"), "__at", "__new"))
    events = _events(numbered, keys).drop("__at").join(numbers, "__n")  # beyond the last snapshot nothing is known
    return _closed(events, keys, "__row", attributes, lead_block).drop("__row", "closed_by")


def hours_history(hours: DataFrame) -> DataFrame:
    """The gapless history of park hours per park, park_date and version_type.

    Input: usable hours with instants.  Two rows are one version when both
    instants and both flags agree (null flags are false).  Stated ends are not
    relied upon.
    """
    flags = {f: F.coalesce(F.col(f), F.lit(False)) for f in ("emh_morning", "emh_evening")}
    rows = hours.withColumns(flags).withColumn("version_type", F.lower(F.trim("version_type"))).withColumn("__month", F.trunc(F.col("valid_from"), "month"))
    order = ["valid_from", "created_at", "hours_id"]
    return change_history(
        rows, ["park", "park_date", "version_type"], order, F.col("__month"),
        ["opening_us", "closing_us", "emh_morning", "emh_evening"], "hours_id", "valid_from",
    )
