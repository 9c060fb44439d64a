"""Attributes as they were known at each event's time.

Method: every entity's attribute rows are reduced to the moments at which the
best known row changes, and numbered by the cumulative count of changes.
Events get their number from the same cumulative count over narrow rows
(key, time, flag) of changes and events together; the wide attributes are then
fetched by an equi-join on key and number.  A row counts from the moment at
which it is both valid and known, so nothing that became known later is used.

Scale: a key's events are dealt over as many slices as its count asks for
(``slice_rows``), and only the few change rows are repeated in each slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queuescope.constants import VERSION_ORDER
from queuescope.functions.codes import park_date_of, zone_of_park
from queuescope.operators.ordered import with_running
from queuescope.session import cut


def version_changes(attributes: DataFrame, keys: Sequence[str], known_us: Column, rank: Column, row_id: str, block_us: int = 86_400_000_000) -> DataFrame:
    """The moments at which a key's best known row changes: keys, at_us, version_no, row_id.

    ``rank`` is a struct column whose last field is unique; the greatest wins.
    Rows with a null key or an unknown moment are never known and left out.
    """
    rows = attributes.select(*keys, known_us.alias("at_us"), rank.alias("__rank"), row_id).where(F.col("at_us").isNotNull()).dropna(subset=list(keys))
    order = [F.col("at_us"), F.col("__rank").asc()]
    best = with_running(rows, keys, order, F.floor(F.col("at_us") / F.lit(block_us)), F.col("__rank"), "__best", "max")
    changes = best.where(F.col("__best") == F.col("__rank")).select(*keys, "at_us", row_id, "__rank")
    numbered = with_running(changes, keys, order[:2], F.floor(F.col("at_us") / F.lit(block_us)), F.lit(1).cast("bigint"), "version_no")
    return numbered.drop("__rank")


def as_known(
    events: DataFrame,
    keys: Sequence[str],
    event_us: str,
    event_id: str,
    changes: DataFrame,
    slice_rows: int = 200_000,
) -> DataFrame:
    """event_id, keys and version_no of each event that had a known version; ``changes`` from :func:`version_changes`.

    A change at the event's very moment counts as known.  Events with a null
    key or time have no version.
    """
    narrow = events.select(*keys, F.col(event_us).alias("at_us"), event_id).where(F.col("at_us").isNotNull()).dropna(subset=list(keys))
    # only keys above the slice size are dealt out, so this table has a row for at most every slice_rows events
    hot = cut(narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > slice_rows).select(*keys, F.ceil(F.col("__n") / slice_rows).cast("int").alias("__slices")))
    slices = F.coalesce("__slices", F.lit(1))
    repeated = changes.join(hot, list(keys), "left").select(*keys, F.explode(F.sequence(F.lit(0), slices - 1)).alias("__slice"), "at_us", F.lit(None).cast(narrow.schema[event_id].dataType).alias(event_id), F.lit(1).alias("__change"))
    dealt = narrow.join(hot, list(keys), "left").select(*keys, F.pmod(F.xxhash64(event_id), slices).cast("int").alias("__slice"), "at_us", event_id, F.lit(0).alias("__change"))
    together = Window.partitionBy(*keys, "__slice").orderBy("at_us", F.col("__change").desc()).rowsBetween(Window.unboundedPreceding, 0)
    numbered = repeated.unionByName(dealt).withColumn("version_no", F.sum("__change").over(together).cast("bigint"))
    return numbered.where((F.col("__change") == 0) & (F.col("version_no") > 0)).select(event_id, *keys, "version_no")


def hours_as_known(readings: DataFrame, hours: DataFrame) -> DataFrame:
    """ingest_seq, park, park_date and the usable hours row valid and known at each reading's instant.

    Of the rows whose valid_from and created_at have both passed, the first
    version_type in the fixed order wins, in it the latest valid_from, then the
    latest created_at, then the lowest hours_id.  Readings without such a row
    do not appear.  ``park_day`` is the readings' operational date; it is
    computed where it is absent.
    """
    kind = F.lower(F.trim("version_type"))
    priority = F.when(kind == VERSION_ORDER[0], 0)
    for i, name in enumerate(VERSION_ORDER[1:], 1):
        priority = priority.when(kind == name, -i)
    known = F.when(F.col("valid_from").isNotNull() & F.col("created_at").isNotNull() & priority.isNotNull(), F.unix_micros(F.greatest("valid_from", "created_at")))
    rank = F.struct(priority.alias("p"), F.unix_micros("valid_from").alias("v"), F.unix_micros("created_at").alias("c"), (-F.col("hours_id")).alias("i"))
    keys = ["park", "park_day"]
    changes = cut(version_changes(hours, keys, known, rank, "hours_id"))
    park = F.upper("park")
    if "park_day" not in readings.columns:
        readings = readings.withColumn("park_day", park_date_of(F.col("observed_us"), zone_of_park(park)))
    numbered = as_known(readings.select("ingest_seq", park.alias("park"), "park_day", "observed_us"), keys, "observed_us", "ingest_seq", changes)
    wide = changes.join(hours.drop(*keys), "hours_id").drop("at_us")
    return numbered.join(wide, [*keys, "version_no"]).select(
        "ingest_seq", "park", F.col("park_day").cast("string").alias("park_date"), "version_no", "hours_id", "version_type", "opening_us", "closing_us",
        F.coalesce("emh_morning", F.lit(False)).alias("emh_morning"), F.coalesce("emh_evening", F.lit(False)).alias("emh_evening"),
    )
