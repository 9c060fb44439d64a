"""Data-quality queries over whole tables: spikes, times, fills, histories, as-known attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuescope.functions.timestamps import is_exact
from queuescope.operators.fill import fill_hours
from queuescope.operators.history import hours_history
from queuescope.operators.hours import usable_hours, with_hours_instants
from queuescope.operators.known import hours_as_known
from queuescope.operators.readings import later_repeats, typed_readings, with_reading_instant
from queuescope.operators.spikes import flag_spikes
from queuescope.session import cut, spread, table


def _hours(spark: SparkSession, d: str) -> DataFrame:
    """Hours with instants; cut, because several branches of each plan read them."""
    return cut(with_hours_instants(spread(table(spark, d, "dimparkhours_with_donor"))))


def _flags(spark: SparkSession, d: str) -> DataFrame:
    """The flagged readings of all that report something new."""
    readings = typed_readings(table(spark, d, "dedupe_keys"), ("ingest_seq", "source", "source_key", "kind", "observed_us", "minutes"))
    return flag_spikes(readings.join(later_repeats(readings), "ingest_seq", "left_anti"), everything=False)


def p1_spikes(spark: SparkSession, d: str) -> DataFrame:
    """Every implausible reading with its reasons."""
    flagged = _flags(spark, d).where(F.col("impossible") | F.col("disproportionate") | F.col("stuck"))
    return flagged.select("ingest_seq", "source", "minutes", "impossible", "disproportionate", "stuck", F.col("run_length").cast("bigint").alias("run_length"))


def p1_chart(spark: SparkSession, d: str) -> DataFrame:
    """Every reading beyond the control limits of its source's own chart."""
    return _flags(spark, d).where("out_of_control").select("ingest_seq", "source", "minutes")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """ingest_seq of every implausible reading."""
    return p1_spikes(spark, d).select("ingest_seq")


def p2_instants(spark: SparkSession, d: str) -> DataFrame:
    """Every value of the three time fields with its notation and instant (null where it denotes none)."""
    seen = with_reading_instant(spread(table(spark, d, "dedupe_keys").select("ingest_seq", "prop", "observed_at")))
    observed = seen.select(F.lit("observed_at").alias("field_name"), F.col("ingest_seq").alias("row_id"), F.col("observed_at").alias("written"), F.col("observed_notation").alias("notation"), F.col("observed_us").alias("epoch_us"))
    hours = with_hours_instants(spread(table(spark, d, "dimparkhours_with_donor").select("hours_id", "park_date", "park_code", "opening_time", "closing_time")))
    fields = F.array(*[
        F.struct(F.lit(f"{f}_time").alias("field_name"), F.col(f"{f}_time").alias("written"), F.col(f"{f}_notation").alias("notation"), F.col(f"{f}_us").alias("epoch_us"))
        for f in ("opening", "closing")
    ])
    opened = hours.select(F.col("hours_id").alias("row_id"), F.inline(fields))
    return observed.unionByName(opened)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The values that denote an instant and are not yet written in the one form."""
    return p2_instants(spark, d).where(F.col("epoch_us").isNotNull() & ~is_exact(F.col("written"))).select("field_name", "row_id", "epoch_us")


def p4_filled(spark: SparkSession, d: str) -> DataFrame:
    """Every missing value with its fill, the method and the distance in days."""
    rows = fill_hours(_hours(spark, d))
    fields = F.array(*[
        F.struct(F.lit(name).alias("field_name"), F.col(out).cast("string").alias("value"), F.col(f"{out}_method").alias("method"), F.col(f"{out}_distance").cast("double").alias("distance_days"))
        for name, out in (("opening_time", "opening_minute"), ("closing_time", "closing_minute"), ("source", "source_filled"))
    ])
    return rows.select("hours_id", F.inline(fields)).where(F.col("method") != "observed")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The values that were missing."""
    return p4_filled(spark, d).select("hours_id", "field_name")


def p5_history(spark: SparkSession, d: str) -> DataFrame:
    """The gapless history of park hours."""
    history = hours_history(usable_hours(_hours(spark, d)))
    ends = {f"{c}_us": F.unix_micros(c).cast("double") for c in ("valid_from", "valid_until")}
    return history.withColumns(ends | {"closed_by": F.col("closed_by").cast("double")}).drop("valid_from", "valid_until")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The rows that begin a version, and the row that closes it (0 if none)."""
    return p5_history(spark, d).select("hours_id", F.coalesce("closed_by", F.lit(0)).cast("bigint").alias("closed_by"))


def p6_known_hours(spark: SparkSession, d: str) -> DataFrame:
    """Every reading with the park hours valid and known at its instant."""
    known = hours_as_known(typed_readings(table(spark, d, "dedupe_keys"), ("ingest_seq", "park", "park_day", "observed_us")), usable_hours(_hours(spark, d)))
    return known.select("ingest_seq", "park", "park_date", "hours_id", F.lower(F.trim("version_type")).alias("version_type"), "opening_us", "closing_us", "emh_morning", "emh_evening")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Reading and the hours row that held for it."""
    return p6_known_hours(spark, d).select("ingest_seq", "hours_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_spikes, p1_chart, p2_found, p2_instants, p4_found, p4_filled, p5_found, p5_history, p6_found, p6_known_hours)}
