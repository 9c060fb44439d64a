"""Flat hours tables: cleaning, opening windows, and their way into versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queuescope.constants import DEFAULT_DATETIME
from queuescope.functions.clean import number_flag, text
from queuescope.operators import versions
from queuescope.operators.ordered import null_safe_join
from queuescope.operators.reports import first_per_group


def clean_hours(frame: DataFrame) -> DataFrame:
    """Codes and dates trimmed, absent core times made the default datetime, early and late times filled.

    An early (late) opening that is absent is the default datetime where its flag
    says that there is one, the regular time where it says there is none.
    Flags are numbers; null is false.
    """
    opening, closing = (F.coalesce(text(F.col(c)), F.lit(DEFAULT_DATETIME)) for c in ("opening_time", "closing_time"))

    def extended(name: str, flag: str, regular: Column) -> Column:
        return F.coalesce(text(F.col(name)), F.when(number_flag(F.col(flag)), F.lit(DEFAULT_DATETIME)).otherwise(regular))

    return frame.withColumns({
        "park_code": text(F.col("park_code"), "upper"),
        "park_date": text(F.col("park_date")),
        "opening_time": opening,
        "closing_time": closing,
        "opening_time_with_emh": extended("opening_time_with_emh", "emh_morning", opening),
        "closing_time_with_emh_or_party": extended("closing_time_with_emh_or_party", "emh_evening", closing),
        "emh_morning": number_flag(F.col("emh_morning")),
        "emh_evening": number_flag(F.col("emh_evening")),
    })


def clean_event_days(frame: DataFrame) -> DataFrame:
    """Event days: upper-case codes, dates, whole-number ticket flags."""
    return frame.withColumns({
        "event_code": text(F.col("event_code"), "upper"),
        "park_code": text(F.col("park_code"), "upper"),
        "park_date": text(F.col("park_date")),
        "event_hard_ticket": number_flag(F.col("event_hard_ticket")),
    })


def open_window(hours: DataFrame) -> DataFrame:
    """Earliest opening and latest closing minute per park and date over all its rows; closings past midnight count on."""
    closing = F.when(F.col("closing_minute") < F.col("opening_minute"), F.col("closing_minute") + 1440).otherwise(F.col("closing_minute"))
    return hours.groupBy("park_code", "park_date").agg(F.min("opening_minute").alias("first_minute"), F.max(closing).alias("last_minute"))


def within_window(rows: DataFrame, window: DataFrame, minute: str, margin: int = 90) -> DataFrame:
    """Rows at most ``margin`` minutes outside their park's window; parks without hours are always inside."""
    joined = rows.join(window, ["park_code", "park_date"], "left")
    inside = F.coalesce(F.col(minute).between(F.col("first_minute") - margin, F.col("last_minute") + margin), F.lit(True))
    return joined.where(inside).drop("first_minute", "last_minute")


def to_versions(frame: DataFrame, created_us: int) -> DataFrame:
    """Rows of a flat table as open official versions that begin at ``created_us``."""
    return frame.withColumns({
        "version_type": F.lit("official"),
        "source": F.lit("migration"),
        "valid_from_us": F.lit(created_us).cast("bigint"),
        "valid_until_us": F.lit(None).cast("bigint"),
        "created_us": F.lit(created_us).cast("bigint"),
    })


def fill_horizon(dates: DataFrame, known: DataFrame) -> DataFrame:
    """Predicted hours for every park and future date that has none.

    ``dates``: park_date, date_group_id of the horizon; ``known``: park_code, park_date,
    date_group_id, opening_minute, closing_minute.  Each missing date takes the hours of its
    best donor in the past; a park without any past date gets no prediction.
    """
    grid = versions.missing_keys(dates.select("park_date"), known.select("park_code"), known.select("park_date", "park_code"))
    targets = grid.join(dates, "park_date").select("park_code", "park_date", "date_group_id")
    donors = versions.best_donor(targets, known.select("park_code", "park_date", "date_group_id").distinct()).where(F.col("donor_date").isNotNull())
    lent = known.groupBy("park_code", F.col("park_date").alias("donor_date")).agg(F.min_by(F.struct("opening_minute", "closing_minute"), F.struct("opening_minute", "closing_minute")).alias("h"))
    return donors.join(lent, ["park_code", "donor_date"]).select(
        "park_code", "park_date", "donor_date", "confidence", F.col("h.opening_minute").alias("opening_minute"), F.col("h.closing_minute").alias("closing_minute"),
        F.concat(F.lit("Donor: "), "park_code", F.lit(" "), F.col("donor_date").cast("string")).alias("notes"),
    )


def donor_date_of(notes: Column) -> Column:
    """The date in a donor note: its second word after the mark."""
    return F.split_part(F.regexp_replace(notes, "^Donor: ", ""), F.lit(" "), F.lit(2)).try_cast("date")


def entities_with(facts: DataFrame, kind: str, per_park: int = 5) -> DataFrame:
    """Per park: how many entities have readings of a kind, and the busiest of them."""
    counted = facts.where(F.col("wait_time_type") == kind).groupBy("park_code", "entity_code").agg(F.count(F.lit(1)).alias("n"))
    totals = counted.groupBy("park_code").agg(F.count(F.lit(1)).alias("n_entities"))
    busiest = first_per_group(counted, ["park_code"], [F.col("n").desc(), F.col("entity_code")], per_park)
    listed = busiest.groupBy("park_code").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("r"), "entity_code"))).alias("__l"))
    return null_safe_join(totals, listed, ["park_code"]).select("park_code", "n_entities", F.transform("__l", lambda x: x["entity_code"]).alias("examples"))


def diverse_pick(counted: DataFrame, top: int = 30, first: int = 20) -> DataFrame:
    """Of entities with counts (park_code, entity_code, n): the ``top`` busiest, of these the first ``first`` and then each one of a park not seen before it.

    Sorting keeps ``top`` rows in each task; all after it works on these.
    """
    best = counted.orderBy(F.col("n").desc(), "entity_code").limit(top)
    placed = best.withColumn("place", F.row_number().over(Window.orderBy(F.col("n").desc(), "entity_code")))
    new_park = F.row_number().over(Window.partitionBy("park_code").orderBy("place")) == 1
    return placed.withColumn("__new", new_park).where((F.col("place") <= first) | F.col("__new")).drop("__new")
