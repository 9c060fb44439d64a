"""Codes of entities and parks, and the operational date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from queuescope.constants import DAY_STARTS_AT, DEFAULT_ZONE, PARK_OF_PREFIX, ZONE_OF_PARK, ZONES
from queuescope.functions.timestamps import lookup, trimmed, wall_us


def code(text: Column) -> Column:
    """An upper-case code without blanks around it; null stays null."""
    return F.upper(trimmed(text))


def park_of(entity_code: Column) -> Column:
    """Lower-case park of an entity code; an unknown prefix is its own park, null or empty gives ''."""
    return park_of_code(code(entity_code))


def park_of_code(entity: Column) -> Column:
    """:func:`park_of` of a code that :func:`code` has already made."""
    prefix = F.regexp_extract(entity, r"^[^0-9]*", 0)
    return F.coalesce(lookup(PARK_OF_PREFIX, prefix), F.lower(prefix), F.lit(""))


def zone_of_park(park: Column) -> Column:
    """Zone of a park code in any case; unknown parks are in the default zone."""
    return lookup(ZONE_OF_PARK, F.lower(trimmed(park)), DEFAULT_ZONE)


def park_date_of(instant_us: Column, zone: Column) -> Column:
    """The operational date of an instant: local date, or the day before when the local hour is below six."""
    return F.date_from_unix_date(F.floor((wall_us(instant_us, zone, ZONES) - F.lit(DAY_STARTS_AT * 3_600_000_000)) / F.lit(86_400_000_000)).cast("int"))
