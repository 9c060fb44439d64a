"""Clock arithmetic on wall-clock timestamps and decay weights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock_us(ts: Column) -> Column:
    """Microseconds of a zone-less timestamp as if it were UTC; independent of the session zone."""
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    micros = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return F.unix_date(ts.cast("date")) * F.lit(86_400_000_000).cast("bigint") + seconds * F.lit(1_000_000).cast("bigint") + micros


def minutes_since_start_of_day(wall_us: Column, starts_at: int = 6) -> Column:
    """Minutes of the operational day that begins at ``starts_at``: 0 at 06:00, 1439 at 05:59."""
    minute = F.floor(wall_us / F.lit(60_000_000)) - starts_at * 60
    return F.pmod(minute, F.lit(1440)).cast("bigint")


def geometric_decay(days: Column, half_life: float = 730.0) -> Column:
    """0.5 to the power of days over half-life; null days weigh nothing."""
    return F.coalesce(F.pow(F.lit(0.5), days / half_life), F.lit(0.0))


def recency_weight(days: Column, scale: float = 365.0) -> Column:
    """1 / (1 + whole days / 365); null where that is no number."""
    return F.try_divide(F.lit(1.0), 1.0 + days / scale)


def label(minute: Column) -> Column:
    """HH:MM of a minute of the day; minutes past midnight wrap."""
    m = F.pmod(minute, F.lit(1440))
    return F.concat(F.lpad(F.floor(m / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((m % 60).cast("string"), 2, "0"))


def slot_label(minute: Column, width: int = 5) -> Column:
    """The HH:MM label of the slot that holds a minute."""
    return label((F.floor(minute / width) * width).cast("bigint"))


def clock_minutes(text: Column) -> Column:
    """Minutes of the day of an HH:MM[:SS] text, null where it is none or out of range."""
    h, m = F.split_part(text, F.lit(":"), F.lit(1)).try_cast("int"), F.split_part(text, F.lit(":"), F.lit(2)).try_cast("int")
    return F.when(F.trim(text).rlike(r"^\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?$") & h.between(0, 23) & m.between(0, 59), h * 60 + m).cast("bigint")


def display_actual(x: Column) -> Column:
    """Half-even whole minutes."""
    return F.bround(x, 0).cast("bigint")


def display_posted(x: Column) -> Column:
    """Half-even multiple of five."""
    return (F.bround(x / 5, 0) * 5).cast("bigint")


def not_negative(x: Column) -> Column:
    """A prediction clamped at zero; null stays null."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))
