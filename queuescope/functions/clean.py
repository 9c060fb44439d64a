"""Cleaning of dimension columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text(c: Column, case: str | None = None) -> Column:
    """Trimmed text in the wanted case; empty and 'nan' are null."""
    t = F.trim(c)
    t = F.when((t != "") & (F.lower(t) != "nan"), t)
    return F.upper(t) if case == "upper" else F.lower(t) if case == "lower" else t


def flag(c: Column) -> Column:
    """true/1/yes/y/t and false/0/no/n/f/nan/empty in any case; everything else and null are false."""
    return F.coalesce(F.lower(F.trim(c)).isin("true", "1", "yes", "y", "t"), F.lit(False))


def number_flag(c: Column) -> Column:
    """A number other than zero is true; null and text that is no number are false."""
    return F.coalesce(c.try_cast("double"), F.lit(0.0)) != 0


def date(c: Column, formats: Sequence[str] = ("yyyy-MM-dd", "MM/dd/yyyy", "yyyy/MM/dd", "dd/MM/yyyy")) -> Column:
    """The date of the first format that reads the whole text, else null."""
    t = F.trim(c)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)).cast("date") for f in formats])


def rename_if_absent(frame: DataFrame, names: dict[str, str]) -> DataFrame:
    """Renames old to new columns where the old one exists and the new one does not."""
    for old, new in names.items():
        if old in frame.columns and new not in frame.columns:
            frame = frame.withColumnRenamed(old, new)
    return frame


def first_present(frame: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first candidate that is a column."""
    return next((c for c in candidates if c in frame.columns), None)


def normal_headers(frame: DataFrame, case: str = "lower") -> DataFrame:
    """Column names stripped and folded."""
    return frame.toDF(*[c.strip().lower() if case == "lower" else c.strip().upper() for c in frame.columns])


def ensure_column(frame: DataFrame, name: str, kind: str = "string") -> DataFrame:
    """The frame with the column, null where it was absent."""
    return frame if name in frame.columns else frame.withColumn(name, F.lit(None).cast(kind))


def above_zero(c: Column, allow_zero: bool = False) -> Column:
    """Numbers that make no sense at or below zero become null."""
    return F.when(c >= 0 if allow_zero else c > 0, c)


def columns_matching(frame: DataFrame, wanted: Sequence[str], unwanted: Sequence[str] = ()) -> list[str]:
    """Columns whose name contains one of the wanted texts and none of the unwanted."""
    return [c for c in frame.columns if any(w in c.upper() for w in wanted) and not any(u in c.upper() for u in unwanted)]


# Opening date of each park.
OPENED_BY_PARK = {
    "mk": "1971-10-01",
    "ep": "1982-10-01",
    "hs": "1989-05-01",
    "ak": "1998-04-22",
    "dl": "1955-07-17",
    "ca": "2001-02-08",
    "tdl": "1983-04-15",
    "tds": "2001-09-04",
    "uf": "1990-06-07",
    "ia": "1999-05-28",
    "eu": "2025-06-01",
    "ush": "1964-07-15",
}
# Opening date where the park is unknown, extinction date of what still stands.
OPENED, EXTINCT = "1955-07-17", "2099-01-01"
# Parts of the names of flag columns of the day table, and of names that are none.
FLAG_NAMES = ("MORN", "EVE", "YEST", "TOM", "PRDDAY", "PRDNGT", "FIREWK", "SHWNGT", "FIREWKS", "OPTIMIZERS")
NO_FLAG_NAMES = ("OPEN", "CLOSE", "T1", "T2", "HOURS", "HOURSEMH", "DT1", "DT2", "NT1", "NT2")


def clean_events(frame: DataFrame) -> DataFrame:
    """The event dimension: codes in one case, names trimmed (empty ones null), ticket flag; columns that are absent stay so."""
    rows = rename_if_absent(frame, {"property_abbrev": "property_code"})
    cleaned = {"property_code": F.lower(F.trim("property_code")), "event_abbreviation": F.upper(F.trim("event_abbreviation")), "event_code": text(F.col("event_code"), "upper"), "event_name": text(F.col("event_name"))}
    if "event_hard_ticket" in rows.columns:
        cleaned["event_hard_ticket"] = F.col("event_hard_ticket") if dict(rows.dtypes)["event_hard_ticket"] == "boolean" else number_flag(F.col("event_hard_ticket"))
    return rows.withColumns({c: v for c, v in cleaned.items() if c in rows.columns})


def clean_metatable(frame: DataFrame) -> DataFrame:
    """The day table: codes in one case, dates, flag columns by the pattern of their names, all other texts trimmed."""
    rows = rename_if_absent(frame, {"park": "park_code", "date": "park_date", "property_abbrev": "property_code"})
    kinds = dict(rows.dtypes)
    cleaned = {c: text(F.col(c)) for c, kind in kinds.items() if kind == "string"}
    cleaned |= {c: flag(F.col(c).cast("string")) for c in columns_matching(rows, FLAG_NAMES, NO_FLAG_NAMES) if kinds[c] != "boolean"}
    own = {"park_code": text(F.col("park_code"), "upper"), "property_code": text(F.col("property_code"), "lower"), "park_date": date(F.col("park_date")).cast("string")}
    return rows.withColumns(cleaned | {c: v for c, v in own.items() if c in kinds})


def clean_entities(frame: DataFrame, opened_by_park: dict[str, str] = OPENED_BY_PARK, opened: str = OPENED, extinct: str = EXTINCT) -> DataFrame:
    """The attraction dimension: codes, dates with defaults, flags, impossible numbers nulled."""
    park = text(F.col("park_code"), "lower")
    by_park = F.create_map(*[F.lit(x) for pair in (opened_by_park or {"": opened}).items() for x in pair])
    return frame.withColumns({
        "entity_code": text(F.col("entity_code"), "upper"),
        "entity_name": text(F.col("entity_name")),
        "short_name": text(F.col("short_name")),
        "park_code": park,
        "land": text(F.col("land")),
        "opened_on": F.coalesce(date(F.col("opened_on")), F.try_element_at(by_park, F.coalesce(park, F.lit(""))).cast("date"), F.lit(opened).cast("date")),
        "extinct_on": F.coalesce(date(F.col("extinct_on")), F.lit(extinct).cast("date")),
        "fastpass_booth": flag(F.col("fastpass_booth")),
        "height_restriction": above_zero(F.col("height_restriction"), allow_zero=True),
        "duration": above_zero(F.col("duration")),
    })
