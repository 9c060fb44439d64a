"""Fixed values of the domain."""

# Letters before the number of an entity code, and their park.
PARK_OF_PREFIX = {
    "MK": "mk",
    "EP": "ep",
    "HS": "hs",
    "AK": "ak",
    "BB": "bb",
    "TL": "tl",
    "DL": "dl",
    "CA": "ca",
    "TDL": "tdl",
    "TDS": "tds",
    "IA": "ia",
    "UF": "uf",
    "EU": "eu",
    "USH": "uh",
}

# Zone of each park; parks not named are in the default zone.
ZONE_OF_PARK = {
    "mk": "America/New_York",
    "ep": "America/New_York",
    "hs": "America/New_York",
    "ak": "America/New_York",
    "bb": "America/New_York",
    "tl": "America/New_York",
    "dl": "America/Los_Angeles",
    "ca": "America/Los_Angeles",
    "tdl": "Asia/Tokyo",
    "tds": "Asia/Tokyo",
    "ia": "America/New_York",
    "uf": "America/New_York",
    "eu": "America/New_York",
    "uh": "America/Los_Angeles",
}

# Zone of each property at ingest.
ZONE_OF_PROPERTY = {
    "wdw": "America/New_York",
    "uor": "America/New_York",
    "dlr": "America/Los_Angeles",
    "ush": "America/Los_Angeles",
    "tdr": "Asia/Tokyo",
}

DEFAULT_ZONE = "America/New_York"

#: All zones that parks and properties are in.
ZONES = ("America/New_York", "America/Los_Angeles", "Asia/Tokyo")

#: Properties that write the day before the month in slashed dates.
DAY_FIRST_PROPERTIES = ("tdr",)

# Which kind of hours version wins, best first.
VERSION_ORDER = ("official", "final", "predicted", "historical")

# Code of a sold-out return time, and the default datetime written for absent hours.
SOLD_OUT = 8888
DEFAULT_DATETIME = "1999-01-01T00:00:00-08:00"
DEFAULT_DATETIME_US = 915_177_600_000_000

#: Local hours before this one belong to the day before.
DAY_STARTS_AT = 6

#: Texts that stand for an absent value, lower case.
FILLERS = ("", "-", "--", "--:--", "nan", "nat", "null", "none", "n/a", "na", "unknown", "tbd", "closed?", "?")
