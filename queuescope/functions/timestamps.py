"""Mixed notations of time to one unambiguous instant.

An ordered cascade of anchored patterns reads the fields of a text; the fields
are checked strictly (no 25:61, no 30 February, no month 13).  A text with an
offset, a zone abbreviation or an epoch is an instant by itself; any other is
wall-clock time in the zone given by the caller's lookup.  The two local times
that do not map one to one have an explicit policy each:

* ``ambiguous`` (occurs twice): ``"earlier"`` or ``"later"`` or ``"null"``
* ``nonexistent`` (never occurs): ``"after_gap"`` (first moment after the gap),
  ``"shift"`` (moved on by the gap's length) or ``"null"``

Everything is built-in column expressions in steps that stay inside one
generated stage; no value leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuescope.constants import DEFAULT_DATETIME_US


class Notation(NamedTuple):
    """An anchored pattern and how its groups are written as a time.

    ``wall`` is the wall clock as ``Y-M-D h:m:s``, in the syntax of a regular expression's
    replacement; it may end after ``m:`` where seconds are left out, and lacks the date
    where ``needs_date`` says so.  ``day_first`` is the wall clock of texts that write
    the day before the month.  ``month`` is the group that spells the month, which ``wall``
    then writes as MM.
    """

    name: str
    pattern: str
    wall: str = ""
    zone: str = ""
    half: str = ""
    epoch: str = ""
    month: str = ""
    day_first: str | None = None
    needs_date: bool = False

    def rewritten(self, day_first: bool = False) -> str:
        """The replacement: name, wall clock, zone, half of day, epoch and month, parted by bars."""
        wall = self.day_first if day_first and self.day_first is not None else self.wall
        return "|".join((self.name, wall, self.zone, self.half, self.epoch, self.month))


_ZONE = r"[ ]?([Zz]|[+-]\d{2}:?\d{2})?"
#: Blanks of any kind: those of ASCII, the no-break and the wide space, and the byte-order mark.
BLANKS = " \t\n\x0b\x0c\r\u00a0\u3000\ufeff"

#: Tried in this order; the first pattern that matches the whole text decides.
NOTATIONS: tuple[Notation, ...] = (
    Notation("iso", rf"^(\d{{4}}-\d{{2}}-\d{{2}})[Tt ](\d{{2}}:\d{{2}})(?::(\d{{2}})(?:[.,](\d{{1,9}}))?)?{_ZONE}$", "$1 $2:$3.$4", "$5"),
    Notation("epoch_seconds", r"^(\d{10})$", epoch="$1000000"),
    Notation("epoch_millis", r"^(\d{13})$", epoch="$1000"),
    Notation("epoch_micros", r"^(\d{16})$", epoch="$1"),
    Notation("basic", r"^(\d{4})(\d{2})(\d{2})[Tt](\d{2})(\d{2})(\d{2})?([Zz]|[+-]\d{2}:?\d{2})?$", "$1-$2-$3 $4:$5:$6", "$7"),
    Notation("year_slashes", rf"^(\d{{4}})/(\d{{1,2}})/(\d{{1,2}})[Tt ](\d{{1,2}}:\d{{2}})(?::(\d{{2}})(?:\.(\d{{1,9}}))?)?{_ZONE}$", "$1-$2-$3 $4:$5.$6", "$7"),
    Notation("slashes", r"^(\d{1,2})/(\d{1,2})/(\d{4}),? (\d{1,2}:\d{2})(?::(\d{2}))?[ ]?([AaPp][Mm])?$", "$3-$1-$2 $4:$5", half="$6", day_first="$3-$2-$1 $4:$5"),
    Notation("mail", r"^(?:[A-Za-z]{3}, )?(\d{1,2}) ([A-Za-z]{3}) (\d{4}) (\d{2}:\d{2})(?::(\d{2}))?(?: ([+-]\d{4}|[A-Za-z]{1,4}))?$", "$3-MM-$1 $4:$5", "$6", month="$2"),
    Notation("cjk", r"^(\d{4})年(\d{1,2})月(\d{1,2})日[ ]?(\d{1,2})(?::|時)(\d{2})分?(?::(\d{2}))?$", "$1-$2-$3 $4:$5:$6"),
    Notation("clock", r"^(\d{1,2}:\d{2})(?::(\d{2}))?[ ]?([AaPp][Mm])?$", "$1:$2", half="$3", needs_date=True),
    Notation("clock_digits", r"^(\d{2})(\d{2})$", "$1:$2:", needs_date=True),
)

# Abbreviations of zones and their minutes east of UTC.
ABBREVIATIONS = {
    "Z": 0,
    "UT": 0,
    "UTC": 0,
    "GMT": 0,
    "EST": -300,
    "EDT": -240,
    "CST": -360,
    "CDT": -300,
    "MST": -420,
    "MDT": -360,
    "PST": -480,
    "PDT": -420,
    "JST": 540,
}

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_SECOND, _MINUTE, _HOUR, _DAY = 1_000_000, 60_000_000, 3_600_000_000, 86_400_000_000
_EXACT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}[+-]\d{2}:\d{2}$"


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used.

    Plain nested expressions would be copied into each other by the optimizer.
    """
    return F.transform(F.array(value), use)[0]


def _apart(value: Column) -> Column:
    """The value itself, in a form that ends a generated stage.

    Too long a generated method is never compiled by the JVM; a step that is not generated
    code keeps the stages before and after it short.
    """
    return bound(value, lambda v: v)


def trimmed(text: Column) -> Column:
    """The text without blanks of any kind around it (tabs, no-break and wide spaces too)."""
    return F.btrim(text, F.lit(BLANKS))


def lookup(mapping: dict[str, str], key: Column, default: str | None = None) -> Column:
    """The value of a small fixed mapping; the default where the key is null or unknown."""
    literal = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(literal, F.coalesce(key, F.lit("")))
    return found if default is None else F.coalesce(found, F.lit(default))


def lookup_number(mapping: dict[str, int], key: Column) -> Column:
    """The number of a small fixed mapping; null where the key is null or unknown."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]), key)


def is_exact(text: Column) -> Column:
    """Whether a text is already written as YYYY-MM-DDThh:mm:ss±hh:mm."""
    return F.coalesce(text.rlike(_EXACT), F.lit(False))


def _by_zone(use: Callable[[Column | str], Column], zone: Column | str, zones: Sequence[str]) -> Column:
    """``use(zone)``; each of the named zones is a literal in a branch of its own, so it is looked up once and not per row."""
    chosen = F
    for name in zones:
        chosen = chosen.when(zone == name, use(F.lit(name)))
    return chosen.otherwise(use(zone)) if zones else use(zone)


def wall_us(instant_us: Column, zone: Column | str, zones: Sequence[str] = ()) -> Column:
    """Wall-clock microseconds (as if UTC) of an instant in a zone; ``zones`` names the likely ones."""
    return F.unix_micros(_by_zone(lambda z: F.from_utc_timestamp(F.timestamp_micros(instant_us), z), zone, zones))


def _utc_us(wall: Column, zone: Column | str, zones: Sequence[str] = ()) -> Column:
    """Instant of wall-clock microseconds; the earlier one of two, moved on by the gap's length inside a gap."""
    return F.unix_micros(_by_zone(lambda z: F.to_utc_timestamp(F.timestamp_micros(wall), z), zone, zones))


def instant_of_wall(wall: Column, zone: Column | str, ambiguous: str = "earlier", nonexistent: str = "after_gap") -> Column:
    """Microseconds since 1970 UTC of wall-clock microseconds in a zone, under the given policies.

    The first moment after a gap is searched among the quarter hours before the
    shifted time: changes of civil time happen on quarter hours.
    """
    earlier = _utc_us(wall, zone)
    return _under_policies(wall, zone, earlier, wall_us(earlier, zone), ambiguous, nonexistent)


def _under_policies(wall: Column, zone: Column | str, earlier: Column, back: Column, ambiguous: str, nonexistent: str) -> Column:
    """The instant, given the earlier candidate and the wall clock that it reads back as."""
    if nonexistent == "null":
        gap = F.lit(None).cast("bigint")
    elif nonexistent == "shift":
        gap = earlier
    elif nonexistent == "after_gap":
        quarter = 15 * _MINUTE
        offset = back - earlier
        base = earlier - F.pmod(earlier, _long(quarter))
        steps = F.transform(F.sequence(F.lit(0), F.lit(12)), lambda k: base - k * _long(quarter))
        gap = F.coalesce(F.array_min(F.filter(steps, lambda at: (wall_us(at, zone) - at) == offset)), earlier)
    else:
        raise ValueError(f"unknown policy for nonexistent times: {nonexistent}")
    if ambiguous == "earlier":
        plain = earlier
    else:
        # the same wall clock up to three hours later, if it occurs again
        hours = F.transform(F.sequence(F.lit(1), F.lit(6)), lambda k: earlier + k * _long(_HOUR // 2))
        again = F.array_max(F.filter(hours, lambda at: wall_us(at, zone) == wall))
        if ambiguous == "later":
            plain = F.coalesce(again, earlier)
        elif ambiguous == "null":
            plain = F.when(again.isNull(), earlier)
        else:
            raise ValueError(f"unknown policy for ambiguous times: {ambiguous}")
    return F.when(back != wall, gap).otherwise(plain)


def with_instant(
    frame: DataFrame,
    text: str,
    zone: Column | str,
    out: str,
    *,
    base_date: Column | None = None,
    day_first: Column | None = None,
    notations: Sequence[Notation] = NOTATIONS,
    ambiguous: str = "earlier",
    nonexistent: str = "after_gap",
    day_starts_at: int = 6,
    zones: Sequence[str] = (),
    default_us: int | None = DEFAULT_DATETIME_US,
) -> DataFrame:
    """Adds ``{out}_us`` (bigint, microseconds since 1970 UTC) and ``{out}_notation`` (string).

    ``{out}_us`` is null for null, blank, filler or impossible texts, and for the
    default datetime ``default_us`` in any notation.  ``base_date`` (a date
    column) is what a bare clock time belongs to: times before
    ``day_starts_at`` fall on the next calendar day; without it bare times are
    no instants.  ``day_first`` (boolean column) reads slashed dates day first.
    ``zones`` names the likely values of ``zone``; others work as well, at a lookup per row.
    Columns that carry the names of the results are replaced; all others stay.
    """
    tried = [n for n in notations if base_date is not None or not n.needs_date]
    clocks = [n.name for n in tried if n.needs_date]
    spelled = [n.name for n in tried if n.month]
    kept = [c for c in frame.columns if c not in (f"{out}_us", f"{out}_notation")]
    lead = "__t"
    while any(c.lower().startswith(lead) for c in kept):
        lead += "_"

    def at(name: str) -> Column:
        return F.col(lead + name)

    def step(rows: DataFrame, **values: Column) -> DataFrame:
        """Adds values that later steps read more than once; the optimizer leaves such a projection apart."""
        return rows.withColumns({lead + name: value for name, value in values.items()})

    def replaced(n: Notation) -> Column:
        plain = F.regexp_replace(at("clean"), n.pattern, n.rewritten())
        return plain if day_first is None or n.day_first is None else F.when(day_first, F.regexp_replace(at("clean"), n.pattern, n.rewritten(True))).otherwise(plain)

    rows = step(frame, clean=trimmed(F.col(text)), zone=zone if isinstance(zone, Column) else F.lit(zone))
    # the first notation is the most frequent one: a changed text is a match, so its pattern runs once
    rows = step(rows, first=replaced(tried[0]))
    found = F.when(at("first") != at("clean"), at("first"))
    for n in tried[1:]:
        found = found.when(at("clean").rlike(n.pattern), replaced(n))
    rows = step(rows, f=F.split(found.otherwise(F.lit(None).cast("string")), r"\|"))
    name, wall, offset, half, epoch, month = (F.get(at("f"), F.lit(i)) for i in range(6))
    if spelled:
        place = F.instr(F.lit(_MONTHS), F.lower(month))
        number = F.when(place % 3 == 1, ((place + 2) / 3).cast("int").cast("string")).otherwise("")
        wall = F.when(name.isin(spelled), F.replace(wall, F.lit("MM"), number)).otherwise(wall)
    if base_date is not None:
        wall = F.when(name.isin(clocks), F.concat(base_date.cast("string"), F.lit(" "), wall)).otherwise(wall)
    rows = step(rows, wall=wall, offset=_apart(offset))
    # without seconds the text ends after the minutes
    seconds = F.when(at("wall").endswith(":"), F.concat(at("wall"), F.lit("00Z"))).when(at("wall").endswith(":."), F.concat(at("wall").substr(F.lit(1), F.length(at("wall")) - 1), F.lit("00Z")))
    rows = step(rows, clock=F.unix_micros(seconds.otherwise(F.concat(at("wall"), F.lit("Z"))).try_cast("timestamp")), half=half)
    hour = F.pmod(F.floor(at("clock") / _long(_HOUR)), F.lit(24))
    noon = F.when(hour.between(1, 12), at("clock") + (F.when(hour == 12, -12).otherwise(0) + F.when(F.upper(at("half")) == "PM", 12).otherwise(0)) * _long(_HOUR))
    rows = step(rows, at=F.when(at("half") == "", at("clock")).otherwise(noon))
    if base_date is not None:
        early = F.pmod(at("at"), _long(_DAY)) < day_starts_at * _HOUR
        rows = step(rows, at=F.when(name.isin(clocks) & early, at("at") + _long(_DAY)).otherwise(at("at")))
    # a numeric offset is a sign, two digits, perhaps a colon, and two digits
    sign = F.when(at("offset").startswith("-"), -1).when(at("offset").startswith("+"), 1)
    rows = step(rows, sign=sign, minutes=F.substring(at("offset"), -2, 2).try_cast("int"), local=_apart(F.when(at("offset") == "", at("at"))))
    numeric = F.when(at("minutes") < 60, at("sign") * (F.substring(at("offset"), 2, 2).try_cast("int") * 60 + at("minutes")))
    east = F.when(at("sign").isNotNull(), numeric).otherwise(lookup_number(ABBREVIATIONS, F.upper(at("offset"))))
    rows = step(rows, earlier=_utc_us(at("local"), at("zone"), zones))
    rows = step(rows, back=wall_us(at("earlier"), at("zone"), zones))
    civil = _under_policies(at("local"), at("zone"), at("earlier"), at("back"), ambiguous, nonexistent)
    instant = F.when(epoch != "", epoch.try_cast("bigint")).when(at("offset") == "", civil).otherwise(at("at") - east * _long(_MINUTE))
    if default_us is not None:
        rows = step(rows, instant=instant)
        written = F.coalesce(F.floor(at("at") / _long(_DAY)) == default_us // _DAY, F.lit(False))
        instant = F.when((at("instant") != default_us) & ~written, at("instant"))
    # exploded, although it is one value: a filter on the result then stays above, and no text is read twice
    value = F.struct(instant.alias("us"), name.alias("notation"))
    parsed = rows.select(*kept, F.explode(F.array(value)).alias(lead))
    return parsed.select(*kept, F.col(f"{lead}.us").alias(f"{out}_us"), F.col(f"{lead}.notation").alias(f"{out}_notation"))
