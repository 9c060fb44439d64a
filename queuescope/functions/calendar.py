"""Calendar columns: spine, Easter, holidays, date groups, seasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuescope.functions.timestamps import bound

# Label of the date group of each holiday code.
GROUP_OF_HOLIDAY = {
    "ASH": "ASH_WEDNESDAY",
    "EST": "EASTER_SATURDAY",
    "ESS": "EASTER_SUNDAY",
    "ESM": "EASTER_MONDAY",
    "GFR": "GOOD_FRIDAY",
    "HAL": "HALLOWEEN",
    "IND": "INDEPENDENCE_DAY",
    "LAB": "LABOR_DAY",
    "MEM": "MEMORIAL_DAY",
    "MLK": "MARTIN_LUTHER_KING_DAY",
    "NYD": "NEW_YEARS_DAY",
    "NYE": "NEW_YEARS_EVE",
    "PRS": "PRESIDENTS_DAY",
    "THK": "THANKSGIVING",
    "VET": "VETERANS_DAY",
    "BOX": "BOXING_DAY",
    "COL": "COLUMBUS_DAY",
    "CMD": "CHRISTMAS_DAY",
    "CME": "CHRISTMAS_EVE",
    "MGR": "MARDI_GRAS",
    "PMP": "PRESIDENTS_DAY_WITH_MARDI_GRAS",
    "PMM": "MARDI_GRAS_WITH_PRESIDENTS_DAY",
}

# Holidays on a day of the year.
FIXED_HOLIDAYS = {"NYD": (1, 1), "IND": (7, 4), "HAL": (10, 31), "VET": (11, 11), "CME": (12, 24), "CMD": (12, 25), "BOX": (12, 26), "NYE": (12, 31)}

# Holidays on a weekday (0 = Monday) within days of a month.
WEEKDAY_HOLIDAYS = {"MLK": (1, 0, 15, 21), "PRS": (2, 0, 15, 21), "MEM": (5, 0, 25, 31), "LAB": (9, 0, 1, 7), "COL": (10, 0, 8, 14), "THK": (11, 3, 22, 28)}

# Holidays by their distance in days from Easter Sunday.
EASTER_HOLIDAYS = {"MGR": -47, "ASH": -46, "GFR": -2, "EST": -1, "ESS": 0, "ESM": 1}

# The order in which codes win when two fall on one date, last first.
HOLIDAY_ORDER = ("NYE", "BOX", "CMD", "CME", "THK", "VET", "NJC", "HAL", "COL", "LAB", "IND", "MEM", "ESM", "ESS", "EST", "GFR", "ASH", "MGR", "PRS", "MLK", "NYD")

# Pattern of the date group, season, days carried before and after; earlier rows win.
HOLIDAY_SEASONS = (
    ("MARTIN_LUTHER|MLK", "MLK_JR_DAY", 3, 2),
    ("PRESIDENTS", "PRESIDENTS_DAY", 3, 2),
    ("MARDI_GRAS", "MARDI_GRAS", 3, 2),
    ("MEMORIAL", "MEMORIAL_DAY", 3, 2),
    ("LABOR", "LABOR_DAY", 3, 2),
    ("THANKSGIVING", "THANKSGIVING", 1, 1),
    ("CHRISTMAS|NEW_YEAR|BOXING", "CHRISTMAS", 1, 1),
    ("EASTER_MONDAY|EASTER_SATURDAY|EASTER_SUNDAY|GOOD_FRIDAY", "EASTER", 1, 1),
    ("JERSEY", "JERSEY_WEEK", 1, 1),
    ("HALLOWEEN", "HALLOWEEN", 1, 1),
    ("VETERANS", "VETERANS_DAY", 1, 1),
    ("COLUMBUS", "COLUMBUS_DAY", 1, 1),
    ("MARATHON", "MARATHON", 1, 1),
)

# Seasons of the dates that no holiday claims.
PLAIN_SEASONS = (
    ("AFTER_EASTER", "AFTER_EASTER"),
    ("BEFORE_EASTER", "BEFORE_EASTER"),
    ("MAY_WEEK", "SPRING"),
    ("JUN_WEEK|JUL_WEEK|INDEPENDENCE|AUG_WEEK", "SUMMER"),
    ("SEP_WEEK|OCT_WEEK|NOV_WEEK", "AUTUMN"),
    ("DEC_WEEK|JAN_WEEK|FEB_WEEK", "WINTER"),
)


def date_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("park_date"))


def easter(year: Column) -> Column:
    """Easter Sunday of a year of the Gregorian calendar.

    The age of the moon on 21 March gives the paschal full moon, the weekday of
    that day the Sunday after it.  Intermediate values are bound once, so the
    expression stays small.
    """

    def div(a: Column, b: int) -> Column:
        return F.floor(a / F.lit(b)).cast("int")

    def from_moon(y: Column, century: Column, full_moon: Column) -> Column:
        weekday = (y + div(y, 4) + full_moon + 2 - century + div(century, 4)) % 7
        return F.date_add(F.make_date(y, F.lit(3), F.lit(21)), (full_moon - weekday + 7).cast("int"))

    def from_epact(y: Column, century: Column, epact: Column) -> Column:
        # a full moon on the last possible day moves back by one, and so does the day before it in the later golden years
        full_moon = F.when(epact == 29, 28).when((epact == 28) & (y % 19 > 10), 27).otherwise(epact)
        return bound(full_moon, lambda m: from_moon(y, century, m))

    def from_century(y: Column, century: Column) -> Column:
        epact = (19 * (y % 19) + century - div(century, 4) - div(8 * century + 13, 25) + 15) % 30
        return bound(epact, lambda e: from_epact(y, century, e))

    return bound(year.cast("int"), lambda y: bound(div(y, 100), lambda c: from_century(y, c)))


def calendar_columns(spine: DataFrame) -> DataFrame:
    """Calendar attributes of park_date; weekdays count from Monday = 1, weeks are ISO weeks."""
    d = F.col("park_date")
    return spine.withColumns({
        "year": F.year(d).cast("bigint"),
        "month": F.month(d).cast("bigint"),
        "day": F.dayofmonth(d).cast("bigint"),
        "day_of_week": (F.weekday(d) + 1).cast("bigint"),
        "quarter": F.quarter(d).cast("bigint"),
        "week_of_year": F.weekofyear(d).cast("bigint"),
        "day_of_year": F.dayofyear(d).cast("bigint"),
        "month_name": F.date_format(d, "MMMM"),
        "month_mmm": F.date_format(d, "MMM"),
        "month_m": F.substring(F.date_format(d, "MMM"), 1, 1),
        "day_of_week_name": F.date_format(d, "EEEE"),
        "day_of_week_ddd": F.date_format(d, "EEE"),
        "day_of_week_d": F.substring(F.date_format(d, "EEE"), 1, 1),
        "month_year": F.date_format(d, "MMM-yyyy"),
        "quarter_year": F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit("-"), F.year(d).cast("string")),
        "year_yy": F.concat(F.lit("'"), F.date_format(d, "yy")),
        "output_file_label": F.concat(F.date_format(d, "yyyy_MM"), F.upper(F.date_format(d, "MMM"))),
    })


def relative_columns(spine: DataFrame, today: str) -> DataFrame:
    """Offsets to ``today`` in days, months, quarters and years, and to-date flags."""
    d, t = F.col("park_date"), F.lit(today).cast("date")
    return spine.withColumns({
        "cur_day_offset": F.datediff(d, t).cast("bigint"),
        "cur_month_offset": ((F.year(d) - F.year(t)) * 12 + F.month(d) - F.month(t)).cast("bigint"),
        "cur_quarter_offset": ((F.year(d) - F.year(t)) * 4 + F.quarter(d) - F.quarter(t)).cast("bigint"),
        "cur_year_offset": (F.year(d) - F.year(t)).cast("bigint"),
        "future_date": F.when(d > t, "Future").otherwise("Past"),
        "ytd_flag": F.dayofyear(d) <= F.dayofyear(t),
        "mtd_flag": F.dayofmonth(d) <= F.dayofmonth(t),
    })


def holiday_code(d: Column, sunday: Column) -> Column:
    """Holiday code of a date before neighbours are looked at; ``sunday`` is its year's Easter. NONE where there is none."""
    tests = {code: (F.month(d) == m) & (F.dayofmonth(d) == day) for code, (m, day) in FIXED_HOLIDAYS.items()}
    tests |= {code: (F.month(d) == m) & (F.weekday(d) == w) & F.dayofmonth(d).between(a, b) for code, (m, w, a, b) in WEEKDAY_HOLIDAYS.items()}
    tests |= {code: d == F.date_add(sunday, off) for code, off in EASTER_HOLIDAYS.items()}
    tests["NJC"] = (F.month(d) == 11) & F.weekday(d).between(1, 5) & F.dayofmonth(d).between(2, 8)
    found = F
    for code in HOLIDAY_ORDER:
        found = found.when(tests[code], code)
    return found.otherwise("NONE")


# Name of each holiday code; all others are "None".
NAME_OF_HOLIDAY = {
    "NYD": "New Year's Day",
    "MLK": "Martin Luther King Jr. Day",
    "PRS": "Presidents' Day",
    "MGR": "Mardi Gras",
    "PMP": "Presidents' Day / Mardi Gras (Presidents' Day)",
    "PMM": "Presidents' Day / Mardi Gras (Mardi Gras)",
    "ASH": "Ash Wednesday",
    "GFR": "Good Friday",
    "EST": "Easter Saturday",
    "ESS": "Easter Sunday",
    "ESM": "Easter Monday",
    "MEM": "Memorial Day",
    "IND": "Independence Day",
    "LAB": "Labor Day",
    "COL": "Columbus Day",
    "HAL": "Halloween",
    "NJC": "Jersey Week",
    "VET": "Veterans Day",
    "THK": "Thanksgiving",
    "CME": "Christmas Eve",
    "CMD": "Christmas Day",
    "BOX": "Boxing Day",
    "NYE": "New Year's Eve",
}


def holiday_name(code: Column) -> Column:
    """The name of a holiday code; None (as text) where there is no holiday."""
    named = F.create_map(*[F.lit(x) for pair in NAME_OF_HOLIDAY.items() for x in pair])
    return F.coalesce(F.try_element_at(named, code), F.lit("None"))


def with_holidays(spine: DataFrame) -> DataFrame:
    """Adds holidaycode and holidayname; Presidents' Day and a Mardi Gras on the next date become one pair."""
    by_year = Window.partitionBy(F.year("park_date")).orderBy("park_date")
    dated = spine.withColumn("__easter", easter(F.year("park_date")))
    raw = dated.withColumn("__code", holiday_code(F.col("park_date"), F.col("__easter")))
    pair_first = (F.col("__code") == "PRS") & (F.lead("__code").over(by_year) == "MGR")
    pair_second = (F.col("__code") == "MGR") & (F.lag("__code").over(by_year) == "PRS")
    return raw.withColumn("holidaycode", F.when(pair_first, "PMP").when(pair_second, "PMM").otherwise(F.col("__code"))).withColumn("holidayname", holiday_name(F.col("holidaycode"))).drop("__code", "__easter")


def with_date_group(spine: DataFrame) -> DataFrame:
    """Adds date_group_id to dates with holidaycode.

    From Good Friday on a year is after Easter; the flag is a running maximum.
    """
    d = F.col("park_date")
    running = Window.partitionBy(F.year("park_date")).orderBy("park_date").rowsBetween(Window.unboundedPreceding, 0)
    over = F.max((F.col("holidaycode") == "GFR").cast("int")).over(running) == 1
    week = F.floor((F.dayofmonth(d) - 1) / 7) + 1
    prefix = F.when(F.month(d).between(3, 4), F.when(over, "AFTER_EASTER_").otherwise("BEFORE_EASTER_")).otherwise("")
    weekday = F.upper(F.date_format(d, "EEE"))
    plain = F.concat(prefix, F.upper(F.date_format(d, "MMM")), F.lit("_WEEK"), F.when(week >= 4, "4OR5").otherwise(week.cast("string")), F.lit("_"), weekday)
    named = F.create_map(*[F.lit(x) for pair in GROUP_OF_HOLIDAY.items() for x in pair])
    late = (F.month(d) == 12) & F.dayofmonth(d).between(27, 30)
    group = (
        F.when(late, F.concat(F.lit("DEC"), F.dayofmonth(d).cast("string")))
        .when(F.col("holidaycode") == "NJC", F.concat(F.lit("JERSEY_WEEK_"), weekday))
        .otherwise(F.coalesce(F.try_element_at(named, F.col("holidaycode")), plain))
    )
    return spine.withColumn("date_group_id", group)


def with_season(spine: DataFrame) -> DataFrame:
    """Adds season and season_year to dates with date_group_id.

    Each date a holiday pattern matches carries its season some days each way;
    the earlier pattern wins.  Carried dates are found by spreading the few
    matches over their window and an equi-join on the date.
    """
    d, group = F.col("park_date"), F.col("date_group_id")
    matches = F.array(*[F.when(group.rlike(p), F.struct(F.lit(i).alias("rank"), F.lit(label).alias("label"), F.lit(before).alias("before"), F.lit(after).alias("after"))) for i, (p, label, before, after) in enumerate(HOLIDAY_SEASONS)])
    spread = spine.select(d, F.inline(F.filter(matches, lambda m: m.isNotNull())))
    spread = spread.select(F.explode(F.sequence(F.date_sub(d, F.col("before")), F.date_add(d, F.col("after")))).alias("park_date"), "rank", "label")
    carried = spread.groupBy("park_date").agg(F.min_by("label", "rank").alias("__carried"))
    peak = ((F.month(d) == 12) & (F.dayofmonth(d) >= 27)) | ((F.month(d) == 1) & (F.dayofmonth(d) == 1))
    base = spine.join(carried, "park_date", "left").withColumn("__s", F.when(peak, "CHRISTMAS_PEAK").otherwise(F.col("__carried"))).drop("__carried")
    # Presidents' dates within three days of Mardi Gras dates claim their whole window
    mardi = base.where(F.col("__s") == "MARDI_GRAS").select(F.explode(F.sequence(F.date_sub(d, 3), F.date_add(d, 3))).alias("park_date")).distinct()
    near = base.where(F.col("__s") == "PRESIDENTS_DAY").join(mardi, "park_date", "left_semi")
    claimed = near.select(F.explode(F.sequence(F.date_sub(d, 3), F.date_add(d, 3))).alias("park_date")).distinct().withColumn("__both", F.lit("PRESIDENTS_DAY_MARDI_GRAS"))
    plain = F
    for pattern, label in PLAIN_SEASONS:
        plain = plain.when(group.rlike(pattern), label)
    season = F.coalesce(F.col("__both"), F.col("__s"), plain.otherwise(""))
    year = F.year(d) - F.when((F.month(d) == 1) & F.col("season").isin("CHRISTMAS", "CHRISTMAS_PEAK"), 1).otherwise(0)
    return base.join(claimed, "park_date", "left").withColumn("season", season).withColumn("season_year", F.concat_ws("_", "season", year.cast("string"))).drop("__s", "__both")
