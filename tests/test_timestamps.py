"""Notations of time, policies for local times, and defined results for odd input."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from queuescope.functions.timestamps import instant_of_wall, is_exact, with_instant


def us(text: str) -> int:
    return int(datetime.fromisoformat(text).timestamp()) * 1_000_000


CASES = [
    ("2023-10-30T09:40:05-04:00", us("2023-10-30T13:40:05+00:00")),
    ("2023-10-30T09:40:05-0400", us("2023-10-30T13:40:05+00:00")),
    ("2023-10-30T13:40:05Z", us("2023-10-30T13:40:05+00:00")),
    ("  2023-10-30T09:40:05-04:00", us("2023-10-30T13:40:05+00:00")),
    ("2023-10-30t09:40:05-04:00 ", us("2023-10-30T13:40:05+00:00")),
    ("2023-10-30T09:40:05.25-04:00", us("2023-10-30T13:40:05+00:00") + 250_000),
    ("2023-10-30T09:40:05.123456-04:00", us("2023-10-30T13:40:05+00:00") + 123_456),
    ("2023-10-30 09:40:05", us("2023-10-30T13:40:05+00:00")),
    ("2023-10-30T09:40", us("2023-10-30T13:40:00+00:00")),
    ("2023/10/30 09:40:05", us("2023-10-30T13:40:05+00:00")),
    ("10/30/2023 9:40 AM", us("2023-10-30T13:40:00+00:00")),
    ("10/30/2023 12:05 AM", us("2023-10-30T04:05:00+00:00")),
    ("10/30/2023 12:05 PM", us("2023-10-30T16:05:00+00:00")),
    ("20231030T094005-0400", us("2023-10-30T13:40:05+00:00")),
    ("Mon, 30 Oct 2023 09:40:05 -0400", us("2023-10-30T13:40:05+00:00")),
    ("30 Oct 2023 09:40:05 PDT", us("2023-10-30T16:40:05+00:00")),
    ("2023年10月30日 09:40", us("2023-10-30T13:40:00+00:00")),
    ("1698673205", us("2023-10-30T13:40:05+00:00")),
    ("1698673205123", us("2023-10-30T13:40:05+00:00") + 123_000),
    ("2023-11-05 01:30:00", us("2023-11-05T05:30:00+00:00")),  # twice: the earlier
    ("2024-03-10 02:30:00", us("2024-03-10T07:00:00+00:00")),  # never: first moment after the gap
    ("2024-03-10T02:30:00-05:00", us("2024-03-10T07:30:00+00:00")),
    ("1999-01-01T00:00:00-08:00", None),
    ("1999-01-01 00:00:00-0800", None),
    ("1999-01-01T08:00:00Z", None),
    ("0000-00-00T00:00:00-05:00", None),
    ("2023-13-40T10:00:00-05:00", None),
    ("2023-10-31T25:00:02-07:00", None),
    ("2023-02-30 10:00:00", None),
    ("30 Foo 2023 09:40:05 PDT", None),
    ("30 Oct 2023 09:40:05 QQQ", None),
    ("09:40", None),
    ("NaT", None),
    ("", None),
    ("   ", None),
    (None, None),
    ("x" * 100_000, None),
]


def test_notations(spark):
    rows = spark.createDataFrame([(i, t, "kept") for i, (t, _) in enumerate(CASES)], "i int, t string, t_us string").withColumn("__t", F.lit(1))
    got = {r["i"]: r["t_us"] for r in with_instant(rows, "t", F.lit("America/New_York"), "t").collect()}
    assert {i: got[i] for i in got if got[i] != CASES[i][1]} == {}
    assert "__t" in with_instant(rows, "t", F.lit("UTC"), "t").columns


def test_bare_clock_times_belong_to_their_date(spark):
    rows = spark.createDataFrame([(1, "8:00am"), (2, "0100"), (3, " 12:30 AM"), (4, "26:75"), (5, "21:30:00"), (6, "05:59"), (7, "06:00")], "i int, t string")
    day = F.lit("2023-11-04").cast("date")
    got = {r["i"]: r["t_us"] for r in with_instant(rows, "t", F.lit("Asia/Tokyo"), "t", base_date=day).collect()}
    base = us("2023-11-03T15:00:00+00:00")  # midnight in Tokyo
    hour = 3_600_000_000
    assert got == {1: base + 8 * hour, 2: base + 25 * hour, 3: base + 24 * hour + hour // 2, 4: None, 5: base + 21 * hour + hour // 2, 6: base + 30 * hour - 60_000_000, 7: base + 6 * hour}


def test_slashed_dates_day_first(spark):
    rows = spark.createDataFrame([("10/11/2023 9:40 AM",)], "t string")
    got = with_instant(rows, "t", F.lit("UTC"), "t", day_first=F.lit(True)).first()["t_us"]
    assert got == us("2023-11-10T09:40:00+00:00")


def test_local_times_equal_a_search_over_instants(spark):
    """Every quarter hour of the days around the changes, in three zones, against a scan of all instants."""
    zones = ["America/New_York", "Australia/Lord_Howe", "Asia/Tokyo"]
    days = [datetime(2023, 11, 4), datetime(2024, 3, 9), datetime(2024, 4, 6), datetime(2024, 10, 5)]
    rows, expected = [], {}
    for z, zone in enumerate(zones):
        info = ZoneInfo(zone)
        for day in days:
            first = (day - timedelta(days=1)).replace(tzinfo=UTC)
            seen: dict[datetime, datetime] = {}
            for k in range(5 * 288):
                at = first + timedelta(minutes=5 * k)
                seen.setdefault(at.astimezone(info).replace(tzinfo=None), at)
            for k in range(0, 3 * 96):
                wall = day + timedelta(minutes=15 * k)
                at = seen.get(wall) or min(v for w, v in seen.items() if w > wall and w - wall < timedelta(hours=3))
                key = len(rows)
                rows.append((key, z, int(wall.replace(tzinfo=UTC).timestamp()) * 1_000_000))
                expected[key] = int(at.timestamp()) * 1_000_000
    frame = spark.createDataFrame(rows, "k int, z int, w bigint").withColumn("zone", F.get(F.array(*map(F.lit, zones)), "z"))
    got = {r["k"]: r["u"] for r in frame.select("k", instant_of_wall(F.col("w"), F.col("zone")).alias("u")).collect()}
    assert {k: (rows[k], got[k], expected[k]) for k in expected if got[k] != expected[k]} == {}


@pytest.mark.parametrize(
    ("ambiguous", "nonexistent", "twice", "never"),
    [("later", "shift", "2023-11-05T06:30:00+00:00", "2024-03-10T07:30:00+00:00"), ("null", "null", None, None)],
)
def test_other_policies(spark, ambiguous, nonexistent, twice, never):
    walls = spark.createDataFrame([(us("2023-11-05T01:30:00+00:00"),), (us("2024-03-10T02:30:00+00:00"),), (us("2024-06-01T12:00:00+00:00"),)], "w bigint")
    got = [r[0] for r in walls.select(instant_of_wall(F.col("w"), F.lit("America/New_York"), ambiguous, nonexistent)).collect()]
    assert got == [us(twice) if twice else None, us(never) if never else None, us("2024-06-01T16:00:00+00:00")]


def test_unknown_policies_are_refused(spark):
    for bad in ({"ambiguous": "x"}, {"nonexistent": "x"}):
        with pytest.raises(ValueError):
            instant_of_wall(F.lit(0), F.lit("UTC"), **bad)


def test_exact_form(spark):
    texts = ["2023-10-30T09:40:05-04:00", " 2023-10-30T09:40:05-04:00", "2023-10-30T09:40:05Z", "2023-10-30t09:40:05-04:00", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(is_exact(F.col("t"))).collect()]
    assert got == [True, False, False, False, False]
