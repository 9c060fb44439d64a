"""Hand-computed cases of the wait-time operators."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from queuescope.functions import calendar, clean, parse, temporal
from queuescope.functions.codes import park_date_of, park_of, zone_of_park
from queuescope.operators import aggregates, curves, dedupe, features, flat_hours, model, reports, versions


def column(spark, values, kind, expression):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"x {kind}").select(expression(F.col("x"))).collect()]


def test_codes(spark):
    codes = ["MK101", " tdl7", "USH9", "\tush1", "zz5", "", None]
    assert column(spark, codes, "string", park_of) == ["mk", "tdl", "uh", "uh", "zz", "", ""]
    assert column(spark, ["dl", "TDS ", "xx", None], "string", zone_of_park) == ["America/Los_Angeles", "Asia/Tokyo", "America/New_York", "America/New_York"]


def test_park_date_turns_at_six_on_the_wall_clock(spark):
    hour = 3_600_000_000
    midnight = 1_710_046_800 * 1_000_000  # 2024-03-10 00:00 in New York, the night of the change
    instants = [midnight + 30 * 60 * 1_000_000, midnight + 5 * hour - 60_000_000, midnight + 5 * hour, midnight + 23 * hour + hour // 2, midnight + 29 * hour]
    got = column(spark, instants, "bigint", lambda x: park_date_of(x, F.lit("America/New_York")))
    assert got == [date(2024, 3, 9), date(2024, 3, 9), date(2024, 3, 10), date(2024, 3, 10), date(2024, 3, 11)]


def test_clock_functions(spark):
    assert column(spark, ["09:05", "24:00", "9:60", "x", None, "23:59:59"], "string", temporal.clock_minutes) == [545, None, None, None, None, 1439]
    assert column(spark, [0, 59, 1443, 725], "bigint", temporal.slot_label) == ["00:00", "00:55", "00:00", "12:05"]
    assert column(spark, [12.5, 7.5, 17.5, None], "double", temporal.display_posted) == [10, 10, 20, None]
    assert column(spark, [0.5, 1.5, -0.5], "double", temporal.display_actual) == [0, 2, 0]
    assert column(spark, [-3.0, 4.0, None], "double", temporal.not_negative) == [0.0, 4.0, None]
    assert column(spark, [0, 6 * 60, 6 * 60 - 1], "bigint", lambda m: temporal.minutes_since_start_of_day(m * 60_000_000)) == [1080, 0, 1439]


def test_standby_and_priority_rows(spark):
    wide = spark.createDataFrame([(1, None, None), (2, "0", "1000"), (3, "1001", "-1"), (4, "12.5", "x"), (5, "nan", "7")], "id int, submitted_posted_time string, submitted_actual_time string")
    assert {tuple(r) for r in parse.unpivot_standby(wide).collect()} == {(2, "POSTED", 0), (2, "ACTUAL", 1000), (4, "POSTED", 12), (5, "ACTUAL", 7)}
    rows = [
        (2023, 5, 3, 1330, None, 1400, None, 30),
        (2023, 5, 3, 133059, None, 1320, None, -10),
        (2023, 5, 3, 1330, None, 1310, None, 1420),
        (2023, 5, 3, 13, 30, 14, 5, 35),
        (2023, 5, 3, 1330, None, 8888, None, 8888),
        (2023, 2, 30, 1330, None, 1400, None, None),
        (2023, 5, 3, 2350, None, 10, None, 610),
        (2023, 5, 3, 99, None, 1400, None, 840 - 23 * 60 + 1440),
    ]
    frame = spark.createDataFrame([r[:7] for r in rows], "y int, m int, d int, o int, om int, r int, rm int")
    assert [r[0] for r in frame.select(parse.priority_minutes(*[F.col(c) for c in frame.columns])).collect()] == [r[7] for r in rows]


def test_validity_borders(spark):
    cases = [("POSTED", "300", True, True), ("POSTED", "1000", True, True), ("POSTED", "1001", False, True), ("ACTUAL", "299", True, False), ("PRIORITY", "-100", True, False), ("PRIORITY", "-101", False, True),
             ("PRIORITY", "2000", True, False), ("PRIORITY", "2001", False, True), ("PRIORITY", "8888", True, False), ("OTHER", "5", False, True), ("POSTED", "5.5", False, True), ("POSTED", None, False, True)]
    frame = spark.createDataFrame([c[:2] for c in cases], "k string, v string")
    assert [tuple(r) for r in frame.select(*parse.validity(F.col("k"), F.col("v"))).collect()] == [c[2:] for c in cases]


def test_file_kinds(spark):
    paths = ["x/wait_times/wdw/a.csv", "x/fastpass_times/tdr/f_2018_03.csv", "x/fastpass_times/dlr/f_2019_05.csv", "x/other.csv"]
    assert column(spark, paths, "string", parse.file_kind) == ["Standby", "Old Fastpass", "New Fastpass", "Unknown"]
    assert column(spark, paths[:3], "string", parse.zone_of_path) == ["America/New_York", "Asia/Tokyo", "America/Los_Angeles"]


def test_calendar(spark):
    easters = {2005: (3, 27), 2008: (3, 23), 2011: (4, 24), 2019: (4, 21), 2024: (3, 31), 2038: (4, 25), 2049: (4, 18), 1981: (4, 19)}
    assert column(spark, list(easters), "int", calendar.easter) == [date(y, *md) for y, md in easters.items()]
    days = calendar.with_date_group(calendar.with_holidays(calendar.date_spine(spark, "2021-01-01", "2024-12-31")))
    got = {str(r["park_date"]): (r["holidaycode"], r["date_group_id"]) for r in days.collect()}
    assert len(got) == 1461
    assert got["2021-02-15"][0] == "PMP" and got["2021-02-16"] == ("PMM", "MARDI_GRAS_WITH_PRESIDENTS_DAY")
    assert got["2024-11-05"] == ("NJC", "JERSEY_WEEK_TUE") and got["2024-12-27"] == ("NONE", "DEC27")
    assert got["2024-03-28"][1] == "BEFORE_EASTER_MAR_WEEK4OR5_THU" and got["2024-04-02"][1] == "AFTER_EASTER_APR_WEEK1_TUE" and got["2024-03-29"][0] == "GFR"
    seasons = {str(r["park_date"]): r["season_year"] for r in calendar.with_season(days).collect()}
    assert seasons["2024-02-19"] == "PRESIDENTS_DAY_MARDI_GRAS_2024" and seasons["2024-01-01"] == "CHRISTMAS_PEAK_2023" and seasons["2022-07-10"] == "SUMMER_2022"
    assert "" not in {s.rsplit("_", 1)[0] for s in seasons.values()}


def test_cleaners(spark):
    assert column(spark, [" a ", "", "nan", None], "string", lambda c: clean.text(c, "upper")) == ["A", None, None, None]
    assert column(spark, ["Yes", " T", "0", "maybe", None], "string", clean.flag) == [True, True, False, False, False]
    assert column(spark, ["0", "2.0", "x", None], "string", clean.number_flag) == [False, True, False, False]
    assert column(spark, ["2020-01-02", "01/02/2020", "2020/01/02", "25/12/2020", "x", None], "string", clean.date) == [date(2020, 1, 2)] * 3 + [date(2020, 12, 25), None, None]
    frame = spark.createDataFrame([(1, 2)], " Code  int, park int")
    named = clean.rename_if_absent(clean.normal_headers(frame), {"code": "entity_code", "park": "code"})
    assert named.columns == ["entity_code", "code"] and clean.first_present(named, ["x", "code"]) == "code"
    assert clean.ensure_column(named, "land").columns[-1] == "land"


def test_keep_and_index(spark):
    rows = spark.createDataFrame([(1, "a", 5), (2, "a", 6), (3, None, 7), (4, None, 8)], "seq int, k string, v int")
    assert {tuple(r) for r in dedupe.keep_best(rows, ["k"], F.col("seq")).collect()} == {(1, "a", 5), (3, None, 7)}
    assert {tuple(r) for r in dedupe.keep_best(rows, ["k"], F.col("seq"), last=True).collect()} == {(2, "a", 6), (4, None, 8)}
    schema = "entity_code string, park_date date, observed_us bigint, wait_time_type string"
    one = spark.createDataFrame([("MK101", date(2026, 1, 25), 50, "POSTED"), ("EP09", date(2026, 1, 24), 20, "ACTUAL")], schema)
    late = spark.createDataFrame([("MK101", date(2026, 1, 23), 10, "POSTED")], schema)
    merged = {r["entity_code"]: r for r in dedupe.upsert_index(dedupe.entity_index(one), dedupe.entity_index(late)).collect()}
    assert (merged["MK101"]["row_count"], merged["MK101"]["latest_observed_us"], merged["MK101"]["first_seen_us"]) == (2, 50, 10)
    modeled = spark.createDataFrame([("EP09", 20)], "entity_code string, last_modeled_us bigint")
    index = dedupe.entity_index(one)
    assert [r["entity_code"] for r in dedupe.needs_modeling(index, modeled).collect()] == ["MK101"]
    assert dedupe.needs_modeling(index, modeled, as_of_us=60, min_age_us=20).count() == 0


def test_weighted_median_equals_definition(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.randrange(20), rng.choice([None, 0.0, 1.0, 2.5, 0.5])) for _ in range(300)] + [("c", 7, 1.0), ("n", None, 1.0)]
    got = {r[0]: r[1] for r in aggregates.weighted_median(spark.createDataFrame(rows, "k string, v int, w double"), ["k"], "v", "w").collect()}
    for k in "abc":
        own = sorted((v, w) for kk, v, w in rows if kk == k and w and v is not None)
        total, cum = sum(w for _, w in own), 0.0
        for v, w in own:
            cum += w
            if cum >= total / 2 - 1e-9:
                assert got[k] == v
                break
    assert "n" not in got


def test_fallback_levels(spark):
    agg = spark.createDataFrame([("MK1", "G", 9, 10.0), ("MK1", "G", 10, 20.0), ("MK1", "H", 12, 40.0), ("MK2", "H", 14, 70.0)], "entity_code string, dategroupid string, hour bigint, posted_median double")
    wanted = spark.createDataFrame([(1, "MK1", "G", 9), (2, "MK1", "G", 20), (3, "MK1", "X", 12), (4, "MK1", "X", 20), (5, "MK9", "X", 14), (6, "EP1", "X", 14), (7, None, None, None)], "i int, entity_code string, dategroupid string, hour bigint")
    got = {r["i"]: (r["predicted"], r["level"]) for r in aggregates.fallback_lookup(wanted, agg).collect()}
    assert got == {1: (10.0, 1), 2: (15.0, 2), 3: (40.0, 3), 4: (20.0, 4), 5: (70.0, 5), 6: (None, None), 7: (None, None)}


def test_slots(spark):
    rows = spark.createDataFrame([(1, 540, 1320), (2, 543, 660), (3, 1080, 120), (4, 600, 600), (5, None, 10)], "i int, opening_minute bigint, closing_minute bigint")
    grid: dict[int, list] = {}
    for r in curves.slot_grid(rows).orderBy("i", "slot_minute").collect():
        grid.setdefault(r["i"], []).append(r["time_slot"])
    assert len(grid[1]) == 157 and grid[1][0] == "09:00" and grid[1][-1] == "22:00"
    assert grid[2][:3] == ["09:03", "09:08", "09:13"] and grid[2][11:14] == ["09:58", "10:00", "10:05"] and grid[2][-1] == "11:00"
    assert grid[3][0] == "18:00" and grid[3][-1] == "02:00" and len(grid[3]) == 97
    assert grid[4] == ["10:00"] and 5 not in grid


def test_index_keeps_empty_slots(spark):
    grid = spark.createDataFrame([("mk", "d", "09:00"), ("mk", "d", "09:05")], "park_code string, park_date string, time_slot string")
    back = spark.createDataFrame([("A", "mk", "d", "09:00", 10.0), ("B", "mk", "d", "09:00", None)], "entity_code string, park_code string, park_date string, time_slot string, actual double")
    fore = spark.createDataFrame([("A", "mk", "d", "09:00", 99.0), ("B", "mk", "d", "09:00", 20.0)], "entity_code string, park_code string, park_date string, time_slot string, actual_predicted double")
    curve = curves.coalesce_curves(back, fore, ["entity_code", "park_code", "park_date", "time_slot"])
    got = {r["time_slot"]: (r["wti"], r["n_entities"], r["min_actual"], r["max_actual"]) for r in curves.wait_index(grid, curve).collect()}
    assert got == {"09:00": (15.0, 2, 10.0, 20.0), "09:05": (None, 0, None, None)}


def test_versions_as_of(spark):
    schema = "park string, version_id bigint, version_type string, valid_from_us bigint, valid_until_us bigint, created_us bigint, o int"
    rows = [("mk", 1, "official", 0, 10, 0, 1), ("mk", 2, "predicted", 0, None, 9, 2), ("mk", 3, "official", 30, None, 30, 3), ("mk", 4, "predicted", 0, None, 9, 4)]
    wanted = spark.createDataFrame([("mk", 5), ("mk", 10), ("mk", 30), ("dl", 5)], "park string, at bigint")
    got = {(r["park"], r["at"]): r["version_id"] for r in versions.as_of(wanted, spark.createDataFrame(rows, schema), ["park"], "at").collect()}
    assert got == {("mk", 5): 1, ("mk", 10): 4, ("mk", 30): 3, ("dl", 5): None}


def test_best_donor_equals_search(spark):
    rng = random.Random(4)
    start = date(2020, 1, 1)
    donors = list({(rng.choice("ab"), start + timedelta(days=rng.randrange(900))): rng.choice("xyz") for _ in range(60)}.items())
    targets = [("a", start + timedelta(days=d), g) for d, g in ((0, "x"), (400, "y"), (950, "z"), (500, "q"))]
    schema = "park_code string, park_date date, date_group_id string"
    got = {(r["park_code"], r["park_date"]): r["donor_date"] for r in versions.best_donor(spark.createDataFrame(targets, schema), spark.createDataFrame([(p, d, g) for (p, d), g in donors], schema)).collect()}
    for park, day, group in targets:
        past = [(1.0 if g == group else 0.7) / (1 + (day - d).days / 365) for (p, d), g in donors if p == park and d < day]
        best = got[park, day]
        assert (best is None) == (not past)
        if past:
            own = next((1.0 if g == group else 0.7) / (1 + (day - d).days / 365) for (p, d), g in donors if p == park and d == best)
            assert own == pytest.approx(max(past))


def test_encodings_and_split(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "k string")
    mapping = features.label_mapping(train, "k")
    rows = spark.createDataFrame([("c",), ("z",), (None,), ("y",)], "k string")
    assert {r["k"]: r["k_code"] for r in features.label_encode(rows, "k", mapping).collect()} == {"c": 2, "z": None, None: None, "y": None}
    assert {r["k"]: r["k_code"] for r in features.label_encode(rows, "k", mapping, "encode").collect()} == {"c": 2, "y": 3, "z": 4, None: None}
    with pytest.raises(Exception, match="unknown value"):
        features.label_encode(rows, "k", mapping, "error").collect()
    numbers = spark.createDataFrame([(1,), (None,)], "n int")
    assert [tuple(r) for r in features.one_hot(numbers, "n", ["1", "2"]).collect()] == [(1, 1, 0), (None, 0, 0)]
    days = spark.createDataFrame([(date(2024, 1, 1) + timedelta(days=i // 2),) for i in range(20)], "d date")
    counts = {r["split"]: r["count"] for r in features.chronological_split(days, "d").groupBy("split").count().collect()}
    assert counts == {"train": 14, "validation": 2, "test": 4}


def test_metrics(spark):
    rows = spark.createDataFrame([("a", 0.0, 1.0), ("a", 10.0, 8.0), ("c", 5.0, 5.0), ("c", 5.0, 6.0), ("a", None, 3.0)], "k string, y double, p double")
    got = {r["k"]: r for r in reports.error_metrics(rows, ["k"], "y", "p").collect()}
    assert got["a"]["n"] == 2 and got["a"]["mae"] == 1.5 and got["a"]["mape"] == 20.0 and got["a"]["r2"] == pytest.approx(1 - 5 / 50)
    assert got["c"]["r2"] is None
    assert column(spark, [-1.0, 0.0, 0.3, 5.0, None], "double", lambda x: reports.bin_label(x, [0, 0.3, 0.5])) == [None, 0, 1, 2, None]


def test_models(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "entity_code string, wait_time_minutes double")
    assert {r["entity_code"]: r["prediction"] for r in model.mean_models(rows).collect()} == {"a": 2.0, "b": 0.0}
    rng = random.Random(1)
    data = [(float(x), 40.0 if x > 5 else 10.0, "validation" if rng.random() < 0.2 else "train") for x in [rng.randrange(10) for _ in range(300)]]
    frame = spark.createDataFrame(data, "x double, y double, split string")
    fitted = model.fit_boosted(frame, ["x"], "y", rounds=5, depth=2)
    got = {r["x"]: r["prediction"] for r in model.predict(fitted, spark.createDataFrame([(1.0,), (9.0,), (None,)], "x double"), ["x"]).collect()}
    assert got[1.0] < 25 < got[9.0] and got[0.0] < 25


def test_flat_hours(spark):
    schema = "park_code string, park_date string, opening_time string, closing_time string, opening_time_with_emh string, closing_time_with_emh_or_party string, emh_morning string, emh_evening string"
    rows = [(" mk", "2024-01-01 ", "09:00", " ", None, None, "1.0", None), ("mk", "2024-01-02", "09:00", "22:00", "", "23:00", "0", "x")]
    got = flat_hours.clean_hours(spark.createDataFrame(rows, schema)).collect()
    default = "1999-01-01T00:00:00-08:00"
    assert (got[0]["park_code"], got[0]["closing_time"], got[0]["opening_time_with_emh"], got[0]["closing_time_with_emh_or_party"], got[0]["emh_morning"]) == ("MK", default, default, default, True)
    assert (got[1]["opening_time_with_emh"], got[1]["closing_time_with_emh_or_party"], got[1]["emh_evening"]) == ("09:00", "23:00", False)
    assert [str(x) for x in column(spark, ["Donor: MK 2024-01-05", "Donor: MK", None], "string", flat_hours.donor_date_of)] == ["2024-01-05", "None", "None"]


def test_horizon_is_filled_from_donors(spark):
    known = spark.createDataFrame([("mk", date(2024, 1, 1), "A", 540, 1300), ("mk", date(2024, 1, 20), "B", 600, 1200), ("dl", date(2024, 3, 1), "A", 480, 1000)], "park_code string, park_date date, date_group_id string, opening_minute int, closing_minute int")
    dates = spark.createDataFrame([(date(2024, 2, 1), "A"), (date(2024, 2, 2), "Z")], "park_date date, date_group_id string")
    got = {(r["park_code"], str(r["park_date"])): (str(r["donor_date"]), r["opening_minute"], r["notes"]) for r in flat_hours.fill_horizon(dates, known).collect()}
    assert got == {("mk", "2024-02-01"): ("2024-01-01", 540, "Donor: mk 2024-01-01"), ("mk", "2024-02-02"): ("2024-01-20", 600, "Donor: mk 2024-01-20")}
    assert flat_hours.to_versions(known, 5).where("valid_until_us IS NULL AND version_type = 'official'").count() == 3
