"""Fills, histories and as-known hours."""

from __future__ import annotations

import random
from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from queuescope.operators.fill import fill_hours
from queuescope.operators.history import change_history, hours_history, snapshot_history
from queuescope.operators.hours import usable_hours, with_hours_instants
from queuescope.operators.known import hours_as_known

SCHEMA = (
    "hours_id long, park_date string, park_code string, version_type string, version_id string, source string, created_at timestamp, valid_from timestamp, valid_until timestamp, "
    "opening_time string, closing_time string, emh_morning boolean, emh_evening boolean, confidence double, change_probability double, notes string"
)
T0 = datetime(2023, 10, 1, tzinfo=UTC)


def row(i, date="2023-10-30", park="MK", kind="official", source="s3_sync", created=0, valid=0, opening="09:00", closing="22:00", morning=False, evening=False):
    at = [None if x is None else T0 + timedelta(hours=x) for x in (created, valid)]
    return (i, date, park, kind, f"v{i}", source, *at, None, opening, closing, morning, evening, None, None, None)


def test_fills_have_method_and_distance(spark):
    rows = [
        row(1, "2023-10-30", opening="09:00"),
        row(2, "2023-10-31", opening="26:75", source="unknown"),
        row(3, "2023-11-03", opening="10:00"),
        row(4, "2023-12-30", opening="1999-01-01T00:00:00-08:00", source=None),
        row(5, None, park=None, opening=None, closing=" ", source=""),
        row(6, "2023-10-30", park="DL", kind="final", opening="TBD", closing="closed?", source="nan"),
        row(6, "2023-10-30", park="DL", kind="final", opening="TBD", closing="closed?", source="nan"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("zone", F.lit("clash")).withColumn("opening_us", F.lit("clash"))
    got = {r["hours_id"]: r for r in fill_hours(with_hours_instants(frame)).collect()}
    assert (got[1]["opening_minute"], got[1]["opening_minute_method"], got[1]["opening_minute_distance"]) == (540, "observed", 0)
    assert (got[2]["opening_minute"], got[2]["opening_minute_method"], got[2]["opening_minute_distance"]) == (555, "interpolated", 1)
    assert (got[2]["source_filled"], got[2]["source_filled_method"]) == ("s3_sync", "carried")
    assert (got[4]["opening_minute"], got[4]["opening_minute_method"]) == (570, "group")
    assert got[5]["source_filled_method"] == "none" or got[5]["source_filled"] is not None
    assert got[6]["opening_minute_method"] == "none" and got[6]["opening_minute"] is None
    assert with_hours_instants(frame).count() == 7 and fill_hours(with_hours_instants(spark.createDataFrame([], SCHEMA))).count() == 0


def _plain_history(rows):
    begins, closed = {}, {}
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        before, last = object(), None
        for r in own:
            if r[3:] != before:
                begins[r[2]] = None
                if last is not None:
                    closed[last] = r[2]
                last = r[2]
            before = r[3:]
    return {i: closed.get(i) for i in begins}


def test_history_equals_plain_walk(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(40), i, rng.choice([1, 2, None]), rng.choice([True, False])) for i in range(300)]
    frame = spark.createDataFrame(rows, "k string, at bigint, id bigint, x int, y boolean")
    for size in (7, 10_000):
        out = change_history(frame, ["k"], ["at", "id"], F.floor(F.col("at") / 9), ["x", "y"], "id", "at", lead_block=size)
        assert {r["id"]: r["closed_by"] for r in out.collect()} == _plain_history(rows)


def test_snapshots_equal_plain_walk(spark):
    rng = random.Random(6)
    shown = {}  # (time, key) -> attributes
    for at in range(5, 75, 10):
        for key in ("a", "b", "c", None):
            if rng.random() < 0.7:
                shown[at, key] = (rng.choice([1, None]), rng.choice([True, False]))
    rows = [(k, at, *v) for (at, k), v in shown.items()]
    frame = spark.createDataFrame([*rows, rows[0], ("a", None, 1, True)], "k string, at bigint, x int, y boolean")
    want, times = [], sorted({at for at, _ in shown})
    for key in ("a", "b", "c", None):
        before = None
        for at in times:
            now = shown.get((at, key))
            if now != before:
                if before is not None:
                    want[-1][3] = at
                if now is not None:
                    want.append([key, "inserted" if before is None else "changed", at, None, *now])
            before = now
    for size in (2, 10_000):
        got = [[r["k"], r["change"], r["valid_from"], r["valid_until"], r["x"], r["y"]] for r in snapshot_history(frame, ["k"], "at", ["x", "y"], size).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert snapshot_history(frame.where("k = 'none'"), ["k"], "at", ["x", "y"]).count() == 0


def test_hours_history_ignores_repeats_and_null_flags(spark):
    rows = [row(1), row(2, valid=5, morning=None), row(3, valid=9, opening="9:00 AM"), row(4, valid=12, closing="23:00"), row(5, valid=20, closing="nan"), row(6, valid=30), row(7, park=" mk ", valid=40, evening=True)]
    hours = usable_hours(with_hours_instants(spark.createDataFrame(rows, SCHEMA)))
    got = {r["hours_id"]: (r["closed_by"], r["version_no"]) for r in hours_history(hours).collect()}
    assert got == {1: (4, 1), 4: (6, 2), 6: (7, 3), 7: (None, 4)}
    assert hours_history(hours.where(F.lit(False))).count() == 0


def test_as_known_equals_brute_force(spark):
    rng = random.Random(8)
    kinds = ["official", "final", "predicted", "historical", "draft"]
    hours = [row(i, rng.choice(["2023-10-02", "2023-10-03"]), rng.choice(["MK", "DL"]), rng.choice(kinds), created=rng.choice([None, *range(60)]), valid=rng.randrange(60)) for i in range(80)]
    events = [(i, rng.choice(["mk", "dl"]), int((T0 + timedelta(hours=rng.randrange(24, 72))).timestamp()) * 1_000_000) for i in range(200)] + [(900, "zz", 5), (901, "mk", None)]
    typed = usable_hours(with_hours_instants(spark.createDataFrame(hours, SCHEMA)))
    got = {r["ingest_seq"]: r["hours_id"] for r in hours_as_known(spark.createDataFrame(events, "ingest_seq long, park string, observed_us long"), typed).collect()}
    want = {}
    for i, park, us in events:
        if us is None:
            continue
        at = datetime.fromtimestamp(us / 1e6, UTC)
        local = at - timedelta(hours=4 if park == "mk" else 7)
        date = (local - timedelta(hours=6)).strftime("%Y-%m-%d")
        known = [h for h in hours if h[2].lower() == park and h[1] == date and h[6] is not None and h[6] <= at and h[7] <= at and h[3] != "draft"]
        if known:
            want[i] = min(known, key=lambda h: (kinds.index(h[3]), -h[7].timestamp(), -h[6].timestamp(), h[0]))[0]
    assert got == want and len(want) > 50
