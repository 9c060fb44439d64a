"""Curves, accuracy, medians, names and the model pair on small tables."""

from __future__ import annotations

import random
from datetime import date
from statistics import median

import pytest
from pyspark.sql import functions as F

from queuescope.functions.codes import zone_of_park
from queuescope.functions.names import display_name, truthy, with_properties
from queuescope.operators import curves, model
from queuescope.operators.aggregates import exact_medians
from queuescope.operators.reports import error_metrics, half_open

MINUTE = 60_000_000
#: Local 09:00 of the day in New York.
NINE = 1_704_722_400_000_000
DAY = date(2024, 1, 8)


def _readings(spark, rows):
    return spark.createDataFrame([(i, "MK1", "MK", DAY, NINE + at * MINUTE, kind, v) for i, (at, kind, v) in enumerate(rows)], "ingest_seq long, entity string, park string, park_day date, observed_us long, kind string, minutes long")


def _slots(spark, readings, opening=540, closing=600):
    days = spark.createDataFrame([("MK", DAY, opening, closing)], "park string, park_day date, opening_minute long, closing_minute long")
    return curves.slots_of(readings, days, zone_of_park(F.col("park")))


def test_slots_take_the_readings_within_their_tolerances(spark):
    readings = _readings(spark, [(8, "POSTED", 20), (40, "POSTED", 50), (14, "ACTUAL", 7), (25, "ACTUAL", None), (31, "POSTED", None)])
    got = {r["time_slot"]: (r["posted"], r["actual"]) for r in curves.slot_observations(_slots(spark, readings), readings).collect()}
    assert len(got) == 13
    # the next posted time counts within ten minutes, and the one before not at all while another is still to come
    assert (got["09:00"], got["09:05"], got["09:10"], got["09:25"]) == ((20, None), (20, None), (None, 7), (None, None))
    assert (got["09:15"], got["09:30"], got["09:40"]) == ((None, 7), (50, None), (50, None))
    # after the last one it counts for 15 minutes
    assert (got["09:55"], got["10:00"]) == ((50, None), (None, None))


def test_backfill_uses_the_model_only_beside_a_posted_time(spark):
    readings = _readings(spark, [(8, "POSTED", 20), (14, "ACTUAL", 7)])
    seen = curves.slot_observations(_slots(spark, readings), readings)
    got = {r["time_slot"]: (r["actual"], r["source"]) for r in curves.backfill_curve(seen, lambda s: s.withColumn("prediction", F.lit(-3.0))).collect()}
    assert got["09:05"] == (0.0, "imputed")
    assert got["09:10"] == (7.0, "observed")
    assert got["09:30"] == (None, "imputed")


def test_forecast_keeps_slots_with_either_value(spark):
    readings = _readings(spark, [(0, "POSTED", 20)])
    groups = spark.createDataFrame([(DAY, "G")], "park_day date, dategroupid string")
    aggregates = spark.createDataFrame([("MK1", "G", 9, 23)], "entity_code string, dategroupid string, hour long, posted_median long")
    late = _slots(spark, readings, 1380, 60)
    none = curves.forecast_curve(late, aggregates.where("hour = 1"), groups, lambda s: s.withColumn("prediction", F.lit(None).cast("double"))).collect()
    assert none == []
    got = {r["time_slot"]: (r["actual_predicted"], r["posted_predicted"]) for r in curves.forecast_curve(late, aggregates, groups, lambda s: s.withColumn("prediction", F.lit(11.5))).collect()}
    assert len(got) == 25
    assert got["23:00"] == got["01:00"] == (12, 25)


def test_curves_with_the_boosted_pair(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        at = rng.randrange(0, 600)
        wait = 10 + at // 20
        rows += [(at, "POSTED", wait), (at + 1, "ACTUAL", wait - 4)]
    readings = _readings(spark, rows)
    minute = ((F.col("observed_us") - F.lit(NINE)) / MINUTE).alias("minute")
    training = model.training_set(readings, readings.select("ingest_seq", minute), ["minute"]).withColumn("split", F.when(F.pmod(F.xxhash64("ingest_seq"), F.lit(5)) == 0, "validation").otherwise("train"))
    assert training.where("posted is null").count() == 0
    pair = model.fit_pair(training, ["minute"], "observed_wait_time", rounds=20, depth=3)
    error = model.predict(pair["with_posted"], training, ["minute", "posted"]).agg(F.avg(F.abs(F.col("prediction") - F.col("observed_wait_time")))).first()[0]
    mean = training.agg(F.avg("observed_wait_time")).first()[0]
    flat = training.agg(F.avg(F.abs(F.col("observed_wait_time") - mean))).first()[0]
    assert error < 0.35 * flat
    model.save_model(pair["without_posted"], str(tmp_path / "m"), {"model_type": "boosted"})
    loaded, metadata = model.load_model(str(tmp_path / "m"))
    assert metadata == {"model_type": "boosted"}
    a, b = (model.predict(m, training, ["minute"]).select(F.sum("prediction")).first()[0] for m in (pair["without_posted"], loaded))
    assert a == pytest.approx(b)
    slots = curves.slot_observations(_slots(spark, readings, 540, 1140), readings.where("kind = 'POSTED' OR minutes < 20"))
    predict = lambda s: model.predict(pair["with_posted"], s.withColumn("minute", (F.col("at_us") - F.lit(NINE)) / MINUTE), ["minute", "posted"])
    curve = curves.backfill_curve(slots, predict).collect()
    assert len(curve) == 121
    assert {r["source"] for r in curve} == {"observed", "imputed"}
    priority = training.withColumn("wait_time_type", F.lit("PRIORITY"))
    assert model.fit_pair(priority, ["minute"], "observed_wait_time", rounds=2, depth=2)["with_posted"] is None


def test_batches_are_isolated(spark):
    entities, failures = spark.range(20).select(F.concat(F.lit("E"), "id").alias("entity_code")), []

    def train(part):
        if part.where("entity_code = 'E3'").count():
            raise ValueError("broken")
        return part

    done = model.train_in_batches(entities, train, 4, lambda k, error: failures.append(k))
    assert len(failures) == 1
    assert sum(f.count() for f in done) == 20 - entities.where(F.pmod(F.xxhash64("entity_code"), F.lit(4)) == failures[0]).count()


def test_exact_medians(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.random(), 0.5, float("nan"), None])) for _ in range(3000)] + [("one", 4.0), ("two", 1.0), ("two", 2.0), ("none", None)]
    frame = spark.createDataFrame(rows, "k string, v double")
    want = {}
    for k, v in rows:
        if v is not None and v == v:
            want.setdefault(k, []).append(v)
    for accuracy in (20, 10_000):
        got = {r["k"]: r["median"] for r in exact_medians(frame, ["k"], "v", accuracy=accuracy).collect()}
        assert got == {k: pytest.approx(median(v)) for k, v in want.items()}
        assert exact_medians(frame, [], "v", accuracy=accuracy).first()[0] == pytest.approx(median([x for v in want.values() for x in v]))
    assert exact_medians(frame.where("false"), ["k"], "v").count() == 0
    metrics = error_metrics(frame.where("k is null").withColumn("p", F.lit(1.0)), ["k"], "v", "p").collect()
    assert len(metrics) == 1


def test_names_and_bins(spark):
    entities = spark.createDataFrame([(" mk1", "Mountain ", "Y"), ("MK1", "Zebra", "n"), ("EP2", " ", "0"), (None, "x", "1")], "entity_code string, short_name string, fastpass_booth string")
    seen = spark.createDataFrame([("Mk1", "old"), ("ep2", "old"), ("zz", "old"), (None, "old")], "entity_code string, short_name string")
    rows = with_properties(seen, entities, ["short_name", "fastpass_booth"])
    got = {r[0]: (r[1], r[2]) for r in rows.select("entity_code", display_name(F.col("entity_code"), F.col("short_name")), truthy(F.col("fastpass_booth"))).collect()}
    assert got == {"Mk1": ("Mk1 - Mountain", True), "ep2": ("ep2", False), "zz": ("zz", False), None: ("", False)}
    values = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 0.5, 0.99, 1.0, None)], "x double")
    assert [r[0] for r in values.select(half_open(F.col("x"), [0.0, 0.5, 1.0], False)).collect()] == [None, "0.0-0.5", "0.5-1.0", "0.5-1.0", None, None]
    assert [r[0] for r in values.select(half_open(F.col("x"), [0, 1])).collect()] == [None, "0-1", "0-1", "0-1", "1+", None]
