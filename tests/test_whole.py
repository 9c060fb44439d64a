"""Queries cover their whole tables: compared with searches that leave nothing out."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from queuescope.operators import model
from queuescope.plans import hours_queries, problem_sql, reference

DATA = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the tables are not here")


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def test_best_donor_takes_every_date(spark, connection):
    dates = connection.execute("SELECT DISTINCT ['mk', 'ep', 'dl', 'tdl'][1 + o_custkey % 4] AS park, CAST(o_orderdate AS DATE) AS d, dayofyear(CAST(o_orderdate AS DATE)) // 9 AS g FROM orders").fetchall()
    got = {(r["park_code"], r["park_date"]): r for r in reference.QUERIES["q_best_donor"](spark, str(DATA)).collect()}
    assert set(got) == {(park, str(day)) for park, day, _ in dates}
    for park, day, group in dates:
        past = {str(d): (1.0 if g == group else 0.7) / (1 + (day - d).days / 365) for p, d, g in dates if p == park and d < day}
        best = got[park, str(day)]
        assert (best["donor_date"] is None) == (not past)
        if past:
            assert best["confidence"] == pytest.approx(max(past.values()), abs=1e-8)
            assert past[best["donor_date"]] == pytest.approx(best["confidence"], abs=1e-8)


def test_forecast_curve_covers_every_date(spark, connection):
    got = reference.QUERIES["q_forecast_curve"](spark, str(DATA)).select("entity", "park_date").distinct().collect()
    want = connection.execute(f"WITH {problem_sql.READINGS}, {hours_queries._PLACED} SELECT DISTINCT entity, CAST(day AS VARCHAR) FROM dated").fetchall()
    assert {tuple(r) for r in got} == set(want)


def test_boosted_model_trains_as_production(spark, monkeypatch):
    asked = {}

    def fit(training, features, target, **how):
        asked.update(how)
        raise InterruptedError

    monkeypatch.setattr(model, "fit_boosted", fit)
    with pytest.raises(InterruptedError):
        reference.QUERIES["q_boosted_model"](spark, str(DATA))
    assert (asked["rounds"], asked["depth"], asked.get("patience", 50)) == (2000, 6, 50)


def test_boosting_ends_after_the_best_validation_round(spark):
    assert model.best_round([3.0, 2.0, 2.5, 1.0, 1.5, 1.2, 0.5], 2) == (3, True)
    assert model.best_round([3.0, 2.0, 2.5, 1.0], 2) == (3, False)
    data = [(float(i % 5), float(i % 5 * 10), "train") for i in range(100)] + [(float(i), 50.0 - i * 10, "validation") for i in range(5)]
    frame = spark.createDataFrame(data, "x double, y double, split string").coalesce(1).cache()
    whole = model.fit_boosted(frame.where("split = 'train'"), ["x"], "y", rounds=6, depth=2)
    assert whole.stages[-1].getNumTrees == 6
    errors = whole.stages[-1].evaluateEachIteration(whole.stages[0].transform(frame.where("split = 'validation'")), "absolute")
    held = model.fit_boosted(frame, ["x"], "y", rounds=6, depth=2, patience=2)
    assert held.stages[-1].getNumTrees == model.best_round(errors, 2)[0] + 1
    assert held.stages[-1].treeWeights == whole.stages[-1].treeWeights[: held.stages[-1].getNumTrees]


def test_profile_covers_every_column(spark, connection):
    got = {r["column_name"]: (r["n_rows"], r["n_null"], r["n_empty"]) for r in reference.QUERIES["q_profile"](spark, str(DATA)).collect()}
    want = {}
    for name, kind, *_ in connection.execute("DESCRIBE documents").fetchall():
        empty = f"count(*) FILTER ({name} = '')" if kind == "VARCHAR" else "0"
        want[name] = connection.execute(f"SELECT count(*), count(*) FILTER ({name} IS NULL), {empty} FROM documents").fetchone()
    assert len(want) == 10 and got == want
