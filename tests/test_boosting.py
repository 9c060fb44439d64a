"""Boosting in one barrier stage."""

from __future__ import annotations

import json
import threading
import time

import numpy as np
import pytest

from queuescope.operators import boosting, model


def _data(spark, n=400):
    rows = [(float(i % 40), float(i % 7), float(i % 40 // 10 * 30 + i % 7), "validation" if i % 5 == 0 else "train") for i in range(n)]
    return spark.createDataFrame(rows, "a double, b double, y double, split string").cache()


def test_rounds_start_no_jobs_of_their_own(spark):
    rows = _data(spark)
    context = spark.sparkContext
    context.setJobGroup("boosting", "")
    fitted = model.fit_boosted(rows, ["a", "b"], "y", rounds=60, depth=3)
    jobs = context.statusTracker().getJobIdsForGroup("boosting")
    context.setJobGroup("", "")
    assert fitted.stages[-1].getNumTrees > 20 and len(jobs) < 50


def test_tasks_fit_the_trees_of_one_task(spark, monkeypatch):
    rows = _data(spark)
    how = {"rounds": 5, "depth": 3, "subsample": 1.0}
    one = model.fit_boosted(rows, ["a", "b"], "y", **how)
    monkeypatch.setattr(boosting, "TASK_ROWS", 60)
    four = model.fit_boosted(rows, ["a", "b"], "y", **how)
    assert [t.numNodes for t in one.stages[-1].trees] == [t.numNodes for t in four.stages[-1].trees]
    a, b = ([r["prediction"] for r in model.predict(m, rows, ["a", "b"]).orderBy("a", "b").collect()] for m in (one, four))
    assert a == pytest.approx(b)


def test_tasks_exchange_without_the_sleep_of_the_stage(spark, monkeypatch):
    rows = _data(spark)
    monkeypatch.setattr(boosting, "TASK_ROWS", 60)
    began = time.monotonic()
    fitted = model.fit_boosted(rows.where("split = 'train'"), ["a", "b"], "y", rounds=40, depth=3)
    assert fitted.stages[-1].getNumTrees == 40 and time.monotonic() - began < 80  # of 160 exchanges, each slept for a second


def test_cells_get_the_predictions_of_their_rows(spark):
    fitted = model.fit_boosted(_data(spark), ["a", "b"], "y", rounds=8, depth=4)
    nan, inf = float("nan"), float("inf")
    values = [None, nan, -inf, inf, -1.0, 0.0, -0.0, 0.5, 3.0, 39.0, 40.0, *[x for limits in fitted.bounds for x in limits]]
    rows = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate((x, y) for x in values for y in values)], "id long, a double, b double")
    want, got = ({r["id"]: r["prediction"] for r in model.predict(fitted, rows, ["a", "b"], bounds).collect()} for bounds in (None, fitted.bounds))
    assert got == want and len(want) == len(values) ** 2 and len(set(want.values())) > 10
    assert model.predict(fitted, rows, ["a", "b"], fitted.bounds).columns == model.predict(fitted, rows, ["a", "b"]).columns


def test_many_targets_in_few_cells_are_fitted_by_one_task(spark):
    rows = spark.range(60_000).selectExpr("double(id % 4) AS a", "id % 4 * 100 + id / 60000 AS y", "'train' AS split")
    began = time.monotonic()
    fitted = model.fit_boosted(rows, ["a"], "y", rounds=40, depth=3)
    assert time.monotonic() - began < 60
    got = {r["a"]: r["prediction"] for r in model.predict(fitted, rows.limit(4), ["a"]).collect()}
    assert got == pytest.approx({float(k): k * 100 + 0.5 for k in range(4)}, abs=0.2)


def test_targets_of_cells_are_parted_as_row_by_row():
    draw = np.random.default_rng(1)
    cell, target = np.sort(draw.integers(0, 6, 200)), draw.integers(0, 9, 200).astype(float)
    cell[cell == 3] = 4  # a cell without rows
    order = np.lexsort((target, cell))
    cell, target, count, fitted = cell[order], target[order], draw.integers(1, 5, 200), np.array([-1.0, 2.0, 4.5, 3.0, 8.0, 99.0])
    of = boosting._Targets(cell, target, count, 6)
    ((below, rest),) = of.parted(fitted, of.counts)
    assert below.tolist() == [count[(cell == c) & (target < fitted[c])].sum() for c in range(6)]
    assert rest.tolist() == [count[(cell == c) & (target >= fitted[c])].sum() for c in range(6)]
    assert of.error(fitted) == pytest.approx(float(np.abs(target - fitted[cell]) @ count))


class _Context:
    """The context of one of three tasks on this machine."""

    gathered, barrier = {}, threading.Barrier(3)

    def __init__(self, k):
        self.k, self.calls = k, 0

    def partitionId(self):  # noqa: N802
        return self.k

    def getTaskInfos(self):  # noqa: N802
        return [type("Info", (), {"address": "127.0.0.1:1"})] * 3

    def allGather(self, said):  # noqa: N802
        self.calls += 1
        self.gathered[self.k] = said
        self.barrier.wait()
        return [self.gathered[k] for k in range(3)]


def test_sums_of_tasks_take_one_call_of_the_barrier():
    found = {}

    def run(k):
        context = _Context(k)
        exchange = boosting._Exchange(context)
        sums = [exchange.total(np.full((2, 3), float(k + i))).tolist() for i in range(50)]
        exchange.close()
        found[k] = context.calls, json.dumps(sums)

    threads = [threading.Thread(target=run, args=(k,), daemon=True) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(30)
    assert set(found.values()) == {(1, json.dumps([[[3.0 + 3 * i] * 3] * 2 for i in range(50)]))} and len(found) == 3
