"""Blocked running values and neighbours against plain Python."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from queuescope.operators.asof import forward_preferred, nearest
from queuescope.operators.ordered import with_neighbours, with_ordinal, with_running


def _rows(seed: int, n: int = 300):
    rng = random.Random(seed)
    return [(i, rng.choice(["a", "a", "a", "b", None]), rng.randrange(60), rng.choice([None, rng.randrange(9)])) for i in range(n)]


def test_running_ordinal_and_neighbours(spark):
    rows = _rows(1)
    frame = spark.createDataFrame(rows, "i int, k string, t int, v int")
    order, block = [F.col("t"), F.col("i")], F.floor(F.col("t") / 7)
    out = with_running(frame, ["k"], order, block, F.col("v"), "total")
    out = with_running(out, ["k"], order, block, F.col("v"), "best", "max")
    out = with_ordinal(out, ["k"], order, block)
    out = with_neighbours(out, ["k"], order, block, {"v": F.col("v"), "w": F.when(F.col("v") > 4, F.col("v"))})
    got = {r["i"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for key in {r[1] for r in rows}:
        group = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0]))
        values = [r[3] for r in group]
        for n, r in enumerate(group):
            seen = [v for v in values[: n + 1] if v is not None]
            g = got[r[0]]
            assert (g["total"], g["best"], g["ordinal"]) == (sum(seen), max(seen, default=None), n + 1)
            assert g["v_before"] == next((v for v in reversed(values[:n]) if v is not None), None)
            assert g["v_after"] == next((v for v in values[n + 1 :] if v is not None), None)
            assert g["w_after"] == next((v for v in values[n + 1 :] if v is not None and v > 4), None)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "i int, k string, t int, v int")
    assert with_ordinal(frame, ["k"], [F.col("i")], F.col("t")).count() == 0
    assert with_neighbours(frame, ["k"], [F.col("i")], F.col("t"), {"v": F.col("v")}).count() == 0


def test_nearest_and_forward_equal_brute_force(spark):
    rng = random.Random(3)
    left = [(i, rng.choice("ab"), rng.randrange(2000)) for i in range(60)]
    right = [(i, rng.choice("ab"), rng.randrange(2000), rng.randrange(99)) for i in range(80)] + [(80, "a", 500, 1), (81, "a", 500, 2)]
    lf = spark.createDataFrame(left, "i int, k string, at bigint")
    rf = spark.createDataFrame(right, "o int, k string, at bigint, v int")
    near = {r["i"]: r["v"] for r in nearest(lf, rf, ["k"], "at", "i", "v", "o").collect()}
    within = {r["i"]: r["v"] for r in nearest(lf, rf, ["k"], "at", "i", "v", "o", tolerance_us=20).collect()}
    ahead = {r["i"]: r["v"] for r in forward_preferred(lf, rf, ["k"], "at", "i", "v", "o", 30, 100).collect()}
    for i, k, at in left:
        own = [r for r in right if r[1] == k]
        best = min(own, key=lambda r: (abs(r[2] - at), r[0]))
        assert near[i] == best[3]
        assert within[i] == (best[3] if abs(best[2] - at) <= 20 else None)
        later = [r for r in own if r[2] >= at]
        if later:
            first = min(later, key=lambda r: (r[2], r[0]))
            assert ahead[i] == (first[3] if first[2] - at <= 30 else None)
        else:
            last = max(own, key=lambda r: (r[2], -r[0]))
            assert ahead[i] == (last[3] if at - last[2] <= 100 else None)
