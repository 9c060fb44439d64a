"""Containers are never overfull, nothing is lost or split needlessly, and fills are best."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from queuescope.llm.packing import best_fill, byte_tokens, containers, pack, pack_items


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=0, max_size=9), st.integers(0, 60))
def test_best_fill_is_the_best_subset(sizes, space):
    chosen = best_fill(dict(Counter(sizes)), space)
    assert all(0 < n <= Counter(sizes)[x] for x, n in chosen.items())
    best = max(s for k in range(len(sizes) + 1) for c in combinations(sizes, k) if (s := sum(c)) <= space)
    assert sum(x * n for x, n in chosen.items()) == best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=120), st.integers(4, 64))
def test_pack_places_every_item_once(sizes, window):
    placed = pack(sizes, 100, window)
    used: dict[int, int] = defaultdict(int)
    for size, number in zip(sizes, placed, strict=True):
        assert number >= 0
        used[number] += size
    assert all(u <= 100 for u in used.values()) and set(used) == set(range(len(used)))


def test_little_space_is_left_when_items_are_small():
    rng = random.Random(1)
    sizes = [rng.randrange(300, 6000) for _ in range(3000)]
    for capacity in (16_384, 65_536):
        used, needed = max(pack(sizes, capacity)) + 1, -(-sum(sizes) // capacity)
        assert used <= needed + max(1, needed // 200)


def test_items_over_the_capacity_and_odd_items(spark):
    rows = [(1, "x" * 25), (2, "y" * 10), (3, ""), (4, None), (5, "ü" * 3), (6, "z" * 30), (7, "z" * 5), (7, "z" * 5), (None, "abc")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", byte_tokens(F.col("text")).alias("piece"))
    for shard_items in (3, 10_000):
        packed = pack_items(frame, "doc_id", "piece", [10, 10, 1000], shard_items=shard_items).collect()
        for capacity in (10, 1000):
            own = [r for r in packed if r["capacity_tokens"] == capacity]
            per = Counter()
            for r in own:
                per[r["container"]] += r["piece_tokens"]
            assert all(n <= capacity for c, n in per.items() if c is not None)
            assert sum(r["piece_tokens"] for r in own) == 25 + 10 + 6 + 30 + 5 + 5 + 3
            assert {r["doc_id"] for r in own if r["pieces"] > 1} == ({1, 6} if capacity == 10 else set())
            assert {r["doc_id"] for r in own if r["container"] is None} == {3, 4}
    report = {r["capacity_tokens"]: r for r in containers(pack_items(frame, "doc_id", "piece", [10])).collect()}
    assert report[10]["tokens"] == 84 and report[10]["containers"] >= 9
    assert pack_items(frame.where(F.lit(False)), "doc_id", "piece", [10]).count() == 0
    assert pack_items(frame, "doc_id", "piece", []).count() == 0
    assert pack_items(frame, "doc_id", "piece", [0, -5]).count() == 0
    from_table = spark.createDataFrame([(10,), (10,), (None,), (-1,), (1000,)], "c long").agg(F.collect_set("c")).scalar()
    assert {r[0] for r in pack_items(frame, "doc_id", "piece", from_table).select("capacity_tokens").distinct().collect()} == {10, 1000}
    many = spark.createDataFrame([(7, "x" * 40)] * 3000, "doc_id long, t string").select("doc_id", F.length("t").alias("n"))
    assert pack_items(many, "doc_id", "n", [100], shard_items=100).select(F.split_part("container", F.lit("-"), F.lit(2))).distinct().count() > 20  # one id, many shards


def test_an_item_of_the_capacity_is_one_piece(spark):
    frame = spark.createDataFrame([(1, 10), (2, 11)], "id long, n long")
    assert {(r["id"], r["piece"], r["piece_tokens"]) for r in pack_items(frame, "id", "n", [10]).collect()} == {(1, 0, 10), (2, 0, 10), (2, 1, 1)}
