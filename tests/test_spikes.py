"""Implausible readings against a plain statement of the rules."""

from __future__ import annotations

import random
from statistics import median

from queuescope.operators.readings import later_repeats, typed_readings
from queuescope.operators.spikes import Limits, chart, flag_spikes

SCHEMA = "ingest_seq long, source string, kind string, observed_us long, minutes long"


def _expected(rows):
    out = set()
    rows = [r for r in rows if r[4] is not None and r[3] is not None and not (r[2] == "PRIORITY" and r[4] == 8888)]
    for source in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == source), key=lambda r: (r[3], r[0]))
        fine = [r[4] for r in own if (-100 <= r[4] <= 2000 if r[2] == "PRIORITY" else 0 <= r[4] <= 1000)]
        m = median(fine) if fine else 0
        for r in own:
            inside = -100 <= r[4] <= 2000 if r[2] == "PRIORITY" else 0 <= r[4] <= 1000
            if not inside or len(fine) >= 20 and (r[4] > 3 * m + 30 or r[2] == "POSTED" and m >= 40 and r[4] < m / 10):
                out.add(r[0])
        same = [a[4] == b[4] for a, b in zip(own, own[1:], strict=False)]
        if same and sum(same) / len(same) > 0.8:
            continue
        run = [own[0]]
        for r in [*own[1:], None]:
            if r is not None and r[4] == run[-1][4]:
                run.append(r)
                continue
            if len(run) >= 10:
                out |= {x[0] for x in run}
            run = [r]
    return out


def _random(seed):
    rng = random.Random(seed)
    rows, seq = [], 0
    for source, kind, base in (("MK1|POSTED", "POSTED", 60), ("MK1|ACTUAL", "ACTUAL", 30), ("EP2|PRIORITY", "PRIORITY", 90), ("EP3|POSTED", "POSTED", 5), ("QQ|POSTED", "POSTED", 50)):
        value, at = base, 0
        for _ in range(12 if source == "QQ|POSTED" else 400):
            seq += 1
            at += rng.choice([0, 60_000_000, 300_000_000])
            if rng.random() < 0.25 or source == "EP3|POSTED" and rng.random() < 0.05:
                value = max(0, base + rng.randrange(-10, 11) * (source != "EP3|POSTED"))
            spike = rng.random()
            shown = rng.choice([-5, 1500, 999, 2, 8888]) if spike < 0.02 else None if spike < 0.03 else value
            rows.append((seq, source, kind, at, shown))
    return rows


def test_rules_over_blocks_of_any_size(spark):
    for seed in (1, 2):
        rows = _random(seed)
        rng = random.Random(seed)
        shuffled = rows[:]
        rng.shuffle(shuffled)
        frame = spark.createDataFrame(shuffled, SCHEMA)
        for size, everything in ((32, True), (64, False), (8192, False), (8192, True)):
            flags = flag_spikes(frame, Limits(block_rows=size, warmup_rows=16), everything).collect()
            assert not everything or len(flags) == sum(r[4] is not None and not (r[2] == "PRIORITY" and r[4] == 8888) for r in rows)
            got = {r["ingest_seq"] for r in flags if r["impossible"] or r["disproportionate"] or r["stuck"]}
            assert got == _expected(rows)
            assert all(r["suspected"] for r in flags if r["disproportionate"])


def test_empty_and_null_rows(spark):
    frame = spark.createDataFrame([(1, "A", "POSTED", None, 3), (2, "A", "POSTED", 5, None), (3, "A", "PRIORITY", 5, 8888)], SCHEMA)
    assert flag_spikes(frame).count() == 0
    assert flag_spikes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_chart_by_itself():
    limits, far = Limits(), (float("inf"), float("-inf"))
    calm = [60, 62, 58, 61, 59] * 40
    fine = [True] * 400

    def beyond(values):
        return set(chart([float(v) for v in values], fine[: len(values)], 60.0, 3.0, *far, limits)[1].nonzero()[0].tolist())

    assert beyond(calm) == set()
    # a spike far below three medians plus 30 is seen, and does not move the chart
    spiked = [*calm[:100], 110, *calm[101:]]
    assert beyond(spiked) == {100}
    # a lasting change of level is out of control at first and then becomes the new normal
    shifted = beyond([*calm[:100], *[v + 40 for v in calm[:100]]])
    assert 100 in shifted
    assert max(shifted) < 160
    # a slow drift never is
    assert beyond([60 + i // 10 for i in range(400)]) == set()


def test_flags_do_not_depend_on_homes(spark):
    frame = spark.createDataFrame(_random(5), SCHEMA)
    whole = {r["ingest_seq"]: r["out_of_control"] for r in flag_spikes(frame).collect()}
    parted = {r["ingest_seq"]: r["out_of_control"] for r in flag_spikes(frame, Limits(block_rows=100, warmup_rows=90)).collect()}
    assert whole.keys() == parted.keys()
    assert sum(whole[k] != parted[k] for k in whole) <= 2
    assert any(whole.values())


def test_later_repeats_equal_brute_force(spark):
    for seed, (seconds, minutes) in enumerate([(30, 1), (0, 0), (0, 3), (7, 0), (30, 2), (45, 5), (1, 1)]):
        rng = random.Random(seed)
        rows = [(i, rng.choice(["A", "B"]), "POSTED", rng.randrange(-450, 450) * 1_000_000, rng.choice([None, *range(-3, 8)])) for i in range(400)]
        got = {r[0] for r in later_repeats(spark.createDataFrame(rows, SCHEMA), seconds, minutes, block_us=120_000_000).collect()}
        reach = seconds * 1_000_000
        want = {b[0] for a in rows for b in rows if a[4] is not None and b[4] is not None and a[1] == b[1] and a[0] < b[0] and abs(a[3] - b[3]) <= reach and abs(a[4] - b[4]) <= minutes}
        assert got == want


def test_typed_readings(spark):
    raw = spark.createDataFrame(
        [(1, 1, "ush", " ush07", "2023-10-30 09:00:00", "posted ", 10, "x"), (2, 1, "wdw", None, "2023-10-30 09:00:00", "POSTED", 10, "x"), (3, 1, "wdw", "mk1", "n/a", "POSTED", 10, "x"), (4, 1, None, "mk1", "2023-10-30T09:00:00Z", None, None, None)],
        "ingest_seq long, batch_id int, prop string, entity_code string, observed_at string, wait_time_type string, wait_time_minutes int, source string",
    )
    got = {r["ingest_seq"]: r for r in typed_readings(raw).collect()}
    assert set(got) == {1, 4}
    assert (got[1]["source"], got[1]["park"], got[1]["observed_us"]) == ("USH07|POSTED", "uh", 1698681600000000)
    assert (got[4]["source"], got[4]["minutes"]) == ("MK1", None)
