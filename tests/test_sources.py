"""Files in and out, and streams over them."""

from __future__ import annotations

import json
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from queuescope.sources import files, sinks
from queuescope.streaming import live

FACT = "entity_code string, observed_at timestamp, wait_time_type string, wait_time_minutes int, park_code string, park_date date"


def test_listing_and_selection(spark, tmp_path):
    for name in ("wait_times/wdw/a.csv", "fastpass_times/tdr/b_2018.csv", "fastpass_times/tdr/c_2020.csv", "note.txt"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x\n1\n")
    listed = files.listing(spark, str(tmp_path))
    assert sorted(r["kind"] for r in listed.collect()) == ["New Fastpass", "Old Fastpass", "Standby"]
    paths = {r["path"].rsplit("/", 1)[1]: r["path"] for r in listed.collect()}
    done = spark.createDataFrame([(paths["a.csv"], "2099-01-01 00:00:00"), (paths["b_2018.csv"], "garbage")], "path string, modified string")
    failed = spark.createDataFrame([(paths["c_2020.csv"], 5)], "path string, failures int")
    left = {r["path"].rsplit("/", 1)[1] for r in files.to_process(listed, done, failed, as_of="2024-01-01").collect()}
    assert left == {"b_2018.csv", "c_2020.csv"}
    assert {r["path"].rsplit("/", 1)[1] for r in files.to_process(listed, done, failed, as_of="2099-01-01").collect()} == {"b_2018.csv"}


def test_readers(spark, tmp_path):
    (tmp_path / "h.csv").write_bytes(b" Entity_Code ,Observed_At,Submitted_Posted_Time\nMK1,2023-01-01,\xff5\n")
    frame = files.read_headed(spark, str(tmp_path / "h.csv"))
    assert frame.columns == ["entity_code", "observed_at", "submitted_posted_time"] and frame.count() == 1
    (tmp_path / "p.csv").write_text("any,header,at,all,x,x,x,x,more\nMK1,3,5,2023,1330,0,1400,0,zz\nEP2,4,5,2023,900,,8888,,zz\n")
    rows = files.read_positional(spark, str(tmp_path / "p.csv")).collect()
    assert [(r["FATTID"], r["FYEAR"], r["FWINHR"]) for r in rows] == [("MK1", 2023, 1400), ("EP2", 2023, 8888)]
    assert files.has_columns(spark, str(tmp_path / "h.csv"), ["entity_code", "OBSERVED_AT"]) and not files.has_columns(spark, str(tmp_path / "p.csv"), ["FATTID"])
    one, two = spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(3, 4)], "a int, c int")
    assert [tuple(r) for r in files.union_by_name([one, two]).orderBy("a").collect()] == [(1, 2, None), (3, None, 4)]
    with pytest.raises(ValueError):
        files.union_by_name([])
    (tmp_path / "mk_2026-01-25.csv").write_text("a\n1\n")
    keyed = files.with_file_keys(spark.read.option("header", True).csv(str(tmp_path / "mk_2026-01-25.csv"))).first()
    assert (keyed["park_code"], str(keyed["park_date"])) == ("mk", "2026-01-25")


def test_facts_round_trip_and_pruning(spark, tmp_path):
    path = str(tmp_path / "facts")
    rows = [("MK101", datetime(2026, 1, 25, 10), "POSTED", 30, "mk", datetime(2026, 1, 25)), ("MK101", datetime(2026, 1, 24, 10), "POSTED", 45, "mk", datetime(2026, 1, 24)), ("EP09", datetime(2026, 1, 25, 10), "POSTED", 20, "ep", datetime(2026, 1, 25))]
    sinks.write_facts(spark.createDataFrame(rows, FACT), path, files_per_date=2)
    got = files.read_facts(spark, path, park_code="mk", entity_code="MK101")
    assert sorted(r["wait_time_minutes"] for r in got.collect()) == [30, 45]
    assert "PartitionFilters: [isnotnull(park_code" in got._jdf.queryExecution().toString()
    with pytest.raises(Exception, match="no park or date"):
        sinks.write_facts(spark.createDataFrame([("X", datetime(2026, 1, 1), "POSTED", 1, None, None)], FACT), path)
    staging = str(tmp_path / "staging")
    more = rows[:1] + [("MK101", datetime(2026, 1, 25, 11), "POSTED", 35, "mk", datetime(2026, 1, 25))] * 2
    spark.createDataFrame(more, FACT).write.parquet(staging)
    assert sinks.merge_staging(spark, staging, path) == 1
    assert sinks.merge_staging(spark, staging, path) == 0
    assert spark.read.parquet(path).count() == 4
    sinks.replace_dates(spark.createDataFrame(rows[2:], FACT), path)
    assert spark.read.parquet(path).count() == 4


def test_staging_is_compared_with_its_own_partitions_only(spark, tmp_path):
    path, staging = tmp_path / "facts", str(tmp_path / "staging")
    rows = [("MK1", datetime(2026, 1, d, 10), "POSTED", 30, "mk", datetime(2026, 1, d)) for d in (1, 2)]
    sinks.write_facts(spark.createDataFrame(rows, FACT), str(path))
    for f in path.glob("park_code=mk/park_date=2026-01-01/*.parquet"):
        f.write_bytes(b"damaged")  # a partition that is not touched is never opened
    spark.createDataFrame([rows[1], ("MK1", datetime(2026, 1, 2, 11), "POSTED", 30, "mk", datetime(2026, 1, 2))], FACT).write.parquet(staging)
    assert sinks.merge_staging(spark, staging, str(path)) == 1


def test_a_batch_is_compared_with_its_own_days_only(spark, tmp_path):
    path = tmp_path / "sink"
    sink = live.exact_sink(str(path))
    rows = [("MK1", datetime(2026, 1, d, 10), "POSTED", 30) for d in (1, 2)]
    schema = "entity_code string, observed_at timestamp, wait_time_type string, wait_time_minutes int"
    sink(spark.createDataFrame(rows, schema), 0)
    for f in path.glob("seen_day=2026-01-01/**/*.parquet"):
        f.write_bytes(b"damaged")
    sink(spark.createDataFrame([rows[1], ("MK1", datetime(2026, 1, 2, 10), "POSTED", 31)], schema), 1)
    assert spark.read.parquet(f"{path}/seen_day=2026-01-02").count() == 2


def test_one_failing_source_does_not_stop_the_others():
    seen, failures = [], []

    class Batch:
        def where(self, condition):
            return self

    def bad(batch, number):
        raise ValueError("broken")

    live.isolated({"a": bad, "b": lambda batch, number: seen.append(number)}, "park_code", lambda name, number, error: failures.append((name, str(error))))(Batch(), 3)
    assert (seen, failures) == ([3], [("a", "broken")])


def test_a_state_file_is_never_absent(spark, tmp_path):
    path = str(tmp_path / "s.json")
    sinks.write_json({"v": 0}, spark, path)
    seen, stop = [], threading.Event()

    def look():
        while not stop.is_set():
            seen.append((tmp_path / "s.json").exists())

    looker = threading.Thread(target=look)
    looker.start()
    for v in range(1, 30):
        sinks.write_json({"v": v}, spark, path)
    stop.set()
    looker.join()
    assert all(seen) and sinks.read_json(spark, path) == {"v": 29}
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["s.json"]


def test_lock_retention_and_reports(spark, tmp_path):
    with sinks.lock(spark, str(tmp_path / "lock")):
        with pytest.raises(RuntimeError, match="held"), sinks.lock(spark, str(tmp_path / "lock")):
            pass
    with sinks.lock(spark, str(tmp_path / "lock")), sinks.lock(spark, str(tmp_path / "lock"), stale_hours=-1.0):
        pass
    for i in range(4):
        (tmp_path / f"log{i}").write_text("x")
    logs = spark.createDataFrame([("a", str(tmp_path / f"log{i}"), datetime(2024, 1, i + 1)) for i in range(4)], "kind string, path string, modified timestamp")
    assert sinks.delete_outdated(spark, logs, 1, "2024-01-03", dry_run=True) == 2
    assert sinks.delete_outdated(spark, logs, 1, "2024-01-03") == 2
    assert sorted(p.name for p in tmp_path.glob("log*")) == ["log2", "log3"]
    assert sinks.markdown(spark.range(5), rows=2).endswith("| 1 |\n\n3 more rows are not shown.")
    assert "No data available." in sinks.report("T", {"empty": spark.range(0), "some": spark.range(1)})


def test_versions_state_and_reports(spark, tmp_path):
    root = str(tmp_path / "dim")
    sinks.write_version(spark.range(3), root, "1")
    sinks.write_version(spark.range(5), root, "2")
    assert sinks.read_version(spark, root).count() == 5
    sinks.write_json({"a": [1, 2]}, spark, str(tmp_path / "s.json"))
    assert sinks.read_json(spark, str(tmp_path / "s.json")) == {"a": [1, 2]} and sinks.read_json(spark, str(tmp_path / "none.json"), {}) == {}
    assert sinks.markdown(spark.createDataFrame([(1, None)], "a int, b string")) == "| a | b |\n|---|---|\n| 1 |  |"
    sinks.write_parquet_and_csv(spark.range(2), str(tmp_path / "two"))
    assert spark.read.option("header", True).csv(str(tmp_path / "two.csv")).count() == 2
    logs = spark.createDataFrame([("a", f"p{i}", datetime(2024, 1, i + 1)) for i in range(5)], "kind string, path string, modified timestamp")
    assert {r["path"] for r in sinks.outdated(logs, 2, "2024-01-03").collect()} == {"p0", "p1"}


def _payload(path, name, park, rides, nested=()):
    (path / name).write_text(json.dumps({"park_code": park, "lands": [{"id": 1, "name": "l", "rides": list(nested)}], "rides": rides}))


def _ride(i, wait, at, is_open=True, name="R"):
    return {"id": i, "name": name, "is_open": is_open, "wait_time": wait, "last_updated": at}


def test_live_stream_is_exactly_once(spark, tmp_path):
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    inbox.mkdir()
    mapping = spark.createDataFrame([(7, "MK", "MK101"), (7, "MK", "MK999")], "ride_id long, park_code string, entity_code string").limit(1)
    _payload(inbox, "a.json", "mk", [_ride(7, 30, "2024-01-01T15:00:00Z"), _ride(8, None, "2024-01-01T15:00:00Z")], [_ride(9, 10, "2024-01-01T08:00:00Z"), _ride(5, 1, "2024-01-01T08:00:00Z", False), _ride(6, 1, "2024-01-01T08:00:00Z", name="Get Lightning Lane X")])
    readings = lambda: live.to_readings(live.feed_stream(spark, str(inbox)), mapping, {"mk": "MK"}, as_of="2024-01-02 10:00:00")
    live.run_available(readings(), live.exact_sink(out), state)
    rows = {r["entity_code"]: r for r in spark.read.parquet(out).collect()}
    assert set(rows) == {"MK101", "MK9"} and str(rows["MK9"]["park_date"]) == "2023-12-31" and rows["MK9"]["is_stale"] and not rows["MK101"]["is_stale"]
    _payload(inbox, "b.json", "mk", [_ride(7, 30, "2024-01-01T15:00:00Z"), _ride(7, 35, "2024-01-01T15:05:00Z")])
    live.run_available(readings(), live.exact_sink(out), state)
    assert spark.read.parquet(out).count() == 3
    sink = live.exact_sink(out)
    again = spark.read.parquet(out).where("batch = 1").drop("batch", "seen_day")
    sink(again, 1)
    assert spark.read.parquet(out).count() == 3


def test_windows_over_streams(spark, tmp_path):
    inbox = str(tmp_path / "ev")
    spark.range(20).select(F.timestamp_seconds(F.lit(1_700_000_100) + F.col("id") * 60).alias("ts"), (F.col("id") % 2).alias("k")).write.parquet(inbox)
    stream = spark.readStream.schema("ts timestamp, k long").parquet(inbox)
    frames = {"t": live.tumbling(stream, "ts"), "s": live.sliding(stream, "ts", "1 minute", "10 minutes", "5 minutes"), "g": live.sessions(stream, "ts", "1 minute", "90 seconds", ("k",))}
    totals = {}
    for name, frame in frames.items():
        query = frame.writeStream.format("memory").queryName(f"w_{name}").outputMode("complete").trigger(availableNow=True).start()
        query.awaitTermination()
        totals[name] = spark.sql(f"SELECT sum(n) FROM w_{name}").first()[0]
    assert totals == {"t": 20, "s": 40, "g": 20}
    unique = live.recent_unique(stream.withColumn("x", F.lit(1)), ["ts"], "ts")
    query = unique.writeStream.format("memory").queryName("w_u").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.sql("SELECT count(*) FROM w_u").first()[0] == 20
