"""Writers: partitioned facts, swapped versions, state tables, retention."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuescope.session import cut


def _files(spark: SparkSession, path: str) -> tuple[Any, Any]:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def write_facts(frame: DataFrame, path: str, mode: str = "append", files_per_date: int = 1) -> None:
    """Writes park_code/park_date partitions, rows in order of observed_at inside each file.

    Rows with a null partition key are refused.  ``files_per_date`` spreads a hot
    date over files by entity; the shuffle then has no task larger than a share of one.
    """
    keyed = frame.withColumn("__ok", F.when(F.col("park_code").isNull() | F.col("park_date").isNull(), F.raise_error(F.lit("a fact has no park or date"))).otherwise(F.lit(True))).where("__ok").drop("__ok")
    slot = F.pmod(F.xxhash64("entity_code"), F.lit(files_per_date))
    spread = keyed.withColumn("__slot", slot).repartition("park_code", "park_date", "__slot").sortWithinPartitions("park_code", "park_date", "observed_at").drop("__slot")
    spread.write.mode(mode).partitionBy("park_code", "park_date").parquet(path)


def replace_dates(frame: DataFrame, path: str) -> None:
    """Overwrites only the partitions that the frame has rows for; running it twice leaves the same table."""
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("park_code", "park_date").parquet(path)


def merge_staging(spark: SparkSession, staging: str, facts: str, keys: tuple[str, ...] = ("entity_code", "observed_at", "wait_time_type", "wait_time_minutes")) -> int:
    """Appends staged rows that the fact table does not have, then removes the staging folder; returns the rows added.

    Only the partitions that staged rows fall in are read (equal rows have equal park and
    date); the driver holds one name for each of these.  Lost half way, it can be run again:
    rows that were appended are then known.
    """
    files, folder = _files(spark, staging)
    if not files.exists(folder):
        return 0
    staged = spark.read.parquet(staging).dropDuplicates(list(keys))
    touched = spark.read.parquet(staging).select("park_code", F.col("park_date").cast("string").alias("park_date")).distinct().collect()
    places = [f"{facts}/park_code={r[0]}/park_date={r[1]}" for r in touched]
    present = [p for p in places if _files(spark, p)[0].exists(_files(spark, p)[1])]
    if present:
        known = spark.read.option("basePath", facts).parquet(*present)
        same = [F.col(f"s.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
        staged = staged.alias("s").join(known.alias("f"), reduce(lambda a, b: a & b, same), "left_anti")
    fresh = cut(staged)
    added = fresh.count()
    if added:
        write_facts(fresh, facts)
    files.delete(folder, True)
    return added


@contextmanager
def lock(spark: SparkSession, path: str, stale_hours: float = 24.0) -> Iterator[None]:
    """Mutual exclusion of jobs by a lock file that only one can create; one older than ``stale_hours`` was left behind and is taken over."""
    files, target = _files(spark, path)
    if files.exists(target) and time.time() * 1000 - files.getFileStatus(target).getModificationTime() > stale_hours * 3_600_000:
        files.delete(target, False)
    try:
        files.create(target, False).close()
    except Py4JJavaError as error:
        raise RuntimeError(f"{path} is held by another job") from error
    try:
        yield
    finally:
        files.delete(target, False)


def write_version(frame: DataFrame, root: str, version: str) -> str:
    """Writes a whole table as a new version and points ``CURRENT`` at it; readers never see a half-written table."""
    spark = frame.sparkSession
    path = f"{root.rstrip('/')}/v={version}"
    frame.write.mode("overwrite").parquet(path)
    write_json({"path": path}, spark, f"{root.rstrip('/')}/CURRENT")
    return path


def read_version(spark: SparkSession, root: str) -> DataFrame:
    """The table that ``CURRENT`` points at."""
    return spark.read.parquet(read_json(spark, f"{root.rstrip('/')}/CURRENT")["path"])


def write_json(value: Any, spark: SparkSession, path: str) -> None:
    """A small JSON state file, written beside its place and renamed over it in one step: there is no moment without a file."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    files, target = _files(spark, path)
    text = json.dumps(value, sort_keys=True)
    if files.getScheme() == "file":
        # Hadoop deletes a local file before it renames over it; the system's own rename does not
        place = files.makeQualified(target).toUri().getPath()
        os.makedirs(os.path.dirname(place), exist_ok=True)
        part = f"{place}.{uuid.uuid4().hex}.part"
        with open(part, "w") as out:
            out.write(text)
        checksum = os.path.join(os.path.dirname(place), f".{os.path.basename(place)}.crc")
        if os.path.exists(checksum):
            os.remove(checksum)
        os.replace(part, place)
        return
    part = hadoop.Path(f"{path}.{uuid.uuid4().hex}.part")
    out = files.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context = hadoop.FileContext.getFileContext(files.makeQualified(target).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(part), files.makeQualified(target), options)


def read_json(spark: SparkSession, path: str, default: Any = None) -> Any:
    """A small JSON state file; the default where there is none."""
    files, target = _files(spark, path)
    if not files.exists(target):
        return default
    return json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))


def write_parquet_and_csv(frame: DataFrame, path: str) -> None:
    """The same rows as Parquet and as CSV with a header."""
    frame.write.mode("overwrite").parquet(f"{path}.parquet")
    frame.write.mode("overwrite").option("header", True).csv(f"{path}.csv")


def write_curves(frame: DataFrame, path: str) -> None:
    """Curves by date and entity."""
    frame.repartition("park_date", "entity_code").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("park_date", "entity_code").parquet(path)


def markdown(frame: DataFrame, rows: int = 50) -> str:
    """A report as a Markdown table; where it has more than ``rows`` rows, a last line says how many are not shown."""
    shown = frame.limit(rows + 1).collect()
    lines = ["| " + " | ".join(frame.columns) + " |", "|" + "---|" * len(frame.columns)]
    lines += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in shown[:rows]]
    return "\n".join(lines if len(shown) <= rows else [*lines, "", f"{frame.count() - rows} more rows are not shown."])


def report(title: str, sections: dict[str, DataFrame], rows: int = 50) -> str:
    """A Markdown report: a title, and a heading and a table for each section; an empty one says so."""
    parts = [f"# {title}"]
    for heading, frame in sections.items():
        parts += ["", f"## {heading}", "", "No data available." if frame.isEmpty() else markdown(frame, rows)]
    return "\n".join(parts) + "\n"


def outdated(files: DataFrame, keep: int, newer_than: str) -> DataFrame:
    """Of files (kind, path, modified): those beyond the newest ``keep`` of their kind and older than a time."""
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(F.col("modified").desc(), "path"))
    return files.withColumn("__r", rank).where((F.col("__r") > keep) & (F.col("modified") < F.lit(newer_than).cast("timestamp"))).drop("__r")


def delete_outdated(spark: SparkSession, files: DataFrame, keep: int, newer_than: str, dry_run: bool = False) -> int:
    """Deletes the files that :func:`outdated` names; returns how many.  The paths come to the driver one by one."""
    count = 0
    for row in outdated(files, keep, newer_than).select("path").toLocalIterator():
        system, place = _files(spark, row[0])
        count += 1 if dry_run else int(system.delete(place, False))
    return count
