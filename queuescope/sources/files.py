"""Listing, classifying and reading raw files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from queuescope.functions.clean import normal_headers
from queuescope.functions.parse import file_kind, zone_of_path

# Columns of the two raw layouts.
STANDBY_SCHEMA = "entity_code string, observed_at string, submitted_posted_time string, submitted_actual_time string, user_id string"
PRIORITY_SCHEMA = "FATTID string, FDAY int, FMONTH int, FYEAR int, FHOUR int, FMIN int, FWINHR int, FWINMIN int"


def listing(spark: SparkSession, path: str, suffix: str = ".csv") -> DataFrame:
    """Files below a folder: path, modified, length, kind and zone; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(path)
    return files.select("path", F.col("modificationTime").alias("modified"), "length", file_kind(F.col("path")).alias("kind"), zone_of_path(F.col("path")).alias("zone"))


def to_process(listed: DataFrame, processed: DataFrame, failed: DataFrame | None = None, *, as_of: str, most_failures: int = 3, oldest_days: int = 600) -> DataFrame:
    """Files that are new, changed since they were processed, or stored without a readable time.

    ``processed``: path, modified (text); ``failed``: path, failures.  Files that failed
    ``most_failures`` times and are older than ``oldest_days`` at ``as_of`` are left out.
    """
    seen = processed.select("path", F.col("modified").alias("__stored"))
    fresh = listed.join(seen, "path", "left").withColumn("__at", F.try_to_timestamp(F.col("__stored"))).where(F.col("__at").isNull() | (F.col("modified") > F.col("__at"))).drop("__stored", "__at")
    if failed is None:
        return fresh
    joined = fresh.join(failed.select("path", "failures"), "path", "left")
    hopeless = (F.col("failures") >= most_failures) & (F.datediff(F.lit(as_of).cast("date"), "modified") >= oldest_days)
    return joined.where(~F.coalesce(hopeless, F.lit(False))).drop("failures")


def read_headed(spark: SparkSession, paths: str | Sequence[str], header_case: str = "lower") -> DataFrame:
    """CSV files with a header, all columns as text, header names stripped and folded; bad bytes become U+FFFD.

    Files of one layout are read by one scan.
    """
    return normal_headers(spark.read.option("header", True).option("mode", "PERMISSIVE").csv(list(paths) if not isinstance(paths, str) else paths), header_case)


def read_positional(spark: SparkSession, paths: str | Sequence[str], schema: str | StructType = PRIORITY_SCHEMA) -> DataFrame:
    """CSV files by position: each file's first line is skipped, the schema's columns are taken in order, more are ignored."""
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def has_columns(spark: SparkSession, path: str, wanted: Sequence[str]) -> bool:
    """Whether a file's first line holds all wanted names, in any case."""
    head = spark.read.text(path).limit(1).collect()
    names = {c.strip().strip('"').lower() for c in head[0][0].lstrip("﻿").split(",")} if head else set()
    return {w.lower() for w in wanted} <= names


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; columns that a frame lacks are null."""
    if not frames:
        raise ValueError("nothing to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_file_keys(frame: DataFrame) -> DataFrame:
    """Adds park_code and park_date of ``{park}_{YYYY-MM-DD}`` file names; null where the name is none."""
    name = F.col("_metadata.file_name")
    pattern = r"^([a-z0-9]+)_(\d{4}-\d{2}-\d{2})\."
    return frame.select("*", F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).alias("park_code"), F.nullif(F.regexp_extract(name, pattern, 2), F.lit("")).cast("date").alias("park_date"))


def read_facts(spark: SparkSession, path: str, park_code: str | None = None, entity_code: str | None = None, park_date: str | None = None) -> DataFrame:
    """The partitioned fact table; the park and date filters prune partitions, the entity filter reaches the scan."""
    frame = spark.read.parquet(path)
    for column, value in (("park_code", park_code), ("park_date", park_date), ("entity_code", entity_code)):
        if value is not None:
            frame = frame.where(F.col(column) == (F.lit(value).cast("date") if column == "park_date" else value))
    return frame


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Live payloads (one JSON document per file) as rides, those under lands and those beside them."""
    ride = "struct<id:bigint,name:string,is_open:boolean,wait_time:int,last_updated:string>"
    raw = spark.read.schema(f"lands array<struct<id:bigint,name:string,rides:array<{ride}>>>, rides array<{ride}>").option("multiLine", True).json(path)
    return flatten_feed(raw)


def flatten_feed(raw: DataFrame) -> DataFrame:
    """Rides of payloads with lands[].rides[] and rides[]; null lists are empty."""
    none = F.array().cast(raw.schema["rides"].dataType)
    under = F.flatten(F.transform(F.coalesce("lands", F.array().cast(raw.schema["lands"].dataType)), lambda land: F.coalesce(land["rides"], none)))
    others = [c for c in raw.columns if c not in ("lands", "rides")]
    return raw.select(*others, F.inline(F.concat(under, F.coalesce("rides", none))))
