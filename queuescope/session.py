"""Session defaults, table access and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "queuescope", master: str = "local[*]", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    UTC is the session zone, AQE re-plans joins and partition counts at run time.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One of the Parquet tables of a directory."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage, as ``spark.checkpoint.dir`` names it.

    Without that setting it is the folder already set on the context; where there
    is neither, only a local master gets a temporary folder, as in tests: on a
    cluster other machines could not read it, so that is an error.
    """
    context = spark.sparkContext
    present = context.getCheckpointDir()
    if present is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if named is None and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="queuescope-checkpoint-"))
        present = context.getCheckpointDir()
    return present


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's name in the shared checkpoint folder; what is written there is dropped when the application ends."""
    place = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return place


def cut(frame: DataFrame) -> DataFrame:
    """The frame with its lineage cut: written as a table in the shared folder, and read again.

    For narrow intermediate tables that several branches of a plan read: each reads
    only its columns, and losing an executor loses none of it.
    """
    # types that a file cannot hold, and names that differ by case only, are left to a plain checkpoint
    if any(kind in ("void", "variant") or kind.startswith("interval") for _, kind in frame.dtypes) or len({c.lower() for c in frame.columns}) < len(frame.columns):
        ensure_checkpoint_dir(frame.sparkSession)
        return frame.checkpoint(eager=True)
    place = shared_folder(frame.sparkSession, "cut")
    frame.write.mode("overwrite").parquet(place)
    return frame.sparkSession.read.schema(frame.schema).parquet(place)


def spread(frame: DataFrame) -> DataFrame:
    """The frame over at least as many partitions as there are cores.

    Large inputs are split by the scan and stay as they are; only an input of
    few file splits is dealt out before work that is heavy per row.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if frame.rdd.getNumPartitions() < cores else frame
