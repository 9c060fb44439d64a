"""Live readings as streams: feed files to facts, exact de-duplication, windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from queuescope.functions.codes import park_date_of, park_of, zone_of_park
from queuescope.sources.files import flatten_feed

_RIDE = "struct<id:bigint,name:string,is_open:boolean,wait_time:int,last_updated:string>"
FEED_SCHEMA = f"park_code string, lands array<struct<id:bigint,name:string,rides:array<{_RIDE}>>>, rides array<{_RIDE}>"
KEYS = ["entity_code", "observed_at", "wait_time_type", "wait_time_minutes"]


def feed_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New payload files of a folder as they arrive; files that cannot be read are skipped."""
    reader = spark.readStream.schema(FEED_SCHEMA).option("maxFilesPerTrigger", files_per_batch).option("ignoreCorruptFiles", True)
    return reader.option("multiLine", True).json(path)


def to_readings(raw: DataFrame, mapping: DataFrame, prefix_of_park: dict[str, str], stale_hours: int = 24, as_of: str | None = None) -> DataFrame:
    """Posted readings of open rides; rides the mapping lacks get the park's prefix and their id as code.

    ``mapping``: ride_id, park_code, entity_code.  Stale rows are marked, not dropped.
    """
    named = mapping.dropDuplicates(["ride_id", "park_code"]).select(F.col("ride_id").alias("id"), F.lower("park_code").alias("park_code"), "entity_code")
    prefix = F.create_map(*[F.lit(x) for pair in prefix_of_park.items() for x in pair])
    rides = flatten_feed(raw.withColumn("park_code", F.lower("park_code")))
    useful = rides.where(F.col("is_open") & F.col("wait_time").isNotNull() & F.col("last_updated").isNotNull() & ~F.coalesce(F.col("name").startswith("Get Lightning Lane"), F.lit(False)))
    coded = useful.join(named, ["id", "park_code"], "left")
    at = F.try_to_timestamp("last_updated")
    rows = coded.select(
        F.coalesce("entity_code", F.concat(F.try_element_at(prefix, F.col("park_code")), F.col("id").cast("string"))).alias("entity_code"),
        at.alias("observed_at"),
        F.lit("POSTED").alias("wait_time_type"),
        F.col("wait_time").alias("wait_time_minutes"),
    ).where(F.col("observed_at").isNotNull() & F.col("entity_code").isNotNull())
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    park = park_of(F.col("entity_code"))
    return rows.withColumns({
        "park_code": park,
        "park_date": park_date_of(F.unix_micros("observed_at"), zone_of_park(park)),
        "is_stale": F.unix_micros(now) - F.unix_micros("observed_at") > F.lit(stale_hours * 3_600_000_000),
    })


def exact_sink(path: str, keys: list[str] = KEYS, at: str = "observed_at") -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that appends only rows whose key the table does not have.

    The table is parted by day of ``at`` (one of the keys) and batch; a batch is compared with the
    days it has rows for and no others.  Exactly once: a repeated batch replaces its own folders
    and is compared with the other batches only.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates(keys).withColumns({"seen_day": F.date_format(at, "yyyy-MM-dd"), "batch": F.lit(number)})
        # one name for each day of the batch
        days = [r[0] or "__HIVE_DEFAULT_PARTITION__" for r in fresh.select("seen_day").distinct().collect()]
        path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        files = path_of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        stored = [p for p in (f"{path}/seen_day={day}" for day in days) if files.exists(path_of(p))]
        if stored:
            known = spark.read.option("basePath", path).parquet(*stored).where(F.col("batch") != number)
            fresh = fresh.join(known.select(*keys), keys, "left_anti")
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("seen_day", "batch").parquet(path)

    return write


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Processes what there is and ends; call it again for what came since."""
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_every(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, interval: str = "300 seconds") -> StreamingQuery:
    """Polls for new input at a fixed interval until it is stopped; what waits between two polls is one batch."""
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def isolated(sinks: dict[str, Callable[[DataFrame, int], None]], by: str, failed: Callable[[str, int, Exception], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that gives each source's rows (``by``) to its own sink; one that fails is reported and does not stop the others."""

    def write(batch: DataFrame, number: int) -> None:
        for name, sink in sinks.items():
            try:
                sink(batch.where(F.col(by) == name), number)
            except Exception as error:  # noqa: BLE001
                failed(name, number, error)

    return write


def recent_unique(stream: DataFrame, keys: list[str] = KEYS, at: str = "observed_at", within: str = "2 days") -> DataFrame:
    """Repeats dropped with bounded state: those that arrive within the watermark of the first."""
    return stream.withWatermark(at, within).dropDuplicatesWithinWatermark(keys)


def tumbling(stream: DataFrame, at: str, late: str = "10 minutes", width: str = "5 minutes", keys: tuple[str, ...] = ()) -> DataFrame:
    """Counts per tumbling window; rows later than the watermark are out."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), *keys).agg(F.count(F.lit(1)).alias("n"))


def sliding(stream: DataFrame, at: str, late: str, width: str, step: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Counts per sliding window."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width, step), *keys).agg(F.count(F.lit(1)).alias("n"))


def sessions(stream: DataFrame, at: str, late: str, gap: str, keys: tuple[str, ...]) -> DataFrame:
    """Counts per session of each key."""
    return stream.withWatermark(at, late).groupBy(F.session_window(at, gap), *keys).agg(F.count(F.lit(1)).alias("n"))
