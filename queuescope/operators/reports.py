"""Validation, accuracy and coverage reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuescope.functions.parse import validity
from queuescope.operators.aggregates import exact_medians, fallback_lookup
from queuescope.operators.ordered import null_safe_join


def bin_label(value: Column, edges: Sequence[float]) -> Column:
    """Index of the half-open bin of a value, the last one open-ended; null below the first edge."""
    out = F.when(value < edges[0], None)
    for i, high in enumerate(edges[1:]):
        out = out.when(value < high, i)
    return out.when(value.isNotNull(), len(edges) - 1)


def error_metrics(frame: DataFrame, keys: Sequence[str], observed: str, predicted: str) -> DataFrame:
    """MAE, median error, RMSE, mean and median percent error and R² per group; percent errors leave out zero observations.

    R² is one minus the residual over the total square sum, null for a constant target.  Null
    keys are a key.  Medians are exact, by a bracket and a count (see :func:`exact_medians`).
    """
    error = F.col(predicted) - F.col(observed)
    rows = frame.where(F.col(observed).isNotNull() & F.col(predicted).isNotNull()).select(
        *keys, F.col(observed).alias("__o"), error.alias("__e"), F.abs(error).alias("__a"), F.when(F.col(observed) > 0, F.abs(error) / F.col(observed) * 100).alias("__p")
    )
    total = F.var_pop("__o") * F.count("__o")
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("__a").alias("mae"),
        F.sqrt(F.avg(F.col("__e") * F.col("__e"))).alias("rmse"),
        F.avg("__p").alias("mape"),
        F.when(total > 0, 1 - F.sum(F.col("__e") * F.col("__e")) / total).alias("r2"),
    )
    medians = {"median_error": exact_medians(rows, keys, "__a", "median_error"), "median_ape": exact_medians(rows, keys, "__p", "median_ape")}
    if not keys:
        return sums.withColumns({name: m.scalar() for name, m in medians.items()})
    for m in medians.values():
        sums = null_safe_join(sums, m, keys)
    return sums


def binned_metrics(frame: DataFrame, binnings: dict[str, Column], errors: dict[str, str], rates: dict[str, str] | None = None) -> DataFrame:
    """One row per binning and bin: ``binning``, ``bin`` (text), n, ``mean_{e}`` and ``median_{e}`` per error, ``{r}_rate`` in percent per rate.

    All binnings come from one pass: a row is given to each of its bins, and rows without a bin in a binning are
    left out of that one.  ``errors`` and ``rates`` name result and column.
    """
    bins = F.array(*[F.struct(F.lit(name).alias("binning"), value.cast("string").alias("bin")) for name, value in binnings.items()])
    named = {**errors, **(rates or {})}
    rows = frame.select(F.inline(bins), *[F.col(c).alias(f"__{n}") for n, c in named.items()]).where(F.col("bin").isNotNull())
    keys = ["binning", "bin"]
    out = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f"__{e}").alias(f"mean_{e}") for e in errors], *[(F.avg(F.col(f"__{r}").cast("double")) * 100).alias(f"{r}_rate") for r in rates or {}]
    )
    for e in errors:
        out = null_safe_join(out, exact_medians(rows, keys, f"__{e}", f"median_{e}"), keys)
    return out


def half_open(value: Column, edges: Sequence[float], open_end: bool = True) -> Column:
    """Text of the half-open bin ``low-high`` of a value, ``low+`` for the last one; null outside (a bin ends before its upper edge)."""
    out = F.when(value < edges[0], None)
    for low, high in zip(edges, edges[1:], strict=False):
        out = out.when(value < high, f"{low}-{high}")
    return out.when(value.isNotNull(), f"{edges[-1]}+") if open_end else out


def posted_accuracy(observed: DataFrame, aggregates: DataFrame, today: str) -> DataFrame:
    """Observed posted times (entity_code, park_code, park_date, dategroupid, hour, wait_time_minutes, ...) with the predicted ones.

    Adds predicted, level, error, pct_error (null for a zero observation), the group's avg_recency_weight and
    posted_count, and days_ago.  Rows without a value or a prediction are left out.
    """
    rows = fallback_lookup(observed.where(F.col("wait_time_minutes").isNotNull()), aggregates).where(F.col("predicted").isNotNull())
    error = F.abs(F.col("predicted") - F.col("wait_time_minutes"))
    own = aggregates.select("entity_code", "dategroupid", "hour", "avg_recency_weight", "posted_count")
    return rows.join(own.hint("merge"), ["entity_code", "dategroupid", "hour"], "left").withColumns({
        "error": error,
        "pct_error": F.when(F.col("wait_time_minutes") > 0, error / F.col("wait_time_minutes") * 100),
        "days_ago": F.datediff(F.lit(today).cast("date"), "park_date"),
    })


def posted_accuracy_bins(rows: DataFrame) -> DataFrame:
    """The accuracy of :func:`posted_accuracy` overall and by recency weight, sample size, park, hour and age."""
    binnings = {
        "overall": F.lit("all"),
        "weight": half_open(F.col("avg_recency_weight"), [0.0, 0.3, 0.5, 0.7, 0.9, 1.0], open_end=False),
        "count": half_open(F.col("posted_count"), [0, 10, 50, 100, 500]),
        "park": F.col("park_code"),
        "hour": F.col("hour"),
        "days_ago": half_open(F.col("days_ago"), [0, 7, 30, 90, 180, 365]),
    }
    return binned_metrics(rows, binnings, {"error": "error", "pct_error": "pct_error"})


def donor_accuracy(hours: DataFrame, least_confidence: float = 0.0, source: str | None = "donor_imputation") -> DataFrame:
    """Predicted against official hours of a park and date: errors of opening and closing in minutes, flag matches, days ahead.

    ``hours``: hours_id, park, park_day, version_type, source, created_at, confidence, opening_minute, closing_minute (of the local
    day, null ones are left out), emh_morning, emh_evening.  The official row is the one of lowest hours_id; ``source`` None takes
    predictions of any origin.
    """
    flags = {f: F.coalesce(F.col(f), F.lit(False)) for f in ("emh_morning", "emh_evening")}
    rows = hours.withColumns(flags).where(F.col("opening_minute").isNotNull() & F.col("closing_minute").isNotNull())
    kind = F.lower(F.trim("version_type"))
    predicted = rows.where((kind == "predicted") & (F.coalesce("confidence", F.lit(0.0)) >= least_confidence))
    if source is not None:
        predicted = predicted.where(F.col("source") == source)
    fields = ("opening_minute", "closing_minute", "emh_morning", "emh_evening")
    official = rows.where(kind == "official").groupBy("park", "park_day").agg(F.min_by(F.struct(*fields), "hours_id").alias("__o"))
    joined = predicted.join(official, ["park", "park_day"])
    return joined.select(
        "hours_id", "park", "park_day", "confidence",
        F.abs(F.col("opening_minute") - F.col("__o.opening_minute")).alias("opening_error"),
        F.abs(F.col("closing_minute") - F.col("__o.closing_minute")).alias("closing_error"),
        *[(F.col(f) == F.col(f"__o.{f}")).alias(f"{f}_match") for f in ("emh_morning", "emh_evening")],
        F.datediff("park_day", F.col("created_at").cast("date")).alias("days_until"),
    )


def donor_accuracy_bins(rows: DataFrame) -> DataFrame:
    """The accuracy of :func:`donor_accuracy` overall and by confidence, park and days ahead."""
    binnings = {
        "overall": F.lit("all"),
        "confidence": half_open(F.col("confidence"), [0.0, 0.5, 0.7, 0.9, 1.0], open_end=False),
        "park": F.col("park"),
        "days_until": half_open(F.col("days_until"), [0, 30, 60, 90, 180, 365]),
    }
    return binned_metrics(rows, binnings, {"opening_error": "opening_error", "closing_error": "closing_error"}, {"emh_morning_match": "emh_morning_match", "emh_evening_match": "emh_evening_match"})


def first_per_group(frame: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group; Spark keeps only the heads before the shuffle."""
    return frame.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__r") <= n).drop("__r")


def profile(frame: DataFrame, samples: int = 3) -> DataFrame:
    """Per column: its type, rows, nulls and their percent, empty texts, and the ``samples`` least different values as text.

    One pass for the counts; the samples are read per column by a distinct top-k.
    """
    counts = []
    for c, kind in frame.dtypes:
        empty = F.count_if(F.col(c) == "") if kind == "string" else F.lit(0).cast("bigint")
        row = F.struct(
            F.lit(c).alias("column_name"), F.lit(kind).alias("type"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(c).isNull()).alias("n_null"),
            F.round(100 * F.count_if(F.col(c).isNull()) / F.nullif(F.count(F.lit(1)), F.lit(0)), 6).alias("null_percent"), empty.alias("n_empty"),
        )
        counts.append(row.alias(f"s_{c}"))
    summary = frame.agg(*counts).select(F.inline(F.array(*[F.col(f"s_{c}") for c in frame.columns])))
    if not samples:
        return summary
    examples = None
    for c, kind in frame.dtypes:
        # a long text is its first 80 characters here
        shown = F.substring(F.col(c).cast("string"), 1, 80)
        least = frame.where(F.col(c).isNotNull()).select(shown.alias("v")).distinct().orderBy("v").limit(samples)
        listed = least.agg(F.sort_array(F.collect_list("v")).alias("samples")).select(F.lit(c).alias("column_name"), F.concat_ws(" | ", "samples").alias("samples"))
        examples = listed if examples is None else examples.unionByName(listed)
    return summary.join(examples, "column_name", "left")


def row_counts(spark: SparkSession, paths: dict[str, str], quick: bool = False) -> DataFrame:
    """Per named Parquet table: whether it is there, and its rows (null where it is absent, or with ``quick``, which reads no table)."""
    rows = []
    for name, path in paths.items():
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        present = bool(folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder))
        rows.append((name, present, spark.read.parquet(path).count() if present and not quick else None))
    return spark.createDataFrame(rows, "table_name string, present boolean, n_rows bigint")


def distinct_counts(frame: DataFrame, columns: Sequence[str], combinations: Sequence[Sequence[str]] = ()) -> DataFrame:
    """One row: different values per column (``n_{c}``) and different combinations (``n_{a}_{b}``); nulls are no values, a combination may hold them."""
    singles = [F.count_distinct(c).alias(f"n_{c}") for c in columns]
    several = [F.count_distinct(F.struct(*cs)).alias("n_" + "_".join(cs)) for cs in combinations]
    return frame.agg(*singles, *several)


def value_counts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column: column_name, value (text, null for nulls), n."""
    values = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return frame.select(F.inline(values)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def index_summary(index: DataFrame, counts: Sequence[str] = ("actual_count", "posted_count", "priority_count")) -> DataFrame:
    """Per count column of the entity index: entities, how many have a count above zero, the sum and the mean."""
    rows = index.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in counts])))
    return rows.groupBy("column_name").agg(F.count(F.lit(1)).alias("entities"), F.count_if(F.col("v") > 0).alias("with_any"), F.sum("v").alias("total"), F.avg("v").alias("mean"))


def coverage_summary(facts: DataFrame, file: Column, keys: Sequence[str] = ("park_code",), date: str = "park_date") -> DataFrame:
    """Per park: files, rows, different dates, first and last date."""
    return facts.groupBy(*keys).agg(F.count_distinct(file).alias("n_files"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct(date).alias("n_dates"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def validation_report(rows: DataFrame, file: Column, kind: Column, text: Column) -> DataFrame:
    """Total, invalid and outlying values per file, and over all files (file null)."""
    valid, outlier = validity(kind, text)
    marked = rows.select(file.alias("file"), (~valid).alias("__bad"), outlier.alias("__out"))
    return marked.groupingSets([["file"], []], "file").agg(F.grouping("file").alias("is_total"), F.count(F.lit(1)).alias("total"), F.count_if("__bad").alias("invalid"), F.count_if("__out").alias("outliers"))


def coverage(grid: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of facts per cell of a grid, 0 where there are none."""
    counted = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return grid.join(counted, list(keys), "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
