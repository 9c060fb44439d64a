"""Models of wait times: means for sparse entities, boosted trees for the rest."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuescope.operators.asof import nearest
from queuescope.operators.boosting import best_round as best_round
from queuescope.operators.boosting import boosted, end_of_bin
from queuescope.operators.features import impute
from queuescope.sources.sinks import read_json, write_json


def mean_models(training: DataFrame, target: str = "wait_time_minutes", below: int = 500) -> DataFrame:
    """entity_code, mean target and count of the entities with fewer than ``below`` target rows; 0.0 where all are null."""
    per = training.groupBy("entity_code").agg(F.coalesce(F.avg(target), F.lit(0.0)).alias("prediction"), F.count(target).alias("n"))
    return per.where(F.col("n") < below)


# Parameters of the boosted trees.
DEPTH, STEP, ROUNDS, PATIENCE, SUBSAMPLE, LEAST_ROWS, SEED = 6, 0.1, 2000, 50, 0.5, 10, 42


def fit_boosted(training: DataFrame, features: Sequence[str], target: str, *, split: str = "split", depth: int = DEPTH, step: float = STEP, rounds: int = ROUNDS, patience: int = PATIENCE, subsample: float = SUBSAMPLE, least_rows: int = LEAST_ROWS, seed: int = SEED) -> Any:
    """A pipeline of gradient-boosted trees with absolute error, cut after the best round on the rows whose ``split`` is validation.

    Rounds end once ``patience`` of them in a row bring nothing better there; without
    validation rows all are kept.  One model for all entities (their encoded code is a feature), fitted by
    :func:`queuescope.operators.boosting.boosted`: rows stay spread over the tasks, no entity's rows are ever on
    one machine unless all different rows are few.  The pipeline's ``bounds`` are those of the features' bins, for
    :func:`predict`; they are not saved with it.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    assembler = VectorAssembler(inputCols=list(features), outputCol="__features", handleInvalid="keep")
    rows = training.where(F.col(target).isNotNull()).withColumn(target, F.col(target).cast("double"))
    estimator = GBTRegressor(
        featuresCol="__features", labelCol=target, lossType="absolute", maxDepth=depth, stepSize=step, maxIter=rounds,
        subsamplingRate=subsample, minInstancesPerNode=least_rows, seed=seed,
    )
    trees, bounds = boosted(rows, features, target, split, estimator, patience)
    fitted = PipelineModel([assembler, trees])
    fitted.bounds = bounds
    return fitted


def fit_pair(training: DataFrame, features: Sequence[str], target: str, posted: str = "posted", kind: str = "wait_time_type", **options: Any) -> dict[str, Any]:
    """The two models of actual waits, ``with_posted`` (rows that have a posted time beside them) and ``without_posted``.

    Return times (PRIORITY rows) are trained without posted times only.  A model without training rows is None.
    """
    rows = training.where(F.col(target).isNotNull())
    paired = rows.where(F.col(posted).isNotNull() & ~F.coalesce(F.col(kind) == "PRIORITY", F.lit(False)))
    return {
        "with_posted": None if paired.isEmpty() else fit_boosted(paired, [*features, posted], target, **options),
        "without_posted": None if rows.isEmpty() else fit_boosted(rows, features, target, **options),
    }


def training_set(readings: DataFrame, features: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """Rows to train on: actual waits (entity, park_day, observed_us, ingest_seq, minutes) with their features, ``posted`` nearest in time on the same day, and gaps in features filled.

    ``features`` has one row per ingest_seq.
    """
    keys = ["entity", "park_day"]
    actual = readings.where((F.col("kind") == "ACTUAL") & F.col("minutes").isNotNull())
    posted = readings.where((F.col("kind") == "POSTED") & F.col("minutes").isNotNull())
    near = nearest(actual, posted, keys, "observed_us", "ingest_seq", "minutes", "ingest_seq").select("ingest_seq", F.col("minutes").alias("posted"))
    rows = actual.select("ingest_seq", *keys, F.col("kind").alias("wait_time_type"), F.col("minutes").alias("observed_wait_time")).join(near, "ingest_seq").join(features, "ingest_seq")
    return impute(rows, numeric, categorical)


def save_model(model: Any, path: str, metadata: dict[str, Any]) -> None:
    """A fitted pipeline and its metadata (JSON) below a folder; a model that is there is replaced."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/model")
    write_json(metadata, spark, f"{path}/metadata.json")


def load_model(path: str) -> tuple[Any, dict[str, Any]]:
    """A saved pipeline and its metadata."""
    from pyspark.ml import PipelineModel

    return PipelineModel.load(f"{path}/model"), read_json(SparkSession.active(), f"{path}/metadata.json", {})


def train_in_batches(entities: DataFrame, train: Callable[[DataFrame], DataFrame], batches: int, failed: Callable[[int, Exception], None]) -> list[DataFrame]:
    """``train`` for the entities in ``batches`` parts (by hash); a part that fails is reported and does not stop the others.

    Within a part Spark spreads the work over the cluster, so parts exist for isolation and for restarts, not for speed.
    """
    done = []
    for k in range(batches):
        part = entities.where(F.pmod(F.xxhash64("entity_code"), F.lit(batches)) == k)
        try:
            done.append(train(part))
        except Exception as error:  # noqa: BLE001
            failed(k, error)
    return done


def predict(model: Any, rows: DataFrame, features: Sequence[str], bounds: Sequence[list[float]] | None = None) -> DataFrame:
    """Adds ``prediction``, clamped at zero; missing features are 0.

    With the ``bounds`` of the bins that the model was fitted with, every tree is asked once for each cell of bins instead
    of once a row.  The answers are the same; the rows are read twice, so they should be a table.
    """
    from queuescope.functions.temporal import not_negative

    filled = rows.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("double") for c in features})
    if bounds is None:
        return model.transform(filled).withColumn("prediction", not_negative(F.col("prediction"))).drop("__features")
    ends = [f"__end_{f}" for f in features]
    placed = filled.withColumns({e: end_of_bin(f, limits) for e, f, limits in zip(ends, features, bounds, strict=True)})
    cells = placed.select(*[F.col(e).alias(f) for e, f in zip(ends, features, strict=True)]).distinct().repartition(rows.sparkSession.sparkContext.defaultParallelism)
    answers = model.transform(cells).select(*[F.col(f).alias(e) for e, f in zip(ends, features, strict=True)], not_negative(F.col("prediction")).alias("prediction"))
    return placed.join(answers, ends).drop(*ends)
