"""Boosted regression trees with absolute error, fitted over the different binned rows in one barrier stage.

Spark's own boosting starts several jobs for every level of every tree, so its time goes into starting jobs, and its early
stopping has no patience.  Here every feature is cut into bins as there; rows that agree in all bins, target and
split become one with a count; and tasks that keep these in memory exchange the histograms of each level.  What a
tree answers depends on the bins alone, so a round looks at each cell of bins once, however many rows it has.
The result is a model of Spark ML.
"""

from __future__ import annotations

import json
import secrets
import socket
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuescope.session import cut, shared_folder

# Bins of a feature (Spark's default); different rows of bins, and values of rows that differ in bins, target or split, that a task takes before another one is used.
BINS, TASK_ROWS, TASK_VALUES = 32, 50_000, 4_000_000

#: Of a tree's nodes: id (from 1, children of k are 2k and 2k + 1), mean, (weight, sum, squares), feature or -1, bin and gain.
_Nodes = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def best_round(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """The round of least error before ``patience`` rounds in a row bring nothing better, and whether they do."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best, True
    return best, False


def _thresholds(train: DataFrame, feature: str) -> list[float]:
    """Upper bounds of all bins but the last: between the values where there are few, else quantiles."""
    values = train.select(F.col(feature).cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    few = sorted(r[0] for r in values.distinct().limit(BINS + 1).collect())
    if len(few) <= BINS:
        return [(a + b) / 2 for a, b in zip(few, few[1:], strict=False)]
    return sorted(set(values.agg(F.percentile_approx("x", [i / BINS for i in range(1, BINS)], 10_000)).first()[0]))


class _Exchange:
    """Sums over the tasks of a barrier stage, by sockets to the first of them; the stage's own exchange sleeps for a second at each call."""

    def __init__(self, context: Any) -> None:
        infos = context.getTaskInfos()
        self.first, self.peers, self.readers = context.partitionId() == 0, [], []
        if len(infos) == 1:
            return
        host = infos[0].address.rpartition(":")[0].strip("[]")
        server = socket.create_server((host, 0), family=socket.AF_INET6 if ":" in host else socket.AF_INET, backlog=len(infos)) if self.first else None
        port, secret = json.loads(context.allGather(json.dumps([server.getsockname()[1], secrets.token_hex(16)]) if server else "")[0])
        if server:
            with server:
                known: dict[int, tuple] = {}
                while len(known) < len(infos) - 1:
                    peer = server.accept()[0]
                    reader = peer.makefile("rb")
                    token, _, number = reader.readline(100).decode(errors="replace").strip().partition(" ")
                    if token == secret:
                        known[int(number)] = peer, reader
                    else:
                        peer.close()
            self.peers, self.readers = map(list, zip(*[known[k] for k in sorted(known)], strict=True))  # sums don't depend on who came first
        else:
            peer = socket.create_connection((host, port))
            peer.sendall(f"{secret} {context.partitionId()}\n".encode())
            self.peers, self.readers = [peer], [peer.makefile("rb")]
        for peer in self.peers:
            peer.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)

    def _read(self, reader: Any, like: np.ndarray) -> np.ndarray:
        got = reader.read(like.nbytes)
        if len(got) < like.nbytes:
            raise ConnectionError("another task of the stage has ended")
        return np.frombuffer(got).reshape(like.shape)

    def total(self, own: np.ndarray) -> np.ndarray:
        """The sum over all tasks, the same in each of them."""
        own = np.array(own, np.float64, order="C")
        if not self.first:
            self.peers[0].sendall(own.tobytes())
            return self._read(self.readers[0], own)
        for reader in self.readers:
            own += self._read(reader, own)
        for peer in self.peers:
            peer.sendall(own.tobytes())
        return own

    def close(self) -> None:
        for x in (*self.readers, *self.peers):
            x.close()


class _Targets:
    """The different targets of every cell in order, each with its count."""

    def __init__(self, cell: np.ndarray, target: np.ndarray, count: np.ndarray, n_cells: int) -> None:
        self.cell, self.target, self.count = cell, target, count
        self.values = np.unique(target)
        self.base = np.arange(n_cells) * (len(self.values) + 1)
        self.keys = self.base[cell] + np.searchsorted(self.values, target)
        self.first, self.end = np.searchsorted(cell, np.arange(n_cells)), np.searchsorted(cell, np.arange(n_cells), "right")
        self.counts, self.sums = np.append(0, np.cumsum(count)), np.append(0.0, np.cumsum(count * target))

    def parted(self, fitted: np.ndarray, *running: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of counts and sums, in each cell the part of targets below what is fitted, and the rest."""
        at = np.searchsorted(self.keys, self.base + np.searchsorted(self.values, fitted))
        return [(x[at] - x[self.first], x[self.end] - x[at]) for x in running]

    def error(self, fitted: np.ndarray) -> float:
        """The sum of absolute errors."""
        (n_below, n_rest), (below, rest) = self.parted(fitted, self.counts, self.sums)
        return float(((n_below - n_rest) * fitted - below + rest).sum())


class _Cells:
    """The rows of one task by cells: those that agree in all bins get the same from every tree."""

    def __init__(self, batches: Iterable[pa.RecordBatch], n_features: int) -> None:
        columns = [np.concatenate(c) for c in zip(*[[b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)] for b in batches], strict=True)] or [np.empty(0)] * (n_features + 3)
        *bins, target, held, count = columns
        order = np.lexsort((held, target, *bins))  # the samples must not depend on the order in which rows arrive
        sorted_bins = np.array(bins)[:, order]
        new = np.ones(len(order), bool)
        new[1:] = (sorted_bins[:, 1:] != sorted_bins[:, :-1]).any(axis=0)
        cell, target, held, count = np.cumsum(new) - 1, target[order], held[order].astype(bool), count[order].astype(np.int64)
        self.bins = sorted_bins[:, new].astype(np.int64)
        self.fitted = np.zeros(self.bins.shape[1])
        self.train, self.held = (_Targets(cell[k], target[k], count[k], len(self.fitted)) for k in (~held, held))


def _tree(cells: _Cells, total: Callable[[np.ndarray], np.ndarray], w: np.ndarray, s: np.ndarray, q: np.ndarray, depth: int, least_rows: int) -> tuple[_Nodes, np.ndarray]:
    """A tree by the gain in variance for the cells' weights, sums and squares: its nodes, and the mean at which each cell ends."""
    n_features, size = len(cells.bins), 2 << depth
    parts, which = ([w, s], [0, 1, 0]) if q is w else ([w, s, q], [0, 1, 2])
    node, sums, real = np.ones(len(w), np.int64), np.zeros((size, 3)), np.zeros(size, bool)
    feature, at, gains = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
    sums[1], real[1] = total(np.array([x.sum() for x in parts]))[which], True
    used = np.flatnonzero(w)
    for level in range(depth):
        n = first = 1 << level
        here = node[used] - first
        part, here = used[here >= 0], here[here >= 0]
        values = [x[part] for x in parts]
        own = np.zeros((n_features, len(parts), n, BINS))
        for f in range(n_features):
            key = here * BINS + cells.bins[f, part]
            for k, x in enumerate(values):
                own[f, k] = np.bincount(key, x, n * BINS).reshape(n, BINS)
        left = np.cumsum(total(own), axis=3)[..., :-1]
        whole = sums[first : 2 * first, : len(parts)].T[None, :, :, None]
        right = whole - left
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (left[:, 1] ** 2 / left[:, 0] + right[:, 1] ** 2 / right[:, 0] - whole[:, 1] ** 2 / whole[:, 0]) / whole[:, 0]
        gain = np.where((left[:, 0] >= least_rows) & (right[:, 0] >= least_rows), gain, 0.0)
        best = gain.transpose(1, 0, 2).reshape(n, -1)
        chosen = best.argmax(axis=1)
        i = np.flatnonzero(best.max(axis=1) > 1e-12)
        if not len(i):
            break
        f, b = np.divmod(chosen[i], BINS - 1)
        of, there = first + i, (f[:, None], np.array([which]), i[:, None], b[:, None])
        feature[of], at[of], gains[of] = f, b, best[i, chosen[i]]
        sums[2 * of], sums[2 * of + 1] = left[there], right[there]
        real[2 * of] = real[2 * of + 1] = True
        splits = feature[node]
        to = 2 * node + (cells.bins[np.maximum(splits, 0), np.arange(len(node))] > at[node])
        node = np.where(splits >= 0, to, node)
    mean = sums[:, 1] / np.maximum(sums[:, 0], 1)
    ids = np.flatnonzero(real)
    return (ids, mean[ids], sums[ids], feature[ids], at[ids], gains[ids]), mean[node]


def _boost(cells: _Cells, total: Callable[[np.ndarray], np.ndarray], partition: int, watched: bool, rounds: int, patience: int, depth: int, step: float, subsample: float, least_rows: int, seed: int) -> list[_Nodes]:
    """The trees up to the best round; the first one for the target, later ones for the direction of the rest."""
    train, n_cells = cells.train, len(cells.fitted)
    trees: list[_Nodes] = []
    errors: list[float] = []
    for i in range(rounds):
        draw = np.random.default_rng([seed, partition, i]).binomial
        if i == 0:
            weight = draw(train.count, subsample)
            w, s, q = (np.bincount(train.cell, weight * x, n_cells) for x in (1.0, train.target, train.target**2))
        else:
            below, rest = (draw(n, subsample) for n in train.parted(cells.fitted, train.counts)[0])
            w, s = (rest + below).astype(float), (rest - below).astype(float)
            q = w
        nodes, answer = _tree(cells, total, w, s, q, depth, least_rows)
        cells.fitted += answer * (1.0 if i == 0 else step)
        trees.append(nodes)
        if watched:
            errors.append(float(total(np.array([cells.held.error(cells.fitted)]))[0]))
            best, stopped = best_round(errors, patience)
            if stopped:
                break
    return trees[: best + 1] if watched else trees


def _saved(trees: list[_Nodes], first: int, bounds: list[list[float]]) -> pa.RecordBatch:
    """The nodes of trees as Spark saves them: numbered from 0 without gaps in each tree, parents first."""
    ids, mean, sums, feature, at, gains = (np.concatenate(x) for x in zip(*trees, strict=True))
    sizes = [len(t[0]) for t in trees]
    number = np.concatenate([np.arange(n) for n in sizes])
    leaf = feature < 0
    left, right = (np.where(leaf, -1, np.concatenate([np.searchsorted(t[0], 2 * t[0] + k) for t in trees])) for k in (0, 1))
    limits = np.array([bounds[f][b] for f, b in zip(feature[~leaf], at[~leaf], strict=True)], np.float64)
    impurity = np.where(sums[:, 0] > 0, sums[:, 2] / np.maximum(sums[:, 0], 1) - mean * mean, 0.0)
    lists = lambda ends, values: pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(values))
    split = {"featureIndex": pa.array(feature, pa.int32()), "leftCategoriesOrThreshold": lists(np.cumsum(~leaf), limits), "numCategories": pa.array(np.full(len(ids), -1), pa.int32())}
    data = {
        "id": pa.array(number, pa.int32()), "prediction": pa.array(mean), "impurity": pa.array(impurity), "impurityStats": lists(np.arange(1, len(ids) + 1) * 3, sums.ravel()), "rawCount": pa.array(sums[:, 0].astype(np.int64)),
        "gain": pa.array(np.where(leaf, -1.0, gains)), "leftChild": pa.array(left, pa.int32()), "rightChild": pa.array(right, pa.int32()), "split": pa.StructArray.from_arrays(split.values(), split.keys()),
    }
    tree = np.repeat(np.arange(first, first + len(trees)), sizes)
    return pa.RecordBatch.from_arrays([pa.array(tree, pa.int32()), pa.StructArray.from_arrays(data.values(), data.keys())], names=["treeID", "nodeData"])


def bin_of(feature: str, limits: list[float]) -> Column:
    """The number of a feature's bin, from 0; missing values are in the last one."""
    x = F.coalesce(F.col(feature).cast("double"), F.lit(float("nan")))
    return F.size(F.filter(F.array(*map(F.lit, limits)), lambda t: t < x)) if limits else F.lit(0)


def end_of_bin(feature: str, limits: list[float]) -> Column:
    """The upper bound of a feature's bin, infinity for the last one: trees give it the same answer as the value itself."""
    return F.get(F.array(*map(F.lit, [*limits, float("inf")])), bin_of(feature, limits))


def boosted(rows: DataFrame, features: Sequence[str], target: str, split: str, estimator: Any, patience: int) -> tuple[Any, list[list[float]]]:
    """The model of a ``GBTRegressor``'s parameters, fitted to the rows whose ``split`` is train and cut after the best round on those of validation; and the upper bounds of each feature's bins but the last."""
    train = rows.where(F.col(split) == "train")
    bounds = [_thresholds(train, f) for f in features]
    names = [f"b{i}" for i in range(len(features))]
    binned = rows.where(F.col(split).isin("train", "validation")).select(
        *[bin_of(f, limits).cast("int").alias(b) for f, limits, b in zip(features, bounds, names, strict=True)], F.col(target).cast("double").alias("y"), (F.col(split) == "validation").cast("int").alias("held")
    )
    different = cut(binned.groupBy(*names, "y", "held").agg(F.count(F.lit(1)).alias("n")))
    in_cells = different.groupBy(*names).agg(F.count_if(F.col("held") == 0).alias("train"), F.count_if(F.col("held") == 1).alias("held"))
    n_cells, n_train, n_held = in_cells.agg(F.count(F.lit(1)), F.sum("train"), F.sum("held")).first()
    if not n_train:
        raise ValueError("no rows to train on")
    values = (n_train + n_held) * (len(features) + 3)
    tasks = max(1, min(rows.sparkSession.sparkContext.defaultParallelism, max(-(-n_cells // TASK_ROWS), -(-values // TASK_VALUES))))
    how = (n_held > 0, estimator.getMaxIter(), patience, estimator.getMaxDepth(), estimator.getStepSize(), estimator.getSubsamplingRate(), estimator.getMinInstancesPerNode(), estimator.getSeed())
    n_features = len(features)

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import BarrierTaskContext

        context = BarrierTaskContext.get()
        partition = context.partitionId()
        exchange = _Exchange(context)
        try:
            trees = _boost(_Cells(batches, n_features), exchange.total, partition, *how)
        finally:
            exchange.close()
        if partition == 0:
            yield from (_saved(trees[i : i + 100], i, bounds) for i in range(0, len(trees), 100))

    dealt = different.repartition(tasks, *names, "y")
    return _as_spark(rows.sparkSession, dealt.mapInArrow(fit, _NODES, barrier=True), bounds, estimator), bounds


_NODES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, leftChild: int, rightChild: int, "
    "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def _as_spark(spark: SparkSession, nodes: DataFrame, bounds: list[list[float]], estimator: Any) -> Any:
    """The trees as a model of Spark ML with the estimator's parameters.

    Nodes made one by one through the gateway take minutes, so a model of one leaf is saved,
    its tables are written anew with all nodes, which never pass through the driver's Python, and Spark loads it.
    """
    from pyspark.ml.regression import GBTRegressionModel

    context = spark.sparkContext
    jvm, new_array = context._jvm, context._gateway.new_array
    ml = jvm.org.apache.spark.ml
    leaf = ml.tree.LeafNode(0.0, 0.0, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(new_array(jvm.double, 3), 0))
    models, weights = new_array(ml.regression.DecisionTreeRegressionModel, 1), new_array(jvm.double, 1)
    models[0], weights[0] = ml.regression.DecisionTreeRegressionModel(f"{estimator.uid}_0", leaf, len(bounds)), 1.0
    estimator._transfer_params_to_java()
    java = estimator._java_obj
    shell = java.copyValues(ml.regression.GBTRegressionModel(java.uid(), models, weights, len(bounds)), java.extractParamMap())
    place = f"{shared_folder(spark, 'model')}/boosted"
    shell.write().overwrite().save(place)
    nodes.write.mode("overwrite").parquet(f"{place}/data")
    n_trees = spark.read.parquet(f"{place}/data").agg(F.max("treeID") + 1).first()[0]
    metadata = json.loads(spark.read.text(f"{place}/metadata").first()[0]) | {"numTrees": n_trees}
    of_tree = json.loads(spark.read.parquet(f"{place}/treesMetadata").first()[1])
    described = [(k, json.dumps(of_tree | {"uid": f"{estimator.uid}_{k}"}), 1.0 if k == 0 else float(estimator.getStepSize())) for k in range(n_trees)]
    spark.createDataFrame([(json.dumps(metadata),)], "value string").coalesce(1).write.mode("overwrite").text(f"{place}/metadata")
    spark.createDataFrame(described, "_1 int, _2 string, _3 double").write.mode("overwrite").parquet(f"{place}/treesMetadata")
    return GBTRegressionModel.load(place)
