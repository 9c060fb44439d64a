"""Implausible readings: impossible, out of proportion, or stuck.

Method: a robust exponentially weighted control chart per source.  The chart
starts at the source's median and quartile spread; a value outside its control
limits is suspected and clipped to the limit before it updates mean and scale,
so that spikes do not move the chart while a lasting change of level does.
What lies beyond the chart's own limits is ``out_of_control``.  The limits used
for clipping never reach past the source's proportion limits, hence every
value that is out of proportion is suspected as well, and an exact test on the
suspects decides.  Physical limits and run-length counters for stuck values
are added.

Scale: a source of more than ``block_rows`` readings is cut into homes of about
that many, along blocks of time; a home also reads the blocks with the last
``warmup_rows`` readings before it, after which the chart has forgotten its
start (weight (1 - alpha)^warmup_rows).  Runs that touch the edge of a home are
stitched over homes exactly.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queuescope.constants import SOLD_OUT
from queuescope.operators.readings import with_source_key
from queuescope.session import cut


class Limits(NamedTuple):
    """Parameters of the tests; the defaults are those of the statement."""

    low: int = 0
    high: int = 1000
    priority_low: int = -100
    priority_high: int = 2000
    least_values: int = 20
    times_median: float = 3.0
    plus: float = 30.0
    low_share: float = 0.1
    low_from_median: float = 40.0
    run: int = 10
    equal_share: float = 0.8
    alpha: float = 0.1
    width: float = 4.0
    block_rows: int = 8192
    warmup_rows: int = 256
    block_us: int = 600_000_000


def possible(kind: Column, minutes: Column, limits: Limits) -> Column:
    """Whether a value is inside its type's physical limits."""
    return F.when(kind == "PRIORITY", minutes.between(limits.priority_low, limits.priority_high)).otherwise(minutes.between(limits.low, limits.high))


def chart(values: list[float], possible: list[bool], median: float, spread: float, top: float, bottom: float, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """(suspected, out of control) of a source's values in order; impossible values are passed over.

    ``top`` and ``bottom`` are the proportion limits, beyond which a value is suspected and clipped
    in any case.
    """
    suspected, beyond = np.zeros(len(values), bool), np.zeros(len(values), bool)
    centre, scale = median, max(1.0, spread / 1.349)
    alpha, width = limits.alpha, limits.width
    for i, (x, fine) in enumerate(zip(values, possible, strict=True)):
        if not fine:
            continue
        high, low = centre + width * scale, centre - width * scale
        if x > high or x < low:
            beyond[i] = True
        high, low = min(high, top), max(low, bottom)
        if x > high:
            suspected[i], x = True, high
        elif x < low:
            suspected[i], x = True, low
        step = x - centre
        centre += alpha * step
        scale += alpha * (1.2533 * abs(step) - scale)
        if scale < 1.0:
            scale = 1.0
    return suspected, beyond


#: What a row of a charted home is: a reading, the home's totals, a run at its edge.
_READING, _HOME, _EDGE = 0, 1, 2
_CHARTED = (
    "what int, source_key long, home long, ingest_seq long, minutes long, impossible boolean, suspected boolean, out_of_control boolean, disproportionate boolean, "
    "run long, n long, edge boolean, starts long"
)


def _charted(table: pa.Table, limits: Limits, everything: bool) -> pa.Table:
    """One home's readings with their flags, its totals, and its runs at either edge (``n`` is a run's length or the home's readings)."""
    column = {c: table.column(c).to_numpy() for c in ("ingest_seq", "observed_us", "minutes", "own", "warm")}
    order = np.lexsort((column["ingest_seq"], column["observed_us"]))
    seq, minutes, own = column["ingest_seq"][order], column["minutes"][order], column["own"][order] == column["warm"][order]
    first = {c: table.column(c)[0].as_py() for c in ("source_key", "warm", "kind", "median", "spread", "n_values", "homes")}
    low, high = (limits.priority_low, limits.priority_high) if first["kind"] == "PRIORITY" else (limits.low, limits.high)
    possible = (minutes >= low) & (minutes <= high)
    suspected = beyond = wrong = np.zeros(len(seq), bool)
    if first["n_values"] >= limits.least_values:
        median = first["median"]
        top = limits.times_median * median + limits.plus
        bottom = median * limits.low_share if first["kind"] == "POSTED" and median >= limits.low_from_median else -np.inf
        suspected, beyond = chart(minutes.tolist(), possible.tolist(), median, first["spread"], top, bottom, limits)
        wrong = suspected & possible & ((minutes > top) | (minutes < bottom))
    starts = np.ones(len(seq), np.int64)
    starts[1:] = minutes[1:] != minutes[:-1]
    # the source's first reading begins a run; a later home is never without warm-up
    seq, minutes, possible, suspected, beyond, wrong, starts = (x[own] for x in (seq, minutes, possible, suspected, beyond, wrong, starts))
    run = np.cumsum(starts)
    lengths = np.bincount(run)
    n, several = lengths[run], first["homes"] > 1
    edge = ((run == run[0]) | (run == run[-1])) & several
    keep = slice(None) if everything else ~possible | suspected | beyond | (n >= limits.run) | edge
    edges = np.unique(run[[0, -1]]) if several else np.empty(0, np.int64)
    rows, ends = len(seq[keep]), len(edges)

    def filled(readings: np.ndarray, home: int | bool, at_edges: np.ndarray | None = None) -> np.ndarray:
        return np.concatenate([readings[keep], [home], np.full(ends, home) if at_edges is None else at_edges])

    total = rows + 1 + ends
    arrays = [
        np.repeat([_READING, _HOME, _EDGE], [rows, 1, ends]).astype(np.int32), np.full(total, first["source_key"], np.int64), np.full(total, first["warm"], np.int64),
        filled(seq, 0), filled(minutes, 0), filled(~possible, False), filled(suspected, False), filled(beyond, False), filled(wrong, False),
        filled(run, 0, edges), filled(n, len(seq), lengths[edges]), filled(edge, False), filled(starts, int(starts.sum())),
    ]
    return pa.table([pa.array(a) for a in arrays], names=[c.split()[0] for c in _CHARTED.split(", ")])


def _normal(rows: DataFrame) -> DataFrame:
    """Per source: source_key, kind, all readings, possible values, their median and quartile spread; from one row per source and value."""
    per_value = rows.groupBy("source", "kind", "minutes", "possible").agg(F.count(F.lit(1)).alias("n"))
    inside, n = F.when(F.col("possible"), F.col("minutes")), F.when(F.col("possible"), F.col("n")).otherwise(0)
    quartiles = F.percentile(inside, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), n)
    per = per_value.groupBy("source", "kind").agg(F.sum("n").alias("n_rows"), F.sum(n).alias("n_values"), quartiles.alias("q"))
    return per.select("source", F.xxhash64("source").alias("source_key"), "kind", "n_rows", "n_values", F.col("q")[1].alias("median"), (F.col("q")[2] - F.col("q")[0]).alias("spread"))


def _homes(rows: DataFrame, normal: DataFrame, limits: Limits) -> DataFrame:
    """For the sources with more than ``block_rows`` readings: source_key, block, own (home), next (home it warms up, or null), homes."""
    hot = normal.where(F.col("n_rows") > limits.block_rows).select("source_key")
    blocks = rows.join(hot, "source_key", "left_semi").groupBy("source_key", "block").agg(F.count(F.lit(1)).alias("n"))
    up = Window.partitionBy("source_key").orderBy("block")
    before = F.coalesce(F.sum("n").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    home = blocks.withColumn("own", F.floor(before / limits.block_rows))
    rest = Window.partitionBy("source_key", "own").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # homes are numbered without gaps: a block above the size may step over a number
    dense = home.withColumns({"after": F.coalesce(F.sum("n").over(rest), F.lit(0)), "own": F.dense_rank().over(Window.partitionBy("source_key").orderBy("own")) - 1})
    last = F.max("own").over(Window.partitionBy("source_key"))
    return dense.select("source_key", "block", F.col("own").cast("bigint").alias("own"), F.when((F.col("after") < limits.warmup_rows) & (F.col("own") < last), F.col("own") + 1).cast("bigint").alias("next"), (last + 1).cast("bigint").alias("homes"))


def flag_spikes(readings: DataFrame, limits: Limits = Limits(), everything: bool = True) -> DataFrame:
    """Flags every reading: impossible, disproportionate, stuck, and the chart's suspected and out_of_control.

    Input: ingest_seq (unique), source, kind, observed_us, minutes.  Rows without
    minutes or instant and sold-out codes are no readings and are left out;
    rows at one instant keep their order of arrival.  An empty input gives an
    empty result; a source with fewer than ``least_values`` possible values has
    no chart.  Without ``everything`` readings with no flag at all are left out of the result.
    """
    sold_out = F.coalesce((F.col("kind") == "PRIORITY") & (F.col("minutes") == SOLD_OUT), F.lit(False))
    rows = with_source_key(readings).where(F.col("minutes").isNotNull() & F.col("observed_us").isNotNull() & ~sold_out)
    rows = rows.select("ingest_seq", "source", "source_key", F.coalesce("kind", F.lit("")).alias("kind"), "observed_us", "minutes")
    normal = cut(_normal(rows.withColumn("possible", possible(F.col("kind"), F.col("minutes"), limits))))
    placed = rows.withColumn("block", F.floor(F.col("observed_us") / F.lit(limits.block_us))).drop("source", "kind")
    homes = cut(_homes(placed, normal, limits))
    own = F.coalesce("own", F.lit(0).cast("bigint"))
    dealt = placed.join(homes, ["source_key", "block"], "left").select(
        "source_key", F.explode(F.array_compact(F.array(own, F.col("next")))).alias("warm"), own.alias("own"), F.coalesce("homes", F.lit(1).cast("bigint")).alias("homes"), "ingest_seq", "observed_us", "minutes"
    )
    spread = dealt.join(normal.drop("source", "n_rows"), "source_key")
    charted = cut(spread.groupBy("source_key", "warm").applyInArrow(lambda table: _charted(table, limits, everything), _CHARTED))
    totals = charted.where(F.col("what") == _HOME).select("source_key", "home", "starts", "n")
    up = Window.partitionBy("source_key").orderBy("home").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("source_key", "home", F.coalesce(F.sum("starts").over(up), F.lit(0)).alias("before"))
    # the runs at edges are numbered over all homes; equal neighbours = readings - runs, neighbours = readings - 1
    numbered = charted.where(F.col("what") == _EDGE).select("source_key", "home", "run", "n").join(before, ["source_key", "home"]).withColumn("whole", F.col("before") + F.col("run"))
    lengths = numbered.groupBy("source_key", "whole").agg(F.sum("n").alias("length"))
    edges = numbered.join(lengths, ["source_key", "whole"]).select("source_key", "home", "run", "length")
    lively = totals.groupBy("source_key").agg((F.sum("n") - F.sum("starts") <= limits.equal_share * (F.sum("n") - 1)).alias("lively"))
    found = charted.where(F.col("what") == _READING).join(edges, ["source_key", "home", "run"], "left").join(lively, "source_key").join(normal.select("source_key", "source"), "source_key")
    length = F.coalesce("length", "n")
    stuck = F.col("lively") & (length >= limits.run)
    flags = found.select("ingest_seq", "source", "minutes", "impossible", "suspected", "out_of_control", "disproportionate", stuck.alias("stuck"), F.when(stuck, length).otherwise(F.lit(0)).alias("run_length"))
    return flags if everything else flags.where(F.col("impossible") | F.col("suspected") | F.col("out_of_control") | F.col("disproportionate") | F.col("stuck"))
