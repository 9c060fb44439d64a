"""Filling containers of fixed capacity with items of varying length.

Method: minimum bin slack.  A container starts with the largest item left; the
rest of it is filled with the multiset of remaining lengths, within a window of
``window`` items, whose sum comes closest to the space left.  The sums are found
by a bitset: bit s is set when s can be made, each length is added by shifting
(equal lengths in powers of two), and the counts are read back from the bitsets.

An item above the capacity fills whole containers of its own; its rest is an
item like any other.  Items are dealt by a hash of their row's number into shards of about
``shard_items``, packed independently; a shard leaves one poorly filled container at most,
and no task ever sees more than a shard.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuescope.session import cut

def byte_tokens(text: Column) -> Column:
    """Tokens of a byte-level tokenizer without merges: one per UTF-8 byte."""
    return F.octet_length(text).cast("bigint")


def best_fill(lengths: dict[int, int], space: int) -> dict[int, int]:
    """Counts per length of the sub-multiset whose sum is nearest to, and not above, ``space``."""
    steps: list[tuple[int, int, int]] = []
    sums, limit, full = 1, (1 << (space + 1)) - 1, 1 << space
    for length, count in lengths.items():
        take = 1
        while count > 0 and not sums & full:
            take = min(take, count)
            steps.append((length, take, sums))
            sums |= (sums << (length * take)) & limit
            count -= take
            take *= 2
    at, chosen = sums.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not at:
            break
        if not (before >> at) & 1:
            chosen[length] = chosen.get(length, 0) + take
            at -= length * take
    return chosen


def pack(sizes: list[int], capacity: int, window: int = 64) -> list[int]:
    """The container number of each item, for items of 1 to ``capacity``.

    Half of the window are the largest lengths that fit, the other half is spread
    over all shorter ones; lengths that equal each other count as one entry with
    as many copies as fit.
    """
    stacks: dict[int, list[int]] = {}
    for i, size in enumerate(sizes):
        stacks.setdefault(size, []).append(i)
    left = sorted(stacks)
    placed, number = [-1] * len(sizes), 0

    def use(length: int) -> None:
        stack = stacks[length]
        placed[stack.pop()] = number
        if not stack:
            del left[bisect_right(left, length) - 1]

    while left:
        space = capacity - left[-1]
        use(left[-1])
        fits = bisect_right(left, space)
        if fits:
            near = left[max(0, fits - window // 2) : fits]
            rest = max(0, fits - len(near))
            if rest:
                stride = max(1, -(-rest // (window - len(near))))
                near = left[:rest:stride] + near
            for length, count in best_fill({x: min(len(stacks[x]), space // x) for x in reversed(near)}, space).items():
                for _ in range(count):
                    use(length)
        number += 1
    return placed


def pack_items(items: DataFrame, item_id: str, tokens: str, capacities: Sequence[int] | Column, window: int = 64, shard_items: int = 10_000) -> DataFrame:
    """Where every piece of every item goes, for each capacity.

    Columns: capacity_tokens, the id, ``item_tokens``, ``piece`` (from 0), ``pieces``,
    ``piece_tokens`` and ``container``.  Items without tokens (null or 0) need no
    space: they come out once with no container.  Ids should be unique; rows
    that repeat an id are packed as items of their own, and dealt out like all others.
    ``capacities`` are numbers or an array column (such as a scalar subquery over a table
    of them); those that are null or not positive are left out, equal ones count once,
    and without any the result is empty.
    """
    listed = capacities if isinstance(capacities, Column) else F.array(*[F.lit(c) for c in capacities])
    wanted = F.array_distinct(listed.cast("array<bigint>"))
    narrow = cut(items.select(F.col(item_id).alias("id"), F.coalesce(F.col(tokens), F.lit(0)).cast("bigint").alias("item_tokens"), F.monotonically_increasing_id().alias("row")))
    shards = max(1, -(-narrow.count() // shard_items))
    each = narrow.select("id", "row", "item_tokens", F.explode(wanted).alias("capacity_tokens")).where(F.col("capacity_tokens") > 0)
    whole = F.floor(F.col("item_tokens") / F.col("capacity_tokens"))
    each = each.withColumns({"whole": F.when(F.col("item_tokens") > F.col("capacity_tokens"), whole).otherwise(F.lit(0)).cast("bigint")})
    each = each.withColumn("rest", F.col("item_tokens") - F.col("whole") * F.col("capacity_tokens"))
    each = each.withColumn("pieces", F.col("whole") + F.when(F.col("rest") > 0, 1).otherwise(0))
    out = ["capacity_tokens", "id", "item_tokens", "piece", "pieces", "piece_tokens", "container"]
    full = each.where(F.col("whole") > 0).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("whole") - 1)))
    full = full.withColumns({"piece_tokens": F.col("capacity_tokens"), "container": F.concat_ws("-", F.lit("w"), "row", "piece")}).select(*out)
    empty = each.where(F.col("pieces") == 0).withColumns({"piece": F.lit(0).cast("bigint"), "piece_tokens": F.lit(0).cast("bigint"), "container": F.lit(None).cast("string")}).select(*out)
    dealt = each.where(F.col("rest") > 0).withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["rest", "row"], kind="stable")
        numbers = pack(group["rest"].tolist(), int(group["capacity_tokens"].iloc[0]), window)
        shard = group["shard"].iloc[0]
        return pd.DataFrame({
            "capacity_tokens": group["capacity_tokens"], "id": group["id"], "item_tokens": group["item_tokens"], "piece": group["whole"],
            "pieces": group["pieces"], "piece_tokens": group["rest"], "container": [f"s-{shard}-{n}" for n in numbers],
        })

    kind = items.schema[item_id].dataType.simpleString()
    schema = f"capacity_tokens long, id {kind}, item_tokens long, piece long, pieces long, piece_tokens long, container string"
    packed = dealt.select("shard", "capacity_tokens", "id", "row", "item_tokens", "whole", "rest", "pieces").groupBy("capacity_tokens", "shard").applyInPandas(fill, schema)
    return full.unionByName(packed).unionByName(empty).withColumnRenamed("id", item_id)


def containers(packed: DataFrame) -> DataFrame:
    """Per capacity: containers used, tokens packed and the share of space unused."""
    per = packed.where(F.col("container").isNotNull()).groupBy("capacity_tokens", "container").agg(F.sum("piece_tokens").alias("used"), F.count(F.lit(1)).alias("items"))
    return per.groupBy("capacity_tokens").agg(
        F.count(F.lit(1)).alias("containers"),
        F.sum("used").alias("tokens"),
        F.sum("items").alias("items"),
        (1 - F.sum("used") / (F.count(F.lit(1)) * F.col("capacity_tokens"))).alias("unused_share"),
        F.max("used").alias("fullest"),
    )
