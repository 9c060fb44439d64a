"""Queries over whole tables for the operators of this package."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuescope.llm.chunks import ChunkStore, repeated
from queuescope.llm.leak import leaks
from queuescope.llm.packing import byte_tokens, containers, pack_items
from queuescope.llm.quality import quality
from queuescope.llm.quantiles import DEFAULT_K, merge, percentiles, rank_error, sketches
from queuescope.operators.readings import typed_readings
from queuescope.session import cut, shared_folder, table


#: Loads in which p3 takes the batches, in order of batch_id; the pairs do not depend on it.
LOADS = 3


def _pairs(spark: SparkSession, d: str, loads: int = LOADS) -> DataFrame:
    """All pairs, load by load through a store in the shared folder that begins empty."""
    rows = typed_readings(table(spark, d, "dedupe_keys"), ("ingest_seq", "batch_id", "source", "source_key", "observed_us", "minutes"))
    store = ChunkStore(spark, shared_folder(spark, "chunks"))
    low, high = rows.agg(F.min("batch_id"), F.max("batch_id")).first()
    number = F.coalesce(F.floor((F.col("batch_id") - F.lit(low)) * loads / F.lit(high - low + 1)), F.lit(0)) if low is not None else F.lit(0)
    found = [store.accept(k, rows.where(number == k)) for k in range(loads)]
    return reduce(lambda a, b: a.unionByName(b), found)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of readings that report one thing, by their shared chunks."""
    return _pairs(spark, d).select("ingest_seq_a", "ingest_seq_b")


def p3_repeats(spark: SparkSession, d: str) -> DataFrame:
    """Every reading that reports a known one again, with the first it repeats."""
    return repeated(_pairs(spark, d))


def p7_by_build(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of posted_median per build, date group and hour."""
    return percentiles(sketches(table(spark, d, "posted_aggregates"), ["built_on", "dategroupid", "hour"], "posted_median"))


def p7_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of posted_median per date group and hour over all builds, merged from those of the builds."""
    per_build = sketches(table(spark, d, "posted_aggregates"), ["built_on", "dategroupid", "hour"], "posted_median")
    return percentiles(merge(per_build, ["dategroupid", "hour"]))


def _checked(rows: DataFrame, parts: list[str], keys: list[str], value: str, ranks: tuple[float, ...], k: int) -> DataFrame:
    """Per group: its values, and whether the merged answers' exact ranks keep the bound as often as it promises."""
    real = rows.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(*parts, F.col(value).cast("double").alias("v"))
    answers = percentiles(merge(sketches(real, parts, "v", k), keys, k), ranks, k)
    asked = F.array(*[F.struct(F.lit(r).alias("rank"), F.col(f"p{round(r * 100):02d}").alias("answer")) for r in ranks])
    # values of a group are counted once each, so the join sees different values only
    counted = real.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("c"))
    ranked = counted.join(answers.select(*keys, F.inline(asked)), keys)
    sums = ranked.groupBy(*keys, "rank").agg(
        F.sum(F.when(F.col("v") < F.col("answer"), F.col("c")).otherwise(0)).alias("below"), F.sum(F.when(F.col("v") <= F.col("answer"), F.col("c")).otherwise(0)).alias("upto"), F.sum("c").alias("n")
    )
    n, slack = F.col("n"), rank_error(k)
    within = (F.col("below") <= n * (F.col("rank") + slack) + 1) & (F.col("upto") >= n * (F.col("rank") - slack) - 1)
    return sums.groupBy(*keys).agg(F.max("n").alias("n"), (F.avg(within.cast("double")) >= (1.0 if len(ranks) == 1 else 0.9)).alias("within"))


def p7_within_bound(spark: SparkSession, d: str) -> DataFrame:
    """Per date group and hour: the values, and whether the merged median's exact rank is within the bound."""
    return _checked(table(spark, d, "posted_aggregates"), ["built_on", "dategroupid", "hour"], ["dategroupid", "hour"], "posted_median", (0.5,), DEFAULT_K)


def p7_large_groups(spark: SparkSession, d: str) -> DataFrame:
    """The same for groups far above k, merged from 7 parts each: of 19 percentiles of the price at least nine in ten keep the bound."""
    return _checked(table(spark, d, "lineitem"), ["l_linenumber", "l_returnflag"], ["l_returnflag"], "l_extendedprice", tuple(i / 20 for i in range(1, 20)), 400)


def _packed(spark: SparkSession, d: str) -> DataFrame:
    capacities = table(spark, d, "container_specs").agg(F.collect_set("capacity_tokens")).scalar()
    mails = table(spark, d, "documents").select("doc_id", byte_tokens(F.col("text")).alias("tokens"))
    return pack_items(mails, "doc_id", "tokens", capacities)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """The mails that had to be split, per capacity."""
    return _packed(spark, d).where(F.col("item_tokens") > F.col("capacity_tokens")).select("capacity_tokens", "doc_id").distinct()


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """Per capacity: containers, tokens, pieces and unused space."""
    return containers(_packed(spark, d))


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    """Per capacity: items and tokens placed, overfull containers, needless splits, and whether at most 1 % of the containers and one for each shard of 10,000 mails are more than the tokens need."""
    packed = cut(_packed(spark, d))
    items = packed.groupBy("capacity_tokens").agg(
        F.count_if(F.col("piece") == 0).alias("n_items"), F.sum("piece_tokens").alias("tokens"), F.count_if((F.col("pieces") > 1) & (F.col("item_tokens") <= F.col("capacity_tokens"))).alias("needless_splits")
    )
    used = packed.where(F.col("container").isNotNull()).groupBy("capacity_tokens", "container").agg(F.sum("piece_tokens").alias("used"))
    boxes = used.groupBy("capacity_tokens").agg(F.count(F.lit(1)).alias("boxes"), F.count_if(F.col("used") > F.col("capacity_tokens")).alias("overfull"))
    need = F.ceil(F.col("tokens") / F.col("capacity_tokens"))
    tight = F.col("boxes") <= need * 1.01 + F.ceil(F.col("n_items") / 10_000) + 1
    return items.join(boxes, "capacity_tokens").select("capacity_tokens", "n_items", "tokens", "overfull", "needless_splits", tight.alias("tight"))


def p9_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Every mail and the item it gives away, with the number of different windows found."""
    return leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Mail and item."""
    return p9_leaks(spark, d).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


def p9_planted(spark: SparkSession, d: str) -> DataFrame:
    """Mails made from every test item with ten passages of 8 to 17 words, and what they give away."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]+)"), 1)
    items = table(spark, d, "eval_items")
    made = items.select("item_id", words.alias("w"), F.explode(F.sequence(F.lit(0), F.lit(9))).alias("v"))
    passage = F.array_join(F.slice("w", F.col("v") + 1, F.col("v") + 8), "\n> ")
    mails = made.select((F.col("item_id") * 10 + F.col("v")).alias("doc_id"), F.concat(F.lit("Subject: x\n\nWe said\n> "), passage, F.lit("\n\nand left")).alias("text"))
    return leaks(mails, items).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


def p10_quality(spark: SparkSession, d: str) -> DataFrame:
    """Figures on every mail's own text, its label shares and its kind."""
    return quality(table(spark, d, "documents"))


def p10_planted(spark: SparkSession, d: str) -> DataFrame:
    """The kinds of mails made up for every supplier: prose, a list, a table or junk in turn."""
    letters = F.translate(F.md5(F.col("s_suppkey").cast("string")), "0123456789abcdef", "aeiouaeiobdlmnrs")
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("doc_id"), letters.alias("m"))
    k = F.sequence(F.lit(0), F.lit(7))

    def word(i: Column, start: int, n: int) -> Column:
        return F.substring("m", i * 3 + start, F.lit(n))

    def lines(line: Callable[[Column], Column]) -> Column:
        return F.array_join(F.transform(k, line), "\n")

    prose = lines(lambda i: F.concat(F.lit("The "), word(i, 1, 5), F.lit(" of the "), word(i, 2, 4), F.lit(" was not there when "), word(i, 3, 5), F.lit(" came, and they said it would be late.")))
    listed = lines(lambda i: F.concat(F.lit("- "), word(i, 1, 5), F.lit(" "), word(i, 4, 4)))
    rowed = lines(lambda i: F.concat(word(i, 1, 6), F.lit("\t"), (i * 37 + F.col("doc_id")).cast("string"), F.lit("\t"), i.cast("string"), F.lit(".5")))
    junk = lines(lambda i: F.concat(F.repeat(F.lit("%&*@#!~"), 6), word(i, 1, 3)))
    kind = F.pmod(F.col("doc_id"), F.lit(4))
    body = F.when(kind == 0, prose).when(kind == 1, listed).when(kind == 2, rowed).otherwise(junk)
    return quality(rows.select("doc_id", F.concat(F.lit("Subject: x\n\n"), body).alias("text"))).select("doc_id", "kind")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Mails that are mainly a list, a table or junk."""
    return p10_quality(spark, d).where(F.col("kind") != "prose").select("doc_id", "kind")


QUERIES = {f.__name__: f for f in (p3_found, p3_repeats, p7_percentiles, p7_by_build, p7_within_bound, p7_large_groups, p8_found, p8_containers, p8_packed, p9_found, p9_leaks, p9_planted, p10_found, p10_quality, p10_planted)}
