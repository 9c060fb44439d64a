"""Names and flags of entities, looked up without regard to case."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuescope.functions.codes import code


def display_name(entity_code: Column, short_name: Column) -> Column:
    """``CODE - short name``; the code alone where there is no name."""
    name = F.nullif(F.trim(short_name), F.lit(""))
    return F.concat_ws(" - ", entity_code, name)


def truthy(c: Column) -> Column:
    """Whether a flag of any type says yes: numbers other than zero, true/t/yes/y in any case; all else, and null, is no."""
    text = F.lower(F.trim(c.cast("string")))
    number = text.try_cast("double")
    return F.coalesce(text.isin("true", "t", "yes", "y") | ((number != 0) & ~F.isnan(number)), F.lit(False))


def with_properties(frame: DataFrame, entities: DataFrame, columns: Sequence[str], key: str = "entity_code") -> DataFrame:
    """Adds columns of the entity dimension by trimmed code in any case; unknown and null codes get nulls.

    Where the dimension repeats a code, its row of the least values counts.
    """
    spare = [c for c in frame.columns if c not in columns]
    payload = entities.where(F.col(key).isNotNull()).groupBy(code(F.col(key)).alias("__code")).agg(F.min(F.struct(*columns)).alias("__p"))
    joined = frame.withColumn("__key", code(F.col(key))).join(payload, F.col("__key") == F.col("__code"), "left")
    return joined.select(*spare, *[F.col(f"__p.{c}").alias(c) for c in columns])
