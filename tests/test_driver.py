"""What grows with the rows does not go by way of the driver."""

from __future__ import annotations

from pyspark.sql import functions as F

from queuescope.operators import aggregates, reports
from queuescope.session import cut


def planned(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_medians_never_broadcast_the_rows(spark):
    """Repeated rows pack so well in files that Catalyst takes all of them for a table to broadcast."""
    kinds = F.array(*[F.struct(F.lit(b).alias("b")) for b in ("x", "y", "z")])
    rows = cut(spark.range(200_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 2 * 5.0).alias("v"))).select(F.inline(kinds), "k", "v")
    found = aggregates.exact_medians(rows, ["b", "k"], "v")
    assert "Inner, BuildLeft" not in planned(found)
    assert {(r["b"], r["k"]): r["median"] for r in found.collect()} == {(b, k): m for b in "xyz" for k, m in enumerate((0.0, 5.0, 2.5))}


def test_accuracy_broadcasts_no_table_of_entities(spark):
    rows = cut(spark.range(50_000).selectExpr("concat('MK', id % 5000) entity_code", "'mk' park_code", "DATE '2024-01-01' park_date", "'G' dategroupid", "id % 24 hour", "id % 7 wait_time_minutes", "1.0D weight"))
    table = cut(aggregates.posted_aggregates(rows))
    found = reports.posted_accuracy(rows.drop("weight"), table, "2024-02-01")
    assert planned(found).count("BroadcastHashJoin") <= 1  # that of prefixes and hours
    assert found.count() == 50_000
