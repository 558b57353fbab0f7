"""Size checks of broadcast sides."""

from __future__ import annotations

from pyspark.sql import functions as F

from torque.operators.joins import broadcast_checked, materialize_counted, small_enough


def test_wide_values_are_seen_whatever_the_row_count(spark):
    """Three hundred rows with texts of a megabyte are no small side."""
    spark.conf.set("torque.broadcast.maxBytes", str(64 << 20))
    try:
        wide = spark.range(300).select("id", F.repeat(F.lit("x"), 1 << 20).alias("t"))
        assert not small_enough(wide, 300)
        assert not small_enough(*materialize_counted(wide))
        nested = spark.range(300).select("id", F.array(F.repeat(F.lit("x"), 1 << 20)).alias("t"))
        assert not small_enough(nested, 300)
        short = spark.range(300).select("id", F.lit("x").alias("t"))
        assert small_enough(*materialize_counted(short)) and small_enough(short, 300)
        plan = spark.range(10).join(broadcast_checked(wide), "id")._jdf.queryExecution()
        assert "strategy=broadcast" not in plan.toString()
    finally:
        spark.conf.unset("torque.broadcast.maxBytes")


def test_empty_sides_are_counted(spark):
    empty, rows = materialize_counted(spark.range(5).filter("id > 7").selectExpr("id", "'a' AS t"))
    assert rows == 0 and small_enough(empty, rows)
