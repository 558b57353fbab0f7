"""D1 — generated calendar dimension (one row per day)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from torque.functions.dates import calendar_columns
from torque.schemas import DIM_TIME, conform


def dim_time(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every day from ``start`` to ``end`` inclusive with its 13 attributes.

    ``sequence`` + ``explode`` generates the spine on an executor; the table
    is keyed by date, so it is bounded by the date domain and safe to
    broadcast into any join.
    """
    spine = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias("d"))
    return conform(spine.select(*calendar_columns(F.col("d"))), DIM_TIME)


def calendar_months(dim: DataFrame) -> DataFrame:
    """Distinct (year, month, month_short) of a calendar."""
    return dim.select("year", "month", "month_short").distinct()


def dim_time_spanning(dates: DataFrame, col: str) -> DataFrame:
    """D1 over whole calendar years: 1 January of the earliest year of
    ``dates.col`` to 31 December of the latest.

    The bounds come from a one-row aggregate and the spine is exploded from
    it on an executor, so nothing is collected; the result is keyed by date
    and therefore bounded by the date domain.
    """
    d = F.col(col)
    bounds = dates.agg(F.min(d).alias("_lo"), F.max(d).alias("_hi"))
    spine = bounds.select(F.explode(F.sequence(
        F.make_date(F.year("_lo"), F.lit(1), F.lit(1)),
        F.make_date(F.year("_hi"), F.lit(12), F.lit(31)),
        F.expr("INTERVAL 1 DAY"))).alias("d"))
    return conform(spine.select(*calendar_columns(F.col("d"))), DIM_TIME)
