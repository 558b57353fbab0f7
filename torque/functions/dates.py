"""Date expressions: the integer date key and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """F4 — ``YYYYMMDD`` as INT by integer arithmetic (no string round trip)."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(d: Column) -> list[Column]:
    """The 13 DIM_TIME attributes of a date column (D1).

    Names follow the documented values ('January', 'Jan', 'Monday'); Spark's
    own ``monthname``/``dayname`` return abbreviations, so ``date_format``
    patterns are used instead. ``day_of_week`` is 0 = Sunday .. 6 = Saturday.
    """
    dow = (F.dayofweek(d) - 1).cast("int")
    return [
        date_key(d).alias("time_id"),
        d.alias("full_date"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.month(d).cast("int").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.weekofyear(d).cast("int").alias("week_of_year"),
        F.dayofmonth(d).cast("int").alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
    ]
