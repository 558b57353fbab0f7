"""Column helpers shared by the native operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torque.session import ensure_checkpoint_dir

WHITE = " \t\n\x0b\f\r"          # the characters of [\x20\x09-\x0D]


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A column used inside a lambda is otherwise inlined by the optimizer and
    worked out anew for each element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null gives none."""
    blank = F.translate(F.coalesce(text, F.lit("")), WHITE, " " * len(WHITE))
    return F.filter(F.split(blank, " "), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once under the session's shared checkpoint folder and read it
    back: later passes neither recompute it nor depend on any executor."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"torque-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
