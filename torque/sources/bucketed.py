"""R2/F1 — tables laid out in hash buckets of a join key, through the session catalog.

Two tables with as many buckets of the same key meet bucket by bucket: the fact
joins a customer dimension that is too large to broadcast without any of its
rows moving. The layout costs one shuffle when the table is written and saves
one in every join on the key after that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` to ``path`` as the catalog table ``name`` in sorted buckets of ``key``
    and return the table. Rows are dealt by the key first, so a bucket is one file;
    a hot key makes a large file, which is inherent in the layout."""
    (df.repartition(buckets, key).write.format("parquet").mode("overwrite")
     .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, name: str, path: str, like: DataFrame, key: str,
                  buckets: int) -> DataFrame:
    """The table of an earlier session, whose files lie at ``path``, under ``name``."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({like.schema.toDDL()}) USING parquet "
              f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
