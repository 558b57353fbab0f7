"""S2/S10/S11/S12 — versioned table snapshots, loads and load summaries.

A table is a folder of immutable versions ``<root>/<table>/v=<n>``. A write
always goes to a new version; Spark's output committer marks a finished
version with ``_SUCCESS``, and readers take the greatest committed version.
So a failed or concurrent write never leaves readers with an empty or
half-written table (the reference's TRUNCATE-then-load has that window),
and a MERGE never overwrites the files it is reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from torque.schemas import GOLD, LOAD_ORDER, SOURCE, conform

_PREFIX = "v="


class SnapshotStore:
    """Versioned Parquet tables under ``root`` (any Hadoop-compatible path)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self, table: str, committed: bool = True) -> list[int]:
        base = self._Path(f"{self.root}/{table}")
        if not self._fs.exists(base):
            return []
        out = []
        for st in self._fs.listStatus(base):
            name = st.getPath().getName()
            if not (st.isDirectory() and name.startswith(_PREFIX)):
                continue
            if committed and not self._fs.exists(self._Path(st.getPath(), "_SUCCESS")):
                continue
            out.append(int(name[len(_PREFIX):]))
        return sorted(out)

    def latest(self, table: str) -> int | None:
        v = self._versions(table)
        return v[-1] if v else None

    def path(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/{_PREFIX}{version:08d}"

    def write(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> int:
        """Write ``df`` as the next version; returns the version number."""
        existing = self._versions(table, committed=False)
        version = (existing[-1] + 1) if existing else 1
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(table, version))
        return version

    def read(self, table: str, version: int | None = None) -> DataFrame:
        v = version if version is not None else self.latest(table)
        if v is None:
            raise FileNotFoundError(f"no committed version of {table} under {self.root}")
        return self.spark.read.parquet(self.path(table, v))

    def read_or_none(self, table: str) -> DataFrame | None:
        return None if self.latest(table) is None else self.read(table)

    def expire(self, table: str, keep: int = 2) -> list[int]:
        """Delete all but the ``keep`` newest committed versions (and any
        uncommitted version older than them); returns the removed versions.
        Readers of a removed version must have finished with it."""
        committed = self._versions(table)
        if len(committed) <= keep:
            return []
        oldest_kept = committed[-keep]
        gone = [v for v in self._versions(table, committed=False) if v < oldest_kept]
        for v in gone:
            self._fs.delete(self._Path(self.path(table, v)), True)
        return gone


def read_source(store: SnapshotStore, table: str) -> DataFrame:
    """S1 — typed scan of a loaded source role: declared columns and types
    (explicit casts, never inference); pruning and pushdown reach Parquet."""
    return conform(store.read(table), SOURCE[table])


def load_truncate_insert(store: SnapshotStore, table: str, df: DataFrame,
                         schema: StructType | None = None) -> int:
    """S2 — replace ``table``'s content with ``df`` mapped by column name.

    Columns are selected and cast by name to the declared schema (extra
    columns are ignored, a missing one fails). The row count comes from an
    ``Observation`` on the write itself, not from a second scan.
    """
    schema = schema or SOURCE[table]
    obs = Observation(f"load_{table}")
    store.write(table, conform(df, schema).observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get["rows"])


def load_sources(store: SnapshotStore, frames: dict[str, DataFrame],
                 parallelism: int = 4) -> dict[str, int]:
    """Load the source roles; returns table -> rows loaded.

    Tables are independent snapshots (no enforced FKs), so their load jobs
    are submitted from a few threads and run concurrently on the cluster;
    results are reported in the parents-first order of the reference loader.
    """
    from concurrent.futures import ThreadPoolExecutor
    names = [t for t in LOAD_ORDER if t in frames]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = list(pool.map(lambda t: load_truncate_insert(store, t, frames[t]), names))
    return dict(zip(names, rows))


def init_tables(store: SnapshotStore) -> None:
    """S10 — create empty gold tables (a new, empty version of each)."""
    for name, schema in GOLD.items():
        store.write(name, store.spark.createDataFrame([], schema))


def load_summary(frames: dict[str, DataFrame]) -> DataFrame:
    """S12 — (table_name, row_count) for each frame, in load order."""
    parts = [frames[t].agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count")
             for t in [t for t in LOAD_ORDER if t in frames] + [t for t in frames if t not in LOAD_ORDER]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
