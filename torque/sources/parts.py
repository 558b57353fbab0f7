"""E1/E2/E3 — tables kept in parts (months, hash buckets) that loads replace atomically.

A load writes the parts it touches into a folder of its own,
``data/v=<n>/<column>=<part>``, and then one manifest, which lists for every
part the version that holds it, the schema, the greatest surrogate key and a
note of the caller. The manifest is written aside and renamed into place: before
the rename readers see the old table, after it the new one, and a load that dies
in between leaves nothing but a folder that no manifest names. Parts that a load
does not touch keep their files. Their number is bounded (by the calendar, by the
number of buckets), so a manifest is small whatever the table holds.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from torque.operators.joins import observed


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class PartTable:
    """Parquet table under ``root`` (any Hadoop-compatible path) in parts by ``column``, an
    integer. ``key``: the surrogate key whose greatest value is remembered, if any."""

    def __init__(self, spark: SparkSession, root: str, column: str, key: str | None = None):
        self.spark, self.root, self.column, self.key = spark, root.rstrip("/"), column, key
        self._jvm = spark.sparkContext._jvm
        self._Path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._Path(f"{self.root}/{folder}")
        if not self._fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path))

    def _manifests(self) -> list[int]:
        return [int(n[:-5]) for n in self._names("manifests")
                if n.endswith(".json") and n[:-5].isdigit()]

    def _versions(self) -> list[int]:
        return [int(n[2:]) for n in self._names("data") if n.startswith("v=")]

    def manifest(self, number: int | None = None) -> dict | None:
        """The newest (or a given) manifest: number, schema, parts, last_key, note."""
        found = self._manifests()
        if not found:
            return None
        number = max(found) if number is None else number
        stream = self._fs.open(self._Path(f"{self.root}/manifests/{number:08d}.json"))
        try:
            state = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return state | {"number": number, "parts": {int(m): v for m, v in state["parts"].items()}}

    def read(self, parts: list[int] | None = None) -> DataFrame:
        """All parts or the given ones; absent parts have no rows."""
        state = self.manifest()
        if state is None:
            raise FileNotFoundError(f"no manifest under {self.root}")
        schema = StructType.fromJson(state["schema"])
        held = state["parts"] if parts is None else {
            m: state["parts"][m] for m in parts if m in state["parts"]}
        if not held:
            return self.spark.createDataFrame([], schema).withColumn(
                self.column, F.lit(None).cast("int"))
        paths = [f"{self.root}/data/v={v}/{self.column}={m}" for m, v in sorted(held.items())]
        return (self.spark.read.schema(schema).option("basePath", f"{self.root}/data")
                .parquet(*paths).drop("v"))

    def write(self, rows: DataFrame, replaced: list[int] | None = None,
              note: dict | None = None, rebalance: bool = True) -> dict:
        """Replace the parts ``replaced`` (None: the whole table) by ``rows``, which have
        the table's column. A replaced part without rows ends. ``note`` is kept in
        the manifest for the caller. ``rebalance=False`` spares rows that an aggregation
        has just shuffled a second shuffle; a part then has a file per task of it.

        ``rows`` may read this table: nothing that it reads is overwritten. Raises
        if another load has written a manifest meanwhile.
        """
        old = self.manifest() or {"number": 0, "parts": {}, "last_key": 0}
        version = max([0, *self._versions(), *old["parts"].values()]) + 1
        seen = Observation()
        last = F.max(F.col(self.key) if self.key else F.lit(0))
        # a part goes to one task, large parts to several, small ones share one
        rows = rows.observe(seen, last.alias("last"))
        ((rows.hint("rebalance", self.column) if rebalance else rows)
         .write.mode("errorifexists").partitionBy(self.column).parquet(f"{self.root}/data/v={version}"))
        written = [n.split("=")[1] for n in self._names(f"data/v={version}")
                   if n.startswith(f"{self.column}=")]
        if not all(m.isdigit() for m in written):
            raise ValueError(f"rows without {self.column}")
        written = [int(m) for m in written]
        found = (observed(seen) or {"last": 0}) if written else {"last": 0}
        kept = {} if replaced is None else {
            m: v for m, v in old["parts"].items() if m not in set(replaced)}
        stray = sorted(set(written) & set(kept))
        if stray:
            raise ValueError(f"rows of parts that are not replaced: {stray}")
        state = {"schema": rows.drop(self.column).schema.jsonValue(),
                 "parts": kept | {m: version for m in written},
                 "last_key": max(old["last_key"], found["last"] or 0), "note": note or {}}
        self._commit(old["number"] + 1, state)
        return state

    def _commit(self, number: int, state: dict) -> None:
        aside = self._Path(f"{self.root}/manifests/_{uuid.uuid4().hex}")
        final = self._Path(f"{self.root}/manifests/{number:08d}.json")
        out = self._fs.create(aside)
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        if self._fs.exists(final) or not self._fs.rename(aside, final):
            raise RuntimeError(f"another load has written manifest {number} of {self.root}")

    def expire(self, keep: int = 2) -> list[int]:
        """Delete all but the ``keep`` newest manifests and the versions that none of
        these names; returns the removed versions. Readers of removed manifests and
        writers must have finished."""
        numbers = sorted(self._manifests())
        named = {v for n in numbers[-keep:] for v in self.manifest(n)["parts"].values()}
        gone = [v for v in self._versions() if v not in named]
        for n in numbers[:-keep]:
            self._fs.delete(self._Path(f"{self.root}/manifests/{n:08d}.json"), False)
        for v in gone:
            self._fs.delete(self._Path(f"{self.root}/data/v={v}"), True)
        return gone


MONTH = "sale_month"


class MonthTable(PartTable):
    """A fact in months (YYYYMM)."""

    def __init__(self, spark: SparkSession, root: str, key: str | None = "sale_key"):
        super().__init__(spark, root, MONTH, key)
