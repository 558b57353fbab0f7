"""Q13, Q14, Q17, opt-in — duplicate keys from sketches instead of exact sets.

A sketch of a table's keys (HyperLogLog, 16 kB at most) answers how many distinct
keys there are to within ``BOUND``, and sketches of parts add up. Kept beside a
fact, one per month, they say after every load whether rows have come twice
(a file loaded again, a month delivered under two names) without reading a month
that the load has not touched. A sketch cannot find a single repeated key: the
exact checks of ``quality`` stay the default, and this one answers with a range.

NULL is a key like any other, as in GROUP BY. Keys are told apart by 64-bit hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torque.operators.partials import refresh_months
from torque.sources.parts import MONTH, MonthTable

LG_K = 14
STANDARD_ERROR = 1.04 / 2 ** (LG_K / 2)      # of merged sketches, relative
BOUND = 4 * STANDARD_ERROR                   # 3.25 %: missed by fewer than 1 in 10,000


def _key(keys: list[str]) -> Column:
    # a NULL leaves a hash as it is, so each key tells whether it is one
    return F.xxhash64(*[x for k in keys for x in (F.col(k), F.col(k).isNull())])


def key_sketch(rows: DataFrame, keys: list[str], *by: str) -> DataFrame:
    """(by, n_rows, sketch): one sketch per group; partial sketches are merged, so a
    hot group costs one row per map task."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.hll_sketch_agg(_key(keys), F.lit(LG_K)).alias("sketch"))


def refresh_sketches(kept: MonthTable, fact: MonthTable, keys: list[str]) -> list[int]:
    """Bring the sketches of a month table up to its newest manifest; only months that
    have changed are read. Returns them."""
    return refresh_months(kept, fact, lambda rows: key_sketch(rows, keys, MONTH))


def duplicate_range(sketches: DataFrame, *by: str) -> DataFrame:
    """(by, n_rows, distinct_estimate, failures_low, failures_high) of the union of the
    sketches of each group: surplus rows, as Q17 counts them, lie in that range."""
    n, seen = F.col("n_rows"), F.col("distinct_estimate")
    both = sketches.groupBy(*by).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0))
        .alias("distinct_estimate"))
    least = lambda x: F.greatest(x.cast("long"), F.lit(0).cast("long"))
    return both.select(
        *by, "n_rows", "distinct_estimate",
        least(F.floor(n - seen / (1 - BOUND))).alias("failures_low"),
        least(F.ceil(n - seen / (1 + BOUND))).alias("failures_high"))


def duplicates_sketched(tables: dict[str, DataFrame],
                        primary_keys: dict[str, list[str]]) -> DataFrame:
    """Q17 by sketches: (check_id, description, n_rows, distinct_estimate, failures_low,
    failures_high) per key; every table is scanned once and nothing but its
    sketches is shuffled."""
    return reduce(DataFrame.unionByName, [
        duplicate_range(key_sketch(tables[t], keys)).select(
            F.lit("QC-PK").alias("check_id"),
            F.lit(f"{t}({', '.join(keys)})").alias("description"), "*")
        for t, keys in primary_keys.items()])
