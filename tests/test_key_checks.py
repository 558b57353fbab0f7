"""Key bitmaps (Q16) and key sketches (Q13, Q14, Q17) against exact counts."""

from __future__ import annotations

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.fixtures import plan_of
from torque.operators import key_bitmaps, key_sketches
from torque.operators.quality import duplicate_key_check
from torque.sources.parts import MONTH, MonthTable


def _frame(spark, keys, name, kind="bigint"):
    return spark.createDataFrame([(k,) for k in keys], f"{name} {kind}")


def _brute(child, parent):
    held = {k for k in parent if k is not None}
    return sum(k is None or k not in held for k in child)


def _counts(tables, keys):
    return [df.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
            for df in key_bitmaps.orphan_counts(tables, keys)]


RANDOM = random.Random(5)
EDGES = [0, 1, 32767, 32768, 32769, 65536, 65537]


@pytest.mark.parametrize("child,parent", [
    ([1, 2, 2, None], [1, 2, 3]),                              # clean but for a NULL
    ([1, 2, 5, 5, -1], [1, 2, 2, None, 9]),                    # gaps inside and outside the range
    (EDGES + [32766], EDGES),                                  # ends of bitmaps
    ([-k for k in EDGES] + [-2], [-k for k in EDGES]),         # negative keys
    ([1, 2, None], []),                                        # no parent at all
    ([], [1, 2]),
    ([-2 ** 63, 2 ** 63 - 1, 0], [0, 2 ** 63 - 1]),            # a range no bitmap would hold
    ([RANDOM.randrange(200_000) for _ in range(3_000)] + [None] * 500,
     [k for k in range(200_000) if not 70_000 < k < 90_000 or k % 2])])
def test_orphans_by_bitmap(spark, child, parent):
    tables = {"c": _frame(spark, child, "fk"), "p": _frame(spark, parent, "pk")}
    assert _counts(tables, [("c", "fk", "p", "pk")]) == [_brute(child, parent)]


def test_orphans_with_keys_of_other_types(spark):
    """Texts take the anti join, narrow integers the bitmaps; both in one call."""
    tables = {"c": spark.createDataFrame([("a", 1), ("x", 7), (None, None)], "s string, i int"),
              "p": _frame(spark, ["a", "b"], "s", "string"), "q": _frame(spark, [1, 2], "i", "int")}
    keys = [("c", "s", "p", "s"), ("c", "i", "q", "i")]
    assert _counts(tables, keys) == [2, 2]
    assert list(key_bitmaps.parent_ranges(tables, keys)) == [("q", "i")]


def test_too_many_suspect_buckets_for_a_broadcast(spark):
    child, parent = list(range(0, 400_000, 97)), list(range(0, 400_000, 2))
    tables = {"c": _frame(spark, child, "fk"), "p": _frame(spark, parent, "pk")}
    spark.conf.set("torque.broadcast.maxRows", "3")
    try:
        assert _counts(tables, [("c", "fk", "p", "pk")]) == [_brute(child, parent)]
    finally:
        spark.conf.unset("torque.broadcast.maxRows")


def test_clean_child_rows_are_not_shuffled(spark):
    """What is left to run joins nothing, and the marks shuffle bitmaps per bucket only."""
    child, parent = [k % 1000 for k in range(5_000)], list(range(1000))
    tables = {"c": _frame(spark, child, "fk"), "p": _frame(spark, parent, "pk")}
    keys = [("c", "fk", "p", "pk")]
    (left,) = key_bitmaps.orphan_counts(tables, keys)
    assert "Join" not in plan_of(left) and "Exchange" not in plan_of(left)
    ranges = key_bitmaps.parent_ranges(tables, keys)
    marks = key_bitmaps.bucket_marks(tables, {0: keys[0]}, ranges)
    plan = plan_of(marks)
    assert "hashpartitioning(fk" not in plan and "partial_bitmap_construct_agg" in plan
    assert marks.filter("_bucket is not null").count() == 2        # bucket 0 holds key 0 alone


@pytest.mark.parametrize("distinct,repeated", [(0, 0), (1, 3), (40_000, 0), (40_000, 12_000)])
def test_sketched_duplicates_hold_the_exact_count(spark, distinct, repeated):
    keys = list(range(distinct)) + [k % max(distinct, 1) for k in range(repeated)]
    rows = spark.createDataFrame([(k // 7, None if k == 3 else k % 7) for k in keys],
                                 "a bigint, b bigint")
    got = key_sketches.duplicates_sketched({"t": rows}, {"t": ["a", "b"]}).first()
    exact = duplicate_key_check(rows, ["a", "b"], "t").first()["failures"]
    assert got["n_rows"] == len(keys) and exact == (repeated if distinct else 0)
    assert got["failures_low"] <= exact <= got["failures_high"]
    assert (got["failures_low"] > 0) == (repeated > 0)     # many repeated rows are certain
    assert abs(got["distinct_estimate"] - distinct) <= key_sketches.BOUND * distinct


def test_null_parts_of_a_key_are_told_apart(spark):
    rows = spark.createDataFrame([(1, None), (None, 1), (None, None), (1, 1)], "a int, b int")
    got = key_sketches.duplicates_sketched({"t": rows}, {"t": ["a", "b"]}).first()
    assert got["distinct_estimate"] == 4


def test_month_sketches_read_changed_months_only(spark):
    root = tempfile.mkdtemp(prefix="torque-test-sketches-")
    months = lambda ids, m: spark.createDataFrame([(k, m) for k in ids], f"sale_id bigint, {MONTH} int")
    fact, kept = MonthTable(spark, f"{root}/f", key=None), MonthTable(spark, f"{root}/s", key=None)
    fact.write(months(range(20_000), 202301).union(months(range(20_000, 30_000), 202302)))
    assert key_sketches.refresh_sketches(kept, fact, ["sale_id"]) == [202301, 202302]
    whole = key_sketches.duplicate_range(kept.read()).first()
    assert whole["n_rows"] == 30_000 and whole["failures_low"] == 0
    before = kept.manifest()["parts"]
    fact.write(months(range(15_000, 30_000), 202302), [202302])      # 5,000 sales of January again
    assert key_sketches.refresh_sketches(kept, fact, ["sale_id"]) == [202302]
    assert kept.manifest()["parts"][202301] == before[202301]
    whole = key_sketches.duplicate_range(kept.read()).first()
    assert 0 < whole["failures_low"] <= 5_000 <= whole["failures_high"]
    by_month = key_sketches.duplicate_range(kept.read(), MONTH).collect()
    assert [r["failures_low"] for r in by_month] == [0, 0]
