"""Join helpers: broadcast only behind a size check.

Three kinds of small side exist in this model:

* **domain-bounded** tables keyed by a DATE (calendar, one winner per
  delivery day, one row per month). A DATE has 3,652,059 possible values
  (0001-01-01 .. 9999-12-31), so such a table can never outgrow a broadcast
  whatever the data volume. They are hinted directly with ``broadcast_bounded``.
* **file-backed** gold tables: their size is known from file statistics, so
  the planner's own threshold check decides (no hint, no job);
* **data-sized** small sides (cars, BOM costs, suppliers, lookup maps). Their
  size is only known at run time, so ``broadcast_checked`` materialises the
  side once (reliable checkpoint), counts it, and broadcasts only below a row
  limit; above it the join stays a shuffle join and AQE handles skew.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from torque.session import ensure_checkpoint_dir

DATE_DOMAIN_ROWS = 3_652_059
DEFAULT_MAX_ROWS = 2_000_000
_MAX_ROWS_CONF = "torque.broadcast.maxRows"
DEFAULT_MAX_BYTES = 512 << 20
_MAX_BYTES_CONF = "torque.broadcast.maxBytes"
_WIDEST = "_torque_widest"       # set on materialised frames: widest values together


def max_broadcast_rows(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get(_MAX_ROWS_CONF, None)
    return int(conf) if conf else DEFAULT_MAX_ROWS


def small_enough(df: DataFrame, rows: int) -> bool:
    """Is a side of ``rows`` rows within the broadcast limits of rows and bytes?

    The width of variable-length columns is always taken from the rows themselves
    (their longest value, observed while they were materialised or read here), so
    a few wide rows are not mistaken for a small side.
    """
    if rows > max_broadcast_rows(df):
        return False
    limit = int(df.sparkSession.conf.get(_MAX_BYTES_CONF, None) or DEFAULT_MAX_BYTES)
    fixed = rows * (16 * len(df.columns) + 16)
    if fixed > limit:
        return False
    widest = getattr(df, _WIDEST, None)
    if widest is None:
        texts = _texts(df)
        widest = sum(w or 0 for w in df.agg(*texts).first()) if texts else 0
    return fixed + rows * widest <= limit


def _texts(df: DataFrame) -> list[Column]:
    """The longest value of each variable-length column, in bytes."""
    return [F.max(F.octet_length(F.col(f"`{f.name}`").cast("string") if f.dataType.simpleString()
                                 not in ("string", "binary") else F.col(f"`{f.name}`"))).alias(f"w{i}")
            for i, f in enumerate(df.schema.fields)
            if f.dataType.simpleString().startswith(("string", "binary", "varchar", "char", "array",
                                                     "map", "struct"))]


def broadcast_bounded(df: DataFrame) -> DataFrame:
    """Hint a side whose row count is bounded by its key's domain (a DATE)."""
    return F.broadcast(df)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the session's checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``materialize`` plus the row count, observed during the same job, as are the
    widths that ``small_enough`` asks for."""
    obs = Observation()
    texts = _texts(df)
    out = materialize(df.observe(obs, F.count(F.lit(1)).alias("rows"), *texts))
    seen = observed(obs)
    if seen is None:
        return out, out.count()
    setattr(out, _WIDEST, sum(seen[f"w{i}"] or 0 for i in range(len(df.columns)) if f"w{i}" in seen))
    return out, int(seen["rows"])


def observed(obs: Observation) -> dict | None:
    """The metrics of a finished job. None where there are none: a plan that turns out
    to be empty while it runs loses the node that would have counted."""
    try:
        return obs.get
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception.getClass()):
            raise
        return None


def same_session(one: DataFrame, other: DataFrame) -> bool:
    """Do two frames belong to one session? (``foreachBatch`` passes frames of another.)"""
    return one.sparkSession._jsparkSession.equals(other.sparkSession._jsparkSession)


def broadcast_checked(df: DataFrame, max_rows: int | None = None,
                      checkpoint: bool = True) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows.

    With ``checkpoint`` the side is materialised first, so the count and the
    join read the same rows and the upstream plan runs once. Returns the
    (materialised) frame, hinted or not.
    """
    limit = max_rows if max_rows is not None else max_broadcast_rows(df)
    if checkpoint:
        side, n = materialize_counted(df)      # counted while it is written
    else:
        side, n = df, df.limit(limit + 1).count()
    return F.broadcast(side) if n <= limit and small_enough(side, n) else side
