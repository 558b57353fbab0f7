"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every torque session wants; a cluster's own spark-defaults win
# because ``builder.config`` is only applied when the key is not already set
# by the caller.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "torque",
                shuffle_partitions: int | None = None,
                extra: dict | None = None, checkpoint_dir: str | None = None) -> SparkSession:
    """Build (or reuse) a session with torque's defaults.

    ``master`` is only needed for local runs; on a cluster leave it None so
    the submit-time master is used. ``checkpoint_dir`` is used where the
    session names none.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir:
        ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """Return the reliable checkpoint folder of the session.

    It must be shared storage named by ``spark.checkpoint.dir``. Where that is
    unset, the caller may name a folder (a local run, tests, the bench);
    torque itself never invents one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None) or default
    if not folder:
        raise RuntimeError("spark.checkpoint.dir is not set; torque needs a shared folder "
                           "for lineage cuts")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()
