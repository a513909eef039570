"""Spark session helpers.

The engine never hard-codes a cluster layout. Everything here is a default that a
cluster submit overrides: shuffle partitions, AQE and the checkpoint folder are read
from the session first and only filled in when unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Defaults for a session this package creates itself. On a cluster the submit
# command's values win because ``SparkSession.builder`` only sets keys that are given
# here and ``getOrCreate`` returns an existing session untouched.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot does not JIT-compile methods over 8000 bytes; the rule projections are
    # wide, so let Spark split such stages instead of running them interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Checkpoint files (ranking) are removed once their DataFrame is garbage-collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Keys for the id cipher are passed as literals; keep them out of plan strings.
    "spark.sql.redaction.string.regex": "(?i)fernet|secret|key=",
}


def build_session(
    master: str | None = None,
    app_name: str = "notifyq",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or return) a session with this package's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra_conf:
        conf.update(extra_conf)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    Read from ``spark.checkpoint.dir`` (or an already set SparkContext checkpoint
    folder). Only a local session may fall back to a fresh scratch folder; on a
    cluster a machine-local folder would not survive the loss of an executor, so
    an unset value is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_value = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_value:
        sc.setCheckpointDir(conf_value)
        return sc.getCheckpointDir() or conf_value
    if not is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS, S3, ...) that every executor can reach"
        )
    local = tempfile.mkdtemp(prefix="notifyq-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


# Upper bound on the partitions a small (few-split) input is spread over.
MAX_SPREAD_PARTITIONS = 256


def spread_small_input(df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer splits than the cluster has cores.

    A file with one row group is one task however many cores there are, and the
    clean/validate projection is CPU work. Only in that case the rows are dealt
    round-robin over ``defaultParallelism`` partitions (a deterministic exchange: Spark
    sorts before a round-robin repartition, so retried tasks see the same rows). Large
    inputs already have more splits than cores and pass through untouched -- no shuffle
    is added at scale. The split count comes from file listing, not from a job.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        # A single split is small by construction (one row group); on a very large
        # cluster do not deal it into thousands of near-empty tasks.
        return df.repartition(min(cores, MAX_SPREAD_PARTITIONS))
    return df
