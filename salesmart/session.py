"""Spark session settings and the shared scratch location.

Everything the library writes between stages (cleansed tables, metric
tables, landed files, stream checkpoints) goes under the folder named by
``spark.checkpoint.dir``.  On a cluster that folder is shared storage set
by the operator; we only choose our own when it is unset *and* the master
is local (tests, bench).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the library relies on.  They are session-scoped, so
# they can be applied to a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets AQE turn a sort-merge join into a broadcast once the *measured*
    # size of one side is known (runtime check, not an estimate).
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


# Bytes of stored input per shuffle partition, and the most that AQE may merge into one.
INPUT_PER_PARTITION = 4 << 20
MERGED_PARTITION = 16 << 20

#: Settings that a child session takes over.
SHUFFLE_SETTINGS = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                    "spark.sql.adaptive.advisoryPartitionSizeInBytes")

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30}


def conf_bytes(spark: SparkSession, key: str, default: int) -> int:
    """A size setting of the session in bytes."""
    raw = str(spark.conf.get(key, str(default))).strip().lower()
    m = re.fullmatch(r"(-?\d+)\s*([kmg]?b?)", raw)
    return int(m.group(1)) * _UNITS[m.group(2)] if m else default


def partitions_for(spark: SparkSession, input_bytes: int) -> int:
    """Shuffle partitions for an input: the session's number, or one per ``INPUT_PER_PARTITION``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // INPUT_PER_PARTITION))


def scale_partitions(spark: SparkSession, input_bytes: int) -> None:
    """Let the shuffles of the session begin with as many partitions as an input needs.

    A fixed number of partitions makes every task's share, and so what it sorts
    in memory and spills, grow with the input.  AQE merges the small ones.  An
    input for which the session's own number does leaves the session as it was.
    """
    initial, ours = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "salesmart.initialPartitions"
    if (value := spark.conf.get(ours, None)) is not None:
        if spark.conf.get(initial, None) == value:
            spark.conf.unset(initial)
        spark.conf.unset(ours)
    n = partitions_for(spark, input_bytes)
    if n <= max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(initial, None) or 0)):
        return
    for key in (initial, ours):
        spark.conf.set(key, str(n))
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if conf_bytes(spark, advisory, 64 << 20) > MERGED_PARTITION:
        spark.conf.set(advisory, str(MERGED_PARTITION))


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "salesmart", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, scratch dir set)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    scratch_root(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a fresh /tmp folder only in local mode."""
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if not path:
        path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
            "spark.checkpoint.dir", None)
    if not path:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; salesmart needs a shared folder "
                "for intermediate tables on a cluster")
        path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir() or path
    return path


def scratch_root(spark: SparkSession) -> str:
    """``<checkpoint dir>/salesmart/<application id>``."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "salesmart", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the scratch root; ``unique`` appends a fresh id."""
    segs = list(parts)
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    return os.path.join(scratch_root(spark), *segs)
