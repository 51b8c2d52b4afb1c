"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int = 8, partitions: int | None = None, app: str = "gradmesh") -> SparkSession:
    """A local[N] session configured the way the tests and the bench expect."""
    parts = str(partitions or cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", parts)
        .config("spark.default.parallelism", parts)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the session, if any."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir()
    if found:
        return found
    value = sc.getConf().get(CHECKPOINT_CONF, None)
    if value:
        return value
    try:
        return spark.conf.get(CHECKPOINT_CONF, None) or None
    except Exception:  # pragma: no cover - conf lookup differences across modes
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; create a local one only in local mode.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; without it this raises,
    since executors cannot read one another's machine-local files. In ``local[*]`` mode
    (tests, single-machine runs) driver and executors are one process.
    """
    found = checkpoint_dir(spark)
    if found:
        return found
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="gradmesh-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
