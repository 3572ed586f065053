"""Session construction and shared scratch locations.

Jobs never write to a machine-local temporary folder on a cluster: every
intermediate table lives below the folder named by ``spark.checkpoint.dir``.
Only a local-mode session without that setting (tests) gets a fresh temp dir.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults tuned for the analytical shapes of this library: AQE re-plans joins
# and coalesces/splits shuffle partitions at runtime from real sizes.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Many small JSON documents: pack them into partitions instead of one task per file.
    "spark.sql.files.openCostInBytes": str(64 * 1024),
}


def build_session(master: str | None = None, app: str = "cirrus",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
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
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Set our own only where it is unset and the session is local (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="cirrus-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the shared checkpoint folder; unique per call by default."""
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    return "/".join([checkpoint_root(spark), "cirrus", *leaf])
