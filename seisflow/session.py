"""Session construction and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Only takes effect when this call starts the JVM (local runs, tests, bench).
    "spark.driver.memory": "8g",
}


def build_session(app: str = "seisflow", master: str | None = None,
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from the context or from ``spark.checkpoint.dir``. Only a local-mode
    session without either gets a private temporary folder (tests); on a cluster
    the setting must name a shared file system, so we refuse to guess.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative operators")
        configured = tempfile.mkdtemp(prefix="seisflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder for written intermediates."""
    base = checkpoint_dir(spark)
    # Spark reports the folder as a URI ("file:/tmp/…", "hdfs://…"). A bare relative path would mean another
    # folder on every machine.
    if not urlparse(base).scheme and not base.startswith("/"):
        raise ValueError(f"spark.checkpoint.dir must be a URI or an absolute path, not {base!r}")
    return f"{base.rstrip('/')}/seisflow-{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table that :func:`scratch_path` named, once nothing reads it any more."""
    if "/seisflow-" not in path:
        raise ValueError(f"not a scratch table: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
