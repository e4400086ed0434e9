"""Session construction and the shared scratch area.

Scratch output (staged writes, stream checkpoints, round-trip files) always
lives under the cluster's shared ``spark.checkpoint.dir``.  A session that has
none (a laptop, a test) gets a fresh temporary one; a cluster session is never
given a machine-local folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "strata", conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every strata job assumes."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**_DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; set only where unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the context; the setting must exist
        if not root:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return root.rstrip("/")
    root = root or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(a machine-local temporary folder would not survive executor loss)")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")  # local session without one (a laptop, a test)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/strata-scratch/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that must touch the local filesystem (tests)."""
    return path[len("file:"):] if path.startswith("file:") else path

