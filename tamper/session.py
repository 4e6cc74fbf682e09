"""Session construction and the shared scratch / checkpoint location."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import warnings

from pyspark.sql import SparkSession

# Private folders of local sessions, by application.
_LOCAL_ROOTS: dict[str, str] = {}

# Settings every job in this library expects. AQE is what turns joins with a
# small runtime side into broadcast joins (a measured size, not a guess), merges
# tiny shuffle partitions and splits skewed ones.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tamper") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TAMPER_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_session_defaults(spark: SparkSession) -> None:
    """Runtime-settable parts of SESSION_DEFAULTS, for sessions built elsewhere."""
    # Writers pass partitionOverwriteMode per write; only settings that change
    # query results (time zone) or plans (AQE) are applied to a caller's session.
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        try:
            if spark.conf.get(k, None) != SESSION_DEFAULTS[k]:
                spark.conf.set(k, SESSION_DEFAULTS[k])
        except Exception:  # pragma: no cover - immutable on some deployments
            pass


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where the setting is absent, a local session (tests, a laptop) gets a private temp
    folder with a warning, removed at exit; any other master is an error, since executors
    would not see each other's files."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = _LOCAL_ROOTS.get(spark.sparkContext.applicationId)
    if not root:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a shared folder (master {master})")
        root = tempfile.mkdtemp(prefix="tamper-ckpt-")
        warnings.warn(f"spark.checkpoint.dir is unset; using {root}", stacklevel=2)
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        _LOCAL_ROOTS[spark.sparkContext.applicationId] = root
    spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/tamper/{name}-{uuid.uuid4().hex[:12]}"
