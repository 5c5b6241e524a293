"""Session settings and the shared scratch folder.

Library functions never build a session; callers pass one in. ``local_session``
exists for tests and ``bench.py`` only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Day and minute keys are computed in UTC so that every engine agrees on them.
SESSION_TIME_ZONE = "UTC"


def ensure_session_defaults(spark: SparkSession) -> None:
    """Pin the settings the results depend on (idempotent, cheap)."""
    if spark.conf.get("spark.sql.session.timeZone") != SESSION_TIME_ZONE:
        spark.conf.set("spark.sql.session.timeZone", SESSION_TIME_ZONE)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "clickflow") -> SparkSession:
    """A local session for tests and benchmarks (the cluster supplies its own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", SESSION_TIME_ZONE)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CLICKFLOW_DRIVER_MEMORY", "4g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    ``spark.checkpoint.dir`` names storage every executor can reach. Only when it is
    unset (local tests) is a private folder created and registered as that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="clickflow-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), "clickflow", *parts, uuid.uuid4().hex])
