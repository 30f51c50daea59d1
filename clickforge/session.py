"""Spark session defaults used by the library, tests and the benchmark."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on: UTC dates, ANSI on (we use try_* functions where
# input may be bad), AQE for runtime re-planning (coalescing, skew joins, broadcast
# conversion from measured shuffle sizes).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "clickforge", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` is only set when given: on a cluster the launcher decides it.
    """
    builder = SparkSession.builder.appName(app_name)
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


_LOCAL_FOLDERS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment to a shared file system. Only when it
    is unset in a purely local session (tests) do we pick a private scratch folder, one for each
    application.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        d = _LOCAL_FOLDERS.get(app) or _LOCAL_FOLDERS.setdefault(app, tempfile.mkdtemp(prefix="clickforge-ckpt-"))
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)
