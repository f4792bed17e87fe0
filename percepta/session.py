"""Spark session and shared-folder helpers.

Everything in the package takes a ``SparkSession`` from the caller; this
module only offers a builder with sensible defaults for local runs and
tests, and the one place that decides where intermediate files go.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Defaults for settings that the submit does not give.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = "local[*]",
    app_name: str = "percepta",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``master=None`` leaves the master to ``spark-submit``. The defaults fill in
    only what ``spark-submit`` left unset; ``conf`` and ``shuffle_partitions``
    are the caller's own and always hold. Local masters get 8 shuffle
    partitions unless told otherwise, clusters Spark's own default.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    submitted = SparkConf()
    defaults = dict(DEFAULT_CONF)
    if (master or submitted.get("spark.master", "") or "").startswith("local"):
        defaults["spark.sql.shuffle.partitions"] = "8"
    settings = {k: v for k, v in defaults.items() if not submitted.contains(k)}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory for intermediate output, under ``spark.checkpoint.dir``.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that is
    read from the session. Only a local-mode session without the setting gets a
    private temporary folder (tests, laptops); a cluster session without it is
    an error, since a machine-local folder is not visible to other executors.
    """
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; set it to a folder shared by "
                "all executors (e.g. on HDFS or an object store)"
            )
        base = tempfile.mkdtemp(prefix="percepta-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
