"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for one machine: tests and bench. A cluster brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("daymetrics")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        # The JIT leaves longer methods interpreted; past this size Spark then splits them.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """A new folder for a run's tables, below the one `spark.checkpoint.dir` names.

    Only a local master may do without that setting; on a cluster a folder of one machine
    is out of the other executors' reach. The local one goes when the process ends; folders
    below a shared one (run-<id>) are the cluster's to expire, as other checkpoints are.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="daymetrics-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/run-{uuid.uuid4().hex}"
