"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Runtime settings; none of them is a size, so they hold on any cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",  # a value past the declared type is an error, not NULL
    "spark.sql.variant.allowDuplicateKeys": "true",  # the last one counts
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "spanledger") -> SparkSession:
    """Session for tests and the bench; a cluster job brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder the cluster shares through spark.checkpoint.dir.

    Only a local session may go without that setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_folder()
    return f"{base.rstrip('/')}/spanledger/{name}-{uuid.uuid4().hex}"
