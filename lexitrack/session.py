"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "lexitrack") -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, use the session you are given."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="lexitrack-")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared location the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of its own machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _own_dir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a scratch folder and what is in it, on whatever store it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
