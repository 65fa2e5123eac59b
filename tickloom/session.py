"""Session settings the operators rely on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Dates and times of day are read in UTC everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: str = "*", name: str = "tickloom", shuffle_partitions: int = 8) -> SparkSession:
    """A small single-process session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_local_roots: dict[str, str] = {}


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    The cluster names that folder. Only a local session without the setting, as in
    tests, takes a temporary one, which goes when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="tickloom-")
            atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
        root = _local_roots[app]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
