"""Session helpers.

The library never hard-codes a master and never stops a caller's session.
Scratch data (CSV test batches, written layers of a query) goes under the
shared folder the cluster names in ``spark.checkpoint.dir``; a local folder
is created only when that setting is unset (tests, single-machine runs).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: dict[str, str] = {}


def builder(app_name: str = "lakeward", master: str | None = None, shuffle_partitions: int | None = None):
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b


def local_session(cores: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the local bench only."""
    spark = (
        builder("lakeward-local", f"local[{cores}]", shuffle_partitions=cores)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only when none is configured."""
    configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:
        spark.sparkContext.setCheckpointDir(conf)
        return spark.sparkContext.getCheckpointDir() or conf
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    key = spark.sparkContext.applicationId
    if key not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[key] = tempfile.mkdtemp(prefix="lakeward-ckpt-")
        spark.sparkContext.setCheckpointDir(_LOCAL_FALLBACK[key])
    return spark.sparkContext.getCheckpointDir() or _LOCAL_FALLBACK[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/lakeward/{name}-{uuid.uuid4().hex[:12]}"
