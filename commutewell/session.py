"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE sizes the shuffles at run time: start from many small partitions, merge them up to the
# advisory size, split what is skewed.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
    # Recording the Python call site of every column costs the driver more than planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Shuffle partitions to start from. On a cluster the only number that grows with the data.
CLUSTER_PARTITIONS = "8192"
LOCAL_PARTITIONS = "8"
_PARTITIONS = "spark.sql.shuffle.partitions"
_SPARK_DEFAULT = "200"


def build_session(app: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the defaults above; ``conf`` wins over them.

    A number of shuffle partitions that is already configured is kept.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.ui.enabled", "false")
    for key, value in {**CLUSTER_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    chosen = _PARTITIONS in (conf or {}) or spark.sparkContext.getConf().contains(_PARTITIONS)
    if not chosen and spark.conf.get(_PARTITIONS) == _SPARK_DEFAULT:
        spark.conf.set(_PARTITIONS, LOCAL_PARTITIONS if _one_machine(spark) else CLUSTER_PARTITIONS)
    return spark


def _one_machine(spark: SparkSession) -> bool:
    """Do driver and executors share one process, and so one disk?"""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path for ``name`` below the cluster's shared ``spark.checkpoint.dir``.

    Only a session on one machine that names no such folder (a test) gets a temporary one; a cluster without
    a shared folder is an error, as its executors would write to disks that nobody else reads.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not _one_machine(spark):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="commutewell-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
