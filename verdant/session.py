"""Session helpers: defaults that matter for correctness, and the shared
scratch location used for checkpoints and materialised tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings the pipeline relies on for exact results.  UTC so that
# TIMESTAMP <-> TIMESTAMP_NTZ casts are the identity on wall-clock values.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# The JVM never compiles a method of more than 8,000 bytes of code, and Spark makes one of a whole
# stage: that of the parse has more, and would be interpreted row by row.  Above this limit Spark
# generates each operator's expressions by themselves, in methods that are compiled.
CODE_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Performance defaults; a cluster profile may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
}


# Starting point for a large cluster (~100 TB of readings, ~1000 executors):
# many shuffle partitions that AQE coalesces to ~256 MB, skew splitting on,
# 256 MB input splits.  spark.checkpoint.dir must point at shared storage.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(master: str | None = None, app: str = "verdant",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  cluster: bool = False) -> SparkSession:
    """Create (or fetch) a session with the pipeline's settings applied."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {**DEFAULT_CONF, **(CLUSTER_CONF if cluster else {})}
    for k, v in {**base, **REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the correctness settings, and the limit of compiled code, to an existing session."""
    for k, v in {**REQUIRED_CONF, **CODE_CONF}.items():
        spark.conf.set(k, v)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written tables.

    Uses the cluster's ``spark.checkpoint.dir``.  Only a local master may go
    without one and then gets a folder under the system temp folder: on a
    cluster each executor would write to a disk of its own, so that raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) session: no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = _LOCAL_SCRATCH.setdefault("dir", tempfile.mkdtemp(prefix="verdant-ckpt-"))
    if sc is None:
        return conf_dir
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_LOCAL_SCRATCH: dict[str, str] = {}


def is_missing(e: AnalysisException) -> bool:
    """Whether a read failed because there is nothing at the path (no other error counts)."""
    return e.getCondition() == "PATH_NOT_FOUND"


def path_exists(spark: SparkSession, path: str) -> bool | None:
    """Whether ``path`` (a glob is allowed) matches anything; None if unknown."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = fs.globStatus(p)
        return found is not None and len(found) > 0
    except Exception:  # noqa: BLE001 - remote session: let the reader decide
        return None


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """The folders in ``path`` (none if it is not there), through the cluster's file system."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - remote session: no file system at hand
        return []
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory())


def drop_dir(spark: SparkSession, path: str) -> bool:
    """Delete a scratch folder through the cluster's file system (HDFS, S3, local)."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.delete(p, True))
    except Exception:  # noqa: BLE001 - best effort; scratch space only
        return False


def delete_files(spark: SparkSession, files: list[str]) -> None:
    """Delete files, named by the URIs that Spark lists, through the cluster's file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in files:
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        p.getFileSystem(conf).delete(p, False)


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared scratch root."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
