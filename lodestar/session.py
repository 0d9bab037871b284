"""Session construction and the shared folder used to cut lineage.

On a cluster the operator never invents a storage location: it reads
``spark.checkpoint.dir`` from the session (or the directory already set on
the SparkContext).  Only when neither is set *and* the master is local
(tests, the bench) does it create a private directory.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "lodestar",
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    AQE stays on so that small shuffle outputs are turned into broadcast
    joins at run time, partitions are coalesced and skewed join partitions
    are split.  The UI is kept off (no server is opened).  The master, the
    shuffle partitions and the driver's memory stay as submitted unless asked
    for here.
    """
    builder = (
        SparkSession.builder
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if "driver_memory" in conf:
        builder = builder.config("spark.driver.memory", conf.pop("driver_memory"))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it only if unset.

    Order: the directory already on the SparkContext, then the
    ``spark.checkpoint.dir`` setting, then (``local`` and ``local[n]`` only) a
    fresh private directory.  Any other master without a setting is an error:
    a machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lodestar-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative operators and written "
            "tables need a folder shared by all executors")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named, once nothing reads it any more."""
    if not path.startswith(checkpoint_dir(spark).rstrip("/") + "/"):
        raise ValueError(f"not below the checkpoint folder: {path}")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
