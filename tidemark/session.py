"""Spark session and shared-storage helpers.

Everything that has to outlive a task (stream checkpoints, lineage cuts, re-read sinks) goes
under the folder named by ``spark.checkpoint.dir``, which on a cluster is shared storage.
Only when that setting is absent (unit tests, local runs) do we create a local folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}  # application id -> local checkpoint folder
_SHIPPED: set[str] = set()  # application ids
_WRITTEN: dict[str, list[str]] = {}  # application id -> scratch paths handed out


def get_spark(app: str = "tidemark", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes.

    UTC session time zone (results must not depend on the host zone), no UI server, AQE on with
    partition coalescing and skew-join splitting, Arrow for pandas transfer. The number of shuffle
    partitions stays what the cluster sets unless the caller gives one (a test, a benchmark).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g")))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. If it is unset, a local master (tests, one
    machine) gets a fresh local folder, registered as the checkpoint dir; on a cluster, whose
    executors would not see such a folder, that is an error.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if not sc.getCheckpointDir():  # make Dataset.checkpoint() use the configured shared folder
            sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # setCheckpointDir appends a per-application uuid folder; use its parent as the root
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _LOCAL:
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(root)
        _LOCAL[sc.applicationId] = root
    return _LOCAL[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder path (not created) under the shared checkpoint root."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete what this application wrote under ``scratch_path`` so far, through Hadoop's file system
    (any shared store). For callers that are done with every frame that reads it, as between two
    runs; returns the number of folders deleted."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    done = 0
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        done += bool(p.getFileSystem(conf).delete(p, True))
    return done


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a fresh folder under the shared checkpoint root and read it back.

    Cuts lineage like a reliable checkpoint, in one job (an eager ``checkpoint()`` computes its
    input twice: a count, then the file write), and later reads can prune columns and push filters.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, as ``--py-files`` would: pickled Arrow
    UDFs refer to its modules by name. Zipped once per SparkContext and added with ``addPyFile``
    (the driver serves it to every executor); must run before the UDFs of a plan are created."""
    import zipfile

    import tidemark

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(tidemark.__file__))
    fd, path = tempfile.mkstemp(prefix="tidemark-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
