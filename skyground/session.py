"""Session settings the plans rely on, and the folder for data written between jobs."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# UTC is required: extraction_date is a cast of a timestamp and would otherwise
# depend on the session time zone. Stream state goes to RocksDB, on local disk
# instead of the heap. The rest are Spark's own adaptive switches.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "skyground", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session with :data:`SESSION_CONF`; ``conf`` keys win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply :data:`SESSION_CONF` to a session somebody else built; the settings stay with that session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a
    local session without that setting gets a machine-local temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if re.match(r"local($|\[)", spark.sparkContext.master):
        return tempfile.mkdtemp(prefix=f"skyground-{name}-")
    raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def hadoop_folder(spark: SparkSession, path: str):
    """The file system of a folder, and the folder as that knows it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of :func:`shared_folder` and what was written to it."""
    files, target = hadoop_folder(spark, path)
    files.delete(target, True)


def session_folder(spark: SparkSession, name: str) -> str:
    """A :func:`shared_folder` that goes when the session ends, for results that are read later."""
    path = shared_folder(spark, name)
    files, target = hadoop_folder(spark, path)
    files.deleteOnExit(target)
    return path
