"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of ours wants; a cluster's own spark-defaults win
# for anything not listed here.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "sparktally",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session, or build one.

    ``master`` is only applied when given (tests and the bench pass
    ``local[N]``); on a cluster the launcher decides. A local session without
    a ``spark.checkpoint.dir`` gets a fresh temporary one; a cluster names its
    shared folder itself and that setting is never overridden.
    """
    builder = SparkSession.builder.appName(app_name)
    conf = dict(_DEFAULT_CONF)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="sparktally-ckpt-")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    active = SparkSession.getActiveSession()
    if active is not None and active.conf.get("spark.checkpoint.dir", None):
        conf.pop("spark.checkpoint.dir", None)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised tables.

    Read from ``spark.checkpoint.dir``, which a cluster points at shared
    storage. Only when it is unset (a local session built elsewhere) a fresh
    temporary folder is registered with the SparkContext, so that later calls
    and ``DataFrame.checkpoint()`` use the same place.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder on shared storage "
                "(a machine-local temporary folder would not survive the loss of an executor)"
            )
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sparktally-ckpt-"))
        current = sc.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a materialised table."""
    return os.path.join(checkpoint_dir(spark), name)


def _file_system(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, wherever it lies; nothing if it is absent."""
    fs, hpath = _file_system(spark, path)
    fs.delete(hpath, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a written table when the driver ends: for scratch tables that a
    returned DataFrame still reads."""
    fs, hpath = _file_system(spark, path)
    fs.deleteOnExit(hpath)
