"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every analysis relies on: wall-clock timestamps in UTC (trip
# durations must not move with daylight saving), runtime re-planning for
# skew and partition sizing, and dynamic partition overwrite so that a
# reload replaces only the partitions it writes.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "tallyframe",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_FALLBACK: dict[str, str] = {}


def session_key(spark: SparkSession) -> str:
    """An identifier of the running application (or of the session object
    where no context is exposed, as with a remote session)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - remote sessions expose no context
        return f"session-{id(spark)}"


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written tables.

    Read from ``spark.checkpoint.dir`` or, failing that, the checkpoint
    folder set on the context. A session on a local master that names
    neither gets a scratch folder of its own; any other master must name a
    folder that all machines share, and raises if it does not.
    """
    sc = spark.sparkContext
    app = session_key(spark)
    set_later = sc.getCheckpointDir()
    if app in _LOCAL_FALLBACK and (set_later or "").removeprefix("file:").startswith(_LOCAL_FALLBACK[app]):
        return _LOCAL_FALLBACK[app]
    configured = sc.getConf().get("spark.checkpoint.dir", None) or set_later
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="tallyframe-")
    atexit.register(shutil.rmtree, _LOCAL_FALLBACK[app], ignore_errors=True)
    sc.setCheckpointDir(os.path.join(_LOCAL_FALLBACK[app], "checkpoints"))
    return _LOCAL_FALLBACK[app]


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder written by this library, wherever it is stored."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
