"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; spark-submit decides the master on a cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def clear_shared(spark: SparkSession) -> None:
    """Delete this application's part of the shared folder. Tables that were written there can no longer be read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_dir(spark: SparkSession) -> str:
    """This application's part of the folder named by ``spark.checkpoint.dir``, which every
    executor can reach. It can be deleted when the application has ended.

    Only a local master may fall back to a folder of its own: on a cluster a machine-local
    folder would be lost with its machine, so there a missing setting is an error.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="earshot-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/{sc.applicationId}"
