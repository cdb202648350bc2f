"""Session helpers.

The library never builds its own cluster configuration: on a cluster the caller's
session is used as-is. ``get_session`` is for local runs, tests and the bench.
"""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job in this package assumes. Wall-clock timestamps are handled as
# TIMESTAMP_NTZ, but casts from zoned inputs still need a fixed zone.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "cabstar",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Applications that have the package on their workers.
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once an application, as ``--py-files`` would.

    Functions that run on executors are imported there by name; a session that somebody
    else started need not have the package on its workers' path.
    """
    application = spark.conf.get("spark.app.id", "") or str(id(spark))
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="cabstar-ship-")  # read by the driver only, which serves the file
    archive = shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)
    try:
        spark.sparkContext.addPyFile(archive)
    except Exception:  # noqa: BLE001 - Spark Connect has artifacts instead of a context
        spark.addArtifacts(archive, pyfile=True)
    _shipped.add(application)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/ABFS) folder and is
    used as given. Only when nothing is configured (local tests) a scratch folder is
    created, so a machine-local path is never chosen when the cluster names one.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no driver-side context, use the conf
        sc = None
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS)")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS) for this cluster")
        configured = tempfile.mkdtemp(prefix="cabstar-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
