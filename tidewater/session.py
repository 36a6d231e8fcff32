"""Session construction and the shared scratch area.

Jobs never pick a machine-local folder on their own: every file a job
writes for itself (landed roots, checkpoints, bucketed tables) goes under
the shared folder the cluster names in ``spark.checkpoint.dir``. Only a
local session (one machine, as in tests) gets a temporary one where that is
unset; on a cluster an unset folder is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins and shuffles at runtime:
# it coalesces small shuffle partitions, splits skewed join partitions and
# splits skewed partitions of a REBALANCE (used before partitioned writes).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Partitioned writes cost per file, not per byte: a small batch spread over
    # many date/hour directories should still be written by several tasks.
    # Irrelevant for big shuffles, whose partitions are far above this floor.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(
    app: str = "tidewater",
    master: str | None = None,
    tz: str = "UTC",
    hive: bool = False,
    metastore_uri: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict | None = None,
    largest_shuffle_bytes: int | None = None,
) -> SparkSession:
    """Session with UTC time, ANSI left on, AQE and the scale settings.

    ``largest_shuffle_bytes`` sizes ``spark.sql.shuffle.partitions`` so the
    largest shuffle (e.g. a full landing of the day's data) gets ~128 MB per
    reducer; AQE coalesces the partitions of smaller stages. Spark's default
    of 200 would give 500 GB reducers for a 100 TB shuffle.

    ``hive=True`` is the Hive-enabled session of the batch copy job; it talks
    to the cluster's metastore (``metastore_uri`` or hive-site.xml).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.sql.session.timeZone", tz).config("spark.ui.enabled", "false")
    b = b.config("spark.ui.showConsoleProgress", "false")
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions is None and largest_shuffle_bytes:
        shuffle_partitions = shuffle_partitions_for(largest_shuffle_bytes)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    if hive:
        # The metastore is the cluster's (hive-site.xml on the classpath, or
        # ``metastore_uri``); no embedded metastore database is started here.
        b = b.config("spark.sql.catalogImplementation", "hive")
        if metastore_uri:
            b = b.config("spark.hadoop.hive.metastore.uris", metastore_uri)
        b = b.enableHiveSupport()
    return b.getOrCreate()


def shuffle_partitions_for(shuffle_bytes: int, per_partition: int = 128 * 1024 * 1024) -> int:
    """Reducer count that keeps each shuffle partition near ``per_partition``."""
    return max(200, -(-int(shuffle_bytes) // per_partition))


def pin_utc(spark: SparkSession) -> None:
    """Time-dependent queries read and print times in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Where it is unset, a local session gets a temporary one; any other
    session raises, since its executors don't share the driver's disk.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, read the setting
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    root = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(root)
        return sc.getCheckpointDir().rstrip("/")
    return root


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one job run."""
    return f"{shared_root(spark)}/tidewater/{name}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def package_zip() -> str:
    """This package as a zip in the driver's temporary folder."""
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidewater-zip-"), "tidewater.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once per
    application: their import path doesn't hold the driver's folder."""
    app = spark.conf.get("spark.app.id", "") or str(id(spark))
    if app in _SHIPPED:
        return
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        sc = None
    if sc is not None:
        sc.addPyFile(package_zip())
    else:
        spark.addArtifacts(package_zip(), pyfile=True)
    _SHIPPED.add(app)
