"""Session construction and the shared scratch location.

Every intermediate this library writes (CSV round trips, stream checkpoints,
published tables in the self-checking queries) goes under the folder the
cluster names in ``spark.checkpoint.dir``.  That folder is expected to be on
shared storage (HDFS, an object store, a network volume) so that a lost
executor or a restarted driver can still see it.  Only local-mode sessions
(tests, benchmarks on one machine) may fall back to a temporary folder.
"""

from __future__ import annotations

import io
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

from tallyframe.sinks.fs import delete_at_exit, qualified, write_bytes

# Settings every session of ours wants, whatever the cluster size.
# Static auto-broadcast is off: it decides from file-size estimates, which
# can be far below the decoded size.  Broadcasts happen either behind an
# explicit row and byte check (``operators.joins``) or at run time through AQE,
# which measures the actual size of a finished shuffle stage.
BASE_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Target bytes per shuffle partition after AQE coalescing, and the size from
# which a join partition counts as skewed and is split.
ADVISORY_PARTITION_BYTES = 128 * 1024 * 1024
SKEWED_PARTITION_BYTES = 512 * 1024 * 1024


def cluster_conf(total_cores: int, largest_shuffle_bytes: int) -> dict[str, str]:
    """Settings sized for a cluster run.

    The starting shuffle partition count is high enough that each reduce task
    of the largest shuffle gets about ``ADVISORY_PARTITION_BYTES`` (so it
    fits in executor memory without spilling much), and at least a few waves
    over all cores; AQE then coalesces the small shuffles of the same job.
    Scan splits stay at 128 MB.
    """
    by_size = -(-largest_shuffle_bytes // ADVISORY_PARTITION_BYTES)
    partitions = max(2 * total_cores, by_size)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(ADVISORY_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(SKEWED_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    }


def build_session(
    master: str | None = None,
    app_name: str = "tallyframe",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with AQE, skew-join handling and UTC time.

    ``shuffle_partitions`` is the starting point AQE coalesces from; on a
    cluster leave it at a few times the total core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    # local-cluster runs executors of their own, which share no folder.
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder named by the cluster, or ``None`` if there is none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/") if current else None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure the session has a checkpoint folder and return its root.

    The cluster's setting always wins and is trusted to be shared, whatever
    its scheme.  Only a local-mode session without one
    gets a fresh temporary folder; a cluster session without one is an error,
    because a machine-local folder would not survive the loss of that machine.
    """
    root = checkpoint_root(spark)
    if root:
        return root
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS, object store) before running jobs that write intermediates"
        )
    root = tempfile.mkdtemp(prefix="tallyframe-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    return checkpoint_root(spark) or root


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, never reused path under the shared checkpoint root.

    Its parent folder is made now and deleted when the application ends.
    """
    own = f"{ensure_checkpoint_dir(spark)}/tallyframe/{kind}-{uuid.uuid4().hex}"
    if getattr(spark.sparkContext, "_jvm", None) is not None:
        delete_at_exit(spark, own)
    return f"{own}/data"


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Functions that run in Python workers are found there by import, whatever
    the workers' own path holds.  The zip goes through the shared folder.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tallyframe_shipped", None) == sc.applicationId:
        return
    root = pathlib.Path(__file__).resolve().parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent).as_posix())
    path = scratch_path(spark, "package") + "/tallyframe.zip"
    write_bytes(spark, path, buffer.getvalue())
    sc.addPyFile(qualified(spark, path))
    sc._tallyframe_shipped = sc.applicationId
