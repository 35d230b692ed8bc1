"""Per-stage run figures from Spark's JSON event logs.

Event logs are JSON lines, one listener event per line.  They are read with a
narrow declared schema (inference would scan every line and trips over field
names that differ only by case), so a cluster's whole log history can be
summarised as an ordinary distributed job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_L = T.LongType()
_I = T.IntegerType()
_S = T.StringType()


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in pairs])


# Field names as Spark's JSON event protocol writes them.
EVENT_LOG_SCHEMA = _fields(
    ("Event", _S),
    ("Stage ID", _I),
    ("Stage Attempt ID", _I),
    ("Task End Reason", _fields(("Reason", _S))),
    ("Task Info", _fields(("Failed", T.BooleanType()), ("Killed", T.BooleanType()))),
    ("Task Metrics", _fields(
        ("Executor Run Time", _L),
        ("Memory Bytes Spilled", _L),
        ("Disk Bytes Spilled", _L),
        ("Shuffle Read Metrics", _fields(("Remote Bytes Read", _L), ("Local Bytes Read", _L),
                                         ("Total Records Read", _L))),
        ("Shuffle Write Metrics", _fields(("Shuffle Bytes Written", _L), ("Shuffle Records Written", _L))),
        ("Input Metrics", _fields(("Bytes Read", _L), ("Records Read", _L))),
    )),
    ("Stage Info", _fields(("Stage ID", _I), ("Stage Attempt ID", _I), ("Stage Name", _S),
                           ("Number of Tasks", _I))),
)


def read_event_logs(spark: SparkSession, path: str) -> DataFrame:
    """Event log lines under ``path`` (a file, a folder or a glob).

    Rolling logs live in one sub-folder per application
    (``eventlog_v2_<app id>/events_<n>_<app id>[.zstd]``), so folders are
    searched recursively.  Compressed logs of finished applications are
    decompressed by the reader.
    """
    return (
        spark.read.schema(EVENT_LOG_SCHEMA)
        .option("recursiveFileLookup", "true")
        .json(path)
        .withColumn("log_file", F.input_file_name())
        .withColumn("app", _application("log_file"))
    )


def _application(path: str):
    """The application a log file belongs to, from its name.

    A rolled log is a folder ``eventlog_v2_<app>`` whose files belong
    together; a single log is a file named after the application.
    """
    rolled = F.regexp_extract(path, r"/eventlog_v2_([^/]+)/[^/]*$", 1)
    single = F.regexp_extract(path, r"([^/]+?)(?:\.(?:zstd|lz4|lzf|snappy|inprogress|compact))*$", 1)
    return F.when(rolled != "", rolled).otherwise(single)


def stage_metrics(events: DataFrame) -> DataFrame:
    """One row per (application, stage, attempt) with task and shuffle figures.

    Columns: ``app``, ``stage_id``, ``stage_attempt``, ``stage_name``,
    ``tasks``, ``failed_tasks``, ``run_time_ms``, ``input_bytes``,
    ``shuffle_read_bytes``, ``shuffle_write_bytes``, ``shuffle_write_records``,
    ``memory_spill_bytes``, ``disk_spill_bytes``.
    """
    m = F.col("Task Metrics")
    tasks = (
        events.where(F.col("Event") == "SparkListenerTaskEnd")
        .groupBy("app", F.col("Stage ID").alias("stage_id"), F.col("Stage Attempt ID").alias("stage_attempt"))
        .agg(
            F.count(F.lit(1)).alias("tasks"),
            F.count(F.when(F.col("Task Info.Failed") | F.col("Task Info.Killed"), 1)).alias("failed_tasks"),
            F.coalesce(F.sum(m["Executor Run Time"]), F.lit(0)).alias("run_time_ms"),
            F.coalesce(F.sum(m["Input Metrics"]["Bytes Read"]), F.lit(0)).alias("input_bytes"),
            F.coalesce(F.sum(F.coalesce(m["Shuffle Read Metrics"]["Remote Bytes Read"], F.lit(0))
                             + F.coalesce(m["Shuffle Read Metrics"]["Local Bytes Read"], F.lit(0))),
                       F.lit(0)).alias("shuffle_read_bytes"),
            F.coalesce(F.sum(m["Shuffle Write Metrics"]["Shuffle Bytes Written"]), F.lit(0)).alias("shuffle_write_bytes"),
            F.coalesce(F.sum(m["Shuffle Write Metrics"]["Shuffle Records Written"]), F.lit(0)).alias("shuffle_write_records"),
            F.coalesce(F.sum(m["Memory Bytes Spilled"]), F.lit(0)).alias("memory_spill_bytes"),
            F.coalesce(F.sum(m["Disk Bytes Spilled"]), F.lit(0)).alias("disk_spill_bytes"),
        )
    )
    info = F.col("Stage Info")
    names = (
        events.where(F.col("Event") == "SparkListenerStageCompleted")
        .select(
            "app",
            info["Stage ID"].alias("stage_id"),
            info["Stage Attempt ID"].alias("stage_attempt"),
            info["Stage Name"].alias("stage_name"),
        )
        .dropDuplicates(["app", "stage_id", "stage_attempt"])
    )
    return tasks.join(names, ["app", "stage_id", "stage_attempt"], "left").select(
        "app", "stage_id", "stage_attempt", "stage_name", "tasks", "failed_tasks", "run_time_ms",
        "input_bytes", "shuffle_read_bytes", "shuffle_write_bytes", "shuffle_write_records",
        "memory_spill_bytes", "disk_spill_bytes",
    )


def current_app_log(spark: SparkSession) -> str | None:
    """Glob of this application's event log, or None when logging is off or has no named folder."""
    if spark.conf.get("spark.eventLog.enabled", "false").lower() != "true":
        return None
    log_dir = spark.conf.get("spark.eventLog.dir", None)
    if not log_dir:
        return None
    # The id may be followed by an attempt or a suffix, never by more of an id.
    app = spark.sparkContext.applicationId
    return f"{log_dir.rstrip('/')}/{{{app},{app}[._]*,eventlog_v2_{app},eventlog_v2_{app}_*}}"
