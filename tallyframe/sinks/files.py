"""File sinks: Parquet replace, and the full-materialisation null sink."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyframe.sinks.fs import data_file_name, delete, file_system, qualified

__all__ = [
    "data_file_name", "load_table", "overlaps", "replace_folder", "write_counted", "write_noop", "write_parquet",
]


def overlaps(a: str, b: str) -> bool:
    """True if one qualified path equals or contains the other."""
    na, nb = a.rstrip("/") + "/", b.rstrip("/") + "/"
    return na.startswith(nb) or nb.startswith(na)


def _swap_into_place(spark: SparkSession, staging: str, target: str) -> None:
    """Replace ``target`` by the finished ``staging`` folder (Hadoop FS renames).

    The old folder is renamed aside first and deleted only after the new one
    is in place; if moving the new one in fails or throws, the old one is put
    back and the staging folder deleted.  Between the two renames the target
    does not exist; its rows do, under the ``.previous-`` name.
    """
    fs, target_path = file_system(spark, target)
    _, staging_path = file_system(spark, staging)
    backup = None
    try:
        if fs.exists(target_path):
            _, backup_path = file_system(spark, f"{target.rstrip('/')}.previous-{uuid.uuid4().hex}")
            if not fs.rename(target_path, backup_path):
                raise IOError(f"could not move the old {target} aside")
            backup = backup_path
        if not fs.rename(staging_path, target_path):
            raise IOError(f"could not move {staging} to {target}")
    except Exception:
        if backup is not None and not fs.exists(target_path):
            fs.rename(backup, target_path)
        fs.delete(staging_path, True)
        raise
    if backup is not None:
        fs.delete(backup, True)


def replace_folder(df: DataFrame, path: str, fmt: str = "parquet", options: dict[str, str] | None = None) -> str:
    """Write ``df`` beside ``path`` and swap it in once the job has committed."""
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    try:
        df.write.format(fmt).options(**(options or {})).mode("errorifexists").save(staging)
    except Exception:
        delete(df.sparkSession, staging)
        raise
    _swap_into_place(df.sparkSession, staging, path)
    return path


def load_table(df: DataFrame, fmt: str, options: dict[str, str], mode: str = "overwrite") -> None:
    """Load ``df`` into a table named by a data source format and its options.

    A file format with a ``path`` option is staged and swapped like
    ``write_parquet(swap=True)`` when it replaces the table.  Any other source
    (a warehouse connector, ``jdbc``) gets the options as they are; whether its
    overwrite is atomic is the connector's promise.  For JDBC see also
    ``sinks.jdbc.replace_table``.
    """
    if "path" in options and mode == "overwrite":
        replace_folder(df, options["path"], fmt, {k: v for k, v in options.items() if k != "path"})
    else:
        df.write.format(fmt).options(**options).mode(mode).save()


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    source_paths: list[str] | tuple[str, ...] = (),
    swap: bool = False,
) -> str:
    """Write ``df`` as Parquet and return ``path``.

    * Refuses to overwrite a folder that is, contains or lies inside one of the
      job's own inputs: Spark deletes the target before the tasks read it.
    * With ``partition_by`` only the partitions present in ``df`` are
      replaced (dynamic partition overwrite); others are kept.
    * Files are committed by Spark's output committer, so a retried or
      speculative task never leaves a duplicate file behind.
    * Spark's own ``overwrite`` deletes the old files before the job runs, so
      a failed job leaves nothing.  With ``swap=True`` (whole-folder replace
      only) the job writes a sibling staging folder and the old folder is
      replaced only after the job has committed; a failed job leaves the old
      output readable.  The swap is two renames and a delete of the old
      folder: renames are atomic on HDFS, copies on object stores.
    """
    spark = df.sparkSession
    for source in source_paths:
        if overlaps(qualified(spark, path), qualified(spark, source)):
            raise ValueError(f"refusing to write {path!r}: it overlaps the input {source!r}")
    if swap:
        if partition_by or mode != "overwrite":
            raise ValueError("swap replaces a whole folder: mode 'overwrite' without partition_by")
        return replace_folder(df, path)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run ``write`` on ``df`` and return how many rows it wrote.

    The count is an observed metric of the write itself (``Observation``),
    so the plan runs once; a separate ``count()`` would compute it twice.
    """
    observation = Observation("rows_written")
    write(df.observe(observation, F.count(F.lit(1)).alias("rows")))
    return int(observation.get["rows"])


def write_noop(df: DataFrame) -> None:
    """Run the whole plan and discard the rows (benchmarks, plan inspection)."""
    df.write.mode("overwrite").format("noop").save()
