"""Tables that are replaced without a gap: versioned folders and a pointer.

A version is a folder that is written whole and never changed afterwards.  It
counts from the moment its pointer entry is complete: a file made by one
create-if-absent call, named by the version's number, that holds the folder's
name.  Readers take the complete entry with the highest number and open that
folder only, so they see the old version or the new one, whole, and at no time
none.  No folder is renamed, so nothing is copied on an object store.

Two writers that end at once both try for the next number: one entry is made,
the other writer finds the number taken and takes the following one (last one
wins; ``expected`` refuses instead).  That needs a file system whose create call
can fail on an existing file, as HDFS and local ones do; on a store without it
let one job at a time replace a table.  Old versions stay for ``keep`` more
replacements, for readers that resolved them before.

With ``partition_by`` and ``partitions_only`` a new version takes over the
partitions that the new rows do not hold: their files are listed in the
version's manifest (a small Parquet table of partition paths), not copied.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyframe.sinks.fs import children, create_once, delete, read_bytes, write_bytes

KEEP = 2
_NAME_LENGTH = 32


class VersionConflict(RuntimeError):
    """Another writer has replaced the table in the meantime."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str


def _entries(spark: SparkSession, path: str) -> list[Version]:
    """All versions, oldest first; an entry that its writer has not finished is none yet."""
    root, found = f"{path.rstrip('/')}/current", []
    for name in sorted(children(spark, root)):
        folder = read_bytes(spark, f"{root}/{name}").decode()
        if len(folder) == _NAME_LENGTH:
            found.append(Version(int(name), folder))
    return found


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The version in force, or None for a table that was never written."""
    entries = _entries(spark, path)
    return entries[-1] if entries else None


def _paths(spark: SparkSession, path: str, version: Version) -> list[str]:
    """The folders that hold the rows of a version."""
    listed = read_bytes(spark, f"{path.rstrip('/')}/versions/{version.folder}.parts")
    return listed.decode().splitlines()


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the version in force when this is called; later replacements do not change them."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"{path} has no version")
    return read_version(spark, path, version)


def read_version(spark: SparkSession, path: str, version: Version) -> DataFrame:
    root = path.rstrip("/")
    parts = _paths(spark, path, version)
    whole = [p for p in parts if "=" not in p]
    if whole:
        return spark.read.parquet(*[f"{root}/versions/{p}" for p in whole])
    # Partitions of several versions: each version's folder is a base of its own.
    frames = [spark.read.option("basePath", f"{root}/versions/{base}").parquet(
        *[f"{root}/versions/{p}" for p in parts if p.split("/", 1)[0] == base])
        for base in dict.fromkeys(p.split("/", 1)[0] for p in parts)]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _partitions(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Paths, below ``folder``, of its partitions ``depth`` levels down."""
    found = [""]
    for _ in range(depth):
        found = [f"{p}/{c}" if p else c for p in found for c in children(spark, f"{folder}/{p}" if p else folder) if "=" in c]
    return found


def replace_version(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    partitions_only: bool = False,
    expected: Version | None = None,
    keep: int = KEEP,
) -> Version:
    """Write ``df`` as a new version of the table and put it in force.

    ``partitions_only`` replaces the partitions that ``df`` holds and keeps the
    others.  ``expected`` is the version the caller read: if another is in force
    by now, nothing changes and ``VersionConflict`` is raised.  A failed job
    leaves the table as it was.
    """
    if partitions_only and not partition_by:
        raise ValueError("partitions_only needs partition_by")
    spark, root = df.sparkSession, path.rstrip("/")
    name = uuid.uuid4().hex
    folder = f"{root}/versions/{name}"
    writer = df.write.mode("errorifexists")
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    except Exception:
        delete(spark, folder)
        raise
    own = [f"{name}/{p}" for p in _partitions(spark, folder, len(partition_by))] if partition_by else [name]
    while True:
        before = current_version(spark, path)
        if expected is not None and before != expected:
            delete(spark, folder)
            raise VersionConflict(f"{path} is at {before}, not at {expected}")
        parts = own
        if partitions_only and before is not None:
            fresh = {p.split("/", 1)[1] for p in own}
            parts = own + [p for p in _paths(spark, path, before) if p.split("/", 1)[-1] not in fresh]
        write_bytes(spark, f"{folder}.parts", "\n".join(parts).encode())
        version = Version(0 if before is None else before.number + 1, name)
        if create_once(spark, _entry(root, version.number), name.encode()):
            break
    _drop_old(spark, path, keep)
    return version


def _entry(root: str, number: int) -> str:
    return f"{root}/current/{number:012d}"


def _drop_old(spark: SparkSession, path: str, keep: int) -> None:
    """Drop all but the newest versions, and the folders that none of these opens."""
    root = path.rstrip("/")
    entries = _entries(spark, path)
    kept = entries[-(keep + 1):]
    used = {p.split("/", 1)[0] for v in kept for p in _paths(spark, path, v)}
    for old in entries[:-(keep + 1)]:
        delete(spark, _entry(root, old.number))
        delete(spark, f"{root}/versions/{old.folder}.parts")
    dropped = {v.folder for v in entries[:-(keep + 1)]}
    for folder in children(spark, f"{root}/versions"):
        # Folders without an entry may be another writer's, still being written.
        if folder in dropped and folder not in used:
            delete(spark, f"{root}/versions/{folder}")
