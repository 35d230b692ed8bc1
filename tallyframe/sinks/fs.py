"""The session's Hadoop file system, for listing, renaming and deleting folders.

PySpark has no public file-system API; the JVM's FileSystem (same credentials
and scheme handling as Spark's readers and writers) is reached through the
gateway.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(FileSystem, Path) of ``path``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme, authority and working directory filled in and ``..`` resolved."""
    fs, p = file_system(spark, path)
    full = fs.makeQualified(p).toString()
    scheme, _, rest = full.partition(":")
    parts: list[str] = []
    for part in rest.split("/"):
        if part == "..":
            if parts and parts[-1]:
                parts.pop()
        elif part != ".":
            parts.append(part)
    # The object store's schemes name one store.
    scheme = {"s3": "s3a", "s3n": "s3a"}.get(scheme, scheme)
    text = f"{scheme}:" + "/".join(parts)
    return "file:/" + text[5:].lstrip("/") if scheme == "file" else text


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    fs, p = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def data_file_name(spark: SparkSession, path: str) -> str | None:
    """Name of the first data file of a file or folder input, or None."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    if fs.getFileStatus(p).isFile():
        return p.getName()
    files = fs.listFiles(p, True)
    while files.hasNext():
        found = files.next().getPath()
        if not found.getName().startswith(("_", ".")):
            return found.getName()
    return None


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    fs, p = file_system(spark, path)
    out = fs.create(p)
    out.write(data)
    out.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Make the folder and have the driver's file system delete it when the application ends."""
    fs, p = file_system(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)


def create_once(spark: SparkSession, path: str, data: bytes = b"") -> bool:
    """Create a file unless it exists; False if it does.  One call of the file system, so it is there whole or not."""
    fs, p = file_system(spark, path)
    try:
        out = fs.create(p, False)
    except Exception:
        if fs.exists(p):
            return False
        raise
    out.write(data)
    out.close()
    return True


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file, whole."""
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()
