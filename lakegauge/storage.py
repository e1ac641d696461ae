"""A few file system calls, through the Hadoop client Spark already carries.

They work on any storage Spark can read. Only directory names are looked at,
never data.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or directory is there."""
    files, where = _open(spark, path)
    return files.exists(where)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a directory tree holds a data file; stops at the first one.

    Markers, checksums and files of a write in progress are not data.
    """
    files, where = _open(spark, path)
    if not files.exists(where):
        return False
    top = files.getFileStatus(where).getPath().toString()
    found = files.listFiles(where, True)
    while found.hasNext():
        below = found.next().getPath().toString().removeprefix(top)
        if not any(part.startswith(("_", ".")) for part in below.split("/")):
            return True
    return False


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a directory, empty when it is missing."""
    files, where = _open(spark, path)
    if not files.exists(where):
        return []
    return [entry.getPath().getName() for entry in files.listStatus(where)]


def create_until_exit(spark: SparkSession, path: str) -> None:
    """Create a directory that goes, with its content, when the driver ends."""
    files, where = _open(spark, path)
    files.mkdirs(where)
    files.deleteOnExit(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a directory tree."""
    files, where = _open(spark, path)
    files.delete(where, True)
