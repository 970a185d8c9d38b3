"""Folders of any file system that Spark reaches."""

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, none of a folder that does not exist."""
    files, where = _at(spark, path)
    if not files.exists(where):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(where))


def delete(spark: SparkSession, path: str) -> None:
    files, where = _at(spark, path)
    files.delete(where, True)


def delete_if_empty(spark: SparkSession, path: str) -> None:
    if exists(spark, path) and not children(spark, path):
        delete(spark, path)


def move(spark: SparkSession, path: str, to: str) -> None:
    """A folder under another name, whose own folder is made where it is missing."""
    files, where = _at(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    files.mkdirs(target.getParent())
    if not files.rename(where, target):
        raise OSError(f"{path} could not be moved to {to}.")
