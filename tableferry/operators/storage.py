"""Folders of sinks, through the file systems that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession

# fixed values: file systems that rename a folder in one step, whatever it holds
_RENAMES_AT_ONCE = ("file", "hdfs", "viewfs", "webhdfs", "ofs", "abfs", "abfss")


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def renames_at_once(spark: SparkSession, path: str) -> bool:
    return _at(spark, path)[1].getScheme() in _RENAMES_AT_ONCE


def folder_exists(spark: SparkSession, path: str) -> bool:
    place, system = _at(spark, path)
    return system.exists(place)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; one that is gone already is no error."""
    place, system = _at(spark, path)
    system.delete(place, True)


def delete_file(spark: SparkSession, uri: str) -> None:
    """Delete one file, named as Spark names the files of a table: by its URI."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, False)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; the new name must be free, or the folder would go into the one that has it."""
    place, system = _at(spark, path)
    target, _ = _at(spark, to)
    if system.exists(target):
        raise FileExistsError(to)
    if not system.rename(place, target):
        raise OSError(f"{path} cannot be renamed {to}")
