"""Driver-side file metadata through the cluster's own file system client."""

from __future__ import annotations

import time
from fnmatch import fnmatch

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return bool(file_system(spark, path).exists(_path(spark, path)))


def child_names(spark: SparkSession, path: str) -> list[str]:
    if not exists(spark, path):
        return []
    return sorted(status.getPath().getName() for status in file_system(spark, path).listStatus(_path(spark, path)))


def matching_files(spark: SparkSession, glob: str) -> list[str]:
    found = file_system(spark, glob).globStatus(_path(spark, glob))
    return sorted(status.getPath().toString() for status in (found or []) if status.isFile())


def remove_path(spark: SparkSession, path: str) -> bool:
    """Drop one partition folder or version folder of a table."""
    return bool(file_system(spark, path).delete(_path(spark, path), True))


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    stream = file_system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, replaced if it is there."""
    stream = file_system(spark, path).create(_path(spark, path), True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def publish(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file unless ``target`` is there, by the file system's own atomic rename; was it renamed?"""
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(_path(spark, target).toUri(), spark._jsc.hadoopConfiguration())
    options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(_path(spark, source), _path(spark, target), options)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def folders_named(spark: SparkSession, base: str, pattern: str) -> list[str]:
    """Folders below ``base`` that match a pattern of names, relative to it."""
    system = file_system(spark, base)
    found = system.globStatus(_path(spark, f"{base}/{pattern}"))
    levels = pattern.count("/") + 1
    return sorted("/".join(status.getPath().toString().rsplit("/", levels)[1:]) for status in found or [] if status.isDirectory())


def modified_at(spark: SparkSession, path: str) -> float:
    """When a file or folder was last modified, in seconds; it may have gone."""
    if not exists(spark, path):
        return now_at()
    return file_system(spark, path).getFileStatus(_path(spark, path)).getModificationTime() / 1000


def now_at() -> float:
    return time.time()


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """URI, name and size of the files below ``path``; contents are not read.

    Names and sizes come from the file system itself: a file scan would leave out empty files, which
    the arrival gate has to see. Meant for the folder of one run, which holds a handful of files.
    """
    found = []
    if exists(spark, path):
        entries = file_system(spark, path).listFiles(_path(spark, path), True)
        while entries.hasNext():
            entry = entries.next()
            name = entry.getPath().getName()
            if fnmatch(name, pattern):
                found.append((entry.getPath().toString(), name, entry.getLen()))
    return spark.createDataFrame(found, "object_uri string, file_name string, size_bytes bigint")
