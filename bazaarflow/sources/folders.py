"""Small files in any store that Spark reaches, through Hadoop's file interface."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, place: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)


def _system(spark: SparkSession, place: str):
    return _path(spark, place).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none where it doesn't exist."""
    system, path = _system(spark, folder), _path(spark, folder)
    if not system.exists(path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(path))


def read_text(spark: SparkSession, place: str) -> str:
    stream = _system(spark, place).open(_path(spark, place))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, place: str, text: str) -> bool:
    """Create the file with all its content, or return False where it exists already.

    The content is written aside and moved; of several writers only one can move to
    a name. That holds where the store renames atomically (HDFS and the like).
    """
    jvm = spark.sparkContext._jvm
    system = _system(spark, place)
    target = _path(spark, place)
    if system.exists(target):
        return False
    system.mkdirs(target.getParent())
    aside = _path(spark, f"{place.rpartition('/')[0]}/.{uuid.uuid4().hex}.tmp")
    out = system.create(aside)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    refuse = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(system.makeQualified(aside), system.makeQualified(target), refuse)
        return True
    except Py4JJavaError as error:
        system.delete(aside, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName() or system.exists(target):
            return False
        raise
