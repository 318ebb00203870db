"""Small files and folders through Hadoop's file system, so that addresses mean the same as in Spark's own readers and writers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import cut, shared_dir


def _at(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, place, system = _at(spark, path)
    return system.exists(place)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """The whole file at once: it is written beside its place and moved there, replacing what was there."""
    jvm, place, system = _at(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}")
    out = system.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "OVERWRITE")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(system.makeQualified(beside), system.makeQualified(place), options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file; None where there is none."""
    jvm, place, system = _at(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    _, place, system = _at(spark, path)
    system.delete(place, True)


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def read_and_removed(df: DataFrame, *folders: str) -> DataFrame:
    """The rows of df, kept as a checkpoint, once the folders they were read from are gone."""
    kept = cut(df)
    for folder in folders:
        delete(df.sparkSession, folder)
    return kept
