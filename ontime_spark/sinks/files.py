"""The few file-system questions that reading and writing frames cannot answer."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _resolve(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder or file that this library wrote."""
    fs, where = _resolve(spark, path)
    fs.delete(where, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if it is not there."""
    fs, where = _resolve(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def delete_below(spark: SparkSession, path: str, ending: str) -> None:
    """Removes what a folder of this library holds under names with this ending."""
    for name in names(spark, path):
        if name.endswith(ending):
            delete(spark, f"{path}/{name}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, where = _resolve(spark, path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, compressed or not; empty for an empty file."""
    jvm = spark.sparkContext._jvm
    fs, where = _resolve(spark, path)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    codec, stream = codecs.getCodec(where), fs.open(where)
    try:
        plain = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Makes a small file that appears whole; False if there is one of that name."""
    jvm = spark.sparkContext._jvm
    fs, where = _resolve(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE  # fails where the name is taken
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(where), how)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" not in error.java_exception.toString():
            raise
        return False
    return True
