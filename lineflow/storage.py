"""Small files in shared folders through Hadoop's file system API.

Leases and manifests are a few small files each.  What must be atomic is
done by the two operations that file systems offer for it: renaming a file
to a name that isn't taken, and creating a file only if it isn't there.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class AlreadyThere(RuntimeError):
    """The name is taken."""


def _at(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _cause(exc: Py4JJavaError) -> str:
    return exc.java_exception.getClass().getName().rsplit(".", 1)[-1]


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none for a missing one."""
    path, fs = _at(spark, folder)
    try:
        return sorted(s.getPath().getName() for s in fs.listStatus(path))
    except Py4JJavaError as exc:
        if _cause(exc) == "FileNotFoundException":
            return []
        raise


def read(spark: SparkSession, path: str) -> str:
    p, fs = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def modified(spark: SparkSession, path: str) -> int | None:
    """When a file was written last, in milliseconds of its file system's clock; None when it isn't there."""
    p, fs = _at(spark, path)
    try:
        return fs.getFileStatus(p).getModificationTime()
    except Py4JJavaError as exc:
        if _cause(exc) == "FileNotFoundException":
            return None
        raise


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path."""
    p, fs = _at(spark, path)
    return fs.getContentSummary(p).getLength()


def write(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """Write a small file; without ``overwrite`` only if there is none (``AlreadyThere``)."""
    p, fs = _at(spark, path)
    try:
        stream = fs.create(p, overwrite)
    except Py4JJavaError as exc:
        if _cause(exc) == "FileAlreadyExistsException" or not overwrite and fs.exists(p):
            raise AlreadyThere(path) from None
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> None:
    """Let a small file appear under a name whole and at once, or raise ``AlreadyThere`` when the name is taken."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    write(spark, draft, text)
    source, fs = _at(spark, draft)
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(source, jvm.org.apache.hadoop.fs.Path(path), no_options)
    except Py4JJavaError as exc:
        fs.delete(source, False)
        if _cause(exc) == "FileAlreadyExistsException":
            raise AlreadyThere(path) from None
        raise


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder that this library wrote."""
    p, fs = _at(spark, path)
    fs.delete(p, True)
