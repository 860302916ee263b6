"""The few file operations that DataFrames do not offer, on any Hadoop file system."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file; ``target`` must not exist, its folder is made."""
    old, fs = _path(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(new.getParent())
    if fs.exists(new) or not fs.rename(old, new):
        raise OSError(f"cannot move {path} to {target}")


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, e.g. partition folders."""
    p, fs = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or ())


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a parquet table has been written at ``path``, with at least one file."""
    return bool(exists(spark, path) and (matching(spark, f"{path}/*.parquet") or matching(spark, f"{path}/*=*")))


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with this text unless there is one: False, and nothing changed, if there is. The file
    appears whole or not at all, and only one of several creators gets it. On local disks that is a hard link, elsewhere
    a rename that refuses an existing target (atomic on HDFS and ABFS)."""
    target, fs = _path(spark, path)
    parent = target.getParent()
    fs.mkdirs(parent)
    temporary = spark._jvm.org.apache.hadoop.fs.Path(parent, f".{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(temporary.toUri().getPath(), target.toUri().getPath())
        else:
            jvm, gateway = spark._jvm, spark.sparkContext._gateway
            no_options = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            conf = spark._jsparkSession.sessionState().newHadoopConf()
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(temporary, target, no_options)
    except FileExistsError:
        return False
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(temporary, False)
    return True
