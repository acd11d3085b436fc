"""One meaning of a path for the driver and for tasks.

Spark resolves a path with its Hadoop settings: a bare one against the default file system.  The driver does the same
here, once, and tasks get the full URI, which pyarrow opens.
"""

from __future__ import annotations

import os
import uuid

import pyarrow.fs as pafs
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Hadoop's scheme -> pyarrow's, where they differ.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}
KNOWN = ("file", "hdfs", "viewfs", "s3", "gs", "abfs", "abfss", "mock")


def _hadoop(spark: SparkSession, path: str):
    sc = spark.sparkContext
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(sc._jsc.hadoopConfiguration()), hpath


def qualified(spark: SparkSession, path: str) -> str:
    """The full URI of a path, as Spark's own readers and writers understand it."""
    fs, hpath = _hadoop(spark, path)
    return fs.makeQualified(hpath).toString()


def readable(spark: SparkSession, path: str) -> str:
    """The full URI of a path that tasks can open without Spark; others are refused here, before any task runs."""
    uri = path if scheme_of(path) in SCHEMES or scheme_of(path) in KNOWN else qualified(spark, path)
    scheme = scheme_of(uri)
    if SCHEMES.get(scheme, scheme) not in KNOWN:
        raise ValueError(f"binary recordings cannot be kept at {uri}: tasks have no way to open {scheme}:")
    return uri


def scheme_of(path: str) -> str:
    head, sep, _ = path.partition(":")
    return head.lower() if sep and "/" not in head else ""


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a full URI, and the path in it.  For driver and tasks."""
    scheme = scheme_of(uri)
    if not scheme:
        raise ValueError(f"{uri!r} is no full URI; resolve it on the driver first")
    rest = uri[len(scheme) + 1 :]
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _hadoop(spark, path)
    return fs.exists(hpath)


def entries(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Name and time of change (epoch seconds) of what a folder holds; nothing if there is no such folder."""
    fs, hpath = _hadoop(spark, path)
    if not fs.exists(hpath):
        return []
    return [(s.getPath().getName(), s.getModificationTime() / 1e3) for s in fs.listStatus(hpath)]


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file under its name only when it is whole; False if the name is taken."""
    fs, hpath = _hadoop(spark, path)
    staged = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(hpath.getParent(), f"_{uuid.uuid4().hex}")
    out = fs.create(staged, False)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.exists(hpath) and fs.rename(staged, hpath):
        return True
    fs.delete(staged, False)
    return False


def write_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless its name is taken; of several at once exactly one gets the name, and nobody sees half a file.

    On a local file system a hard link takes the name.  Elsewhere the file system's own rename does, which leaves an existing file alone
    (as HDFS promises), or, on object stores, which write a file under its name when it is closed, a create that refuses to overwrite.
    """
    fs, hpath = _hadoop(spark, path)
    fs.mkdirs(hpath.getParent())
    uri = fs.makeQualified(hpath).toString()
    if scheme_of(uri) == "file":
        name = open_fs(uri)[1]
        staged = f"{os.path.dirname(name)}/_{uuid.uuid4().hex}"
        with open(staged, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(staged, name)
        except FileExistsError:
            return False
        finally:
            os.unlink(staged)
        return True
    if scheme_of(uri) in ("hdfs", "viewfs"):
        return write_once(spark, path, text)
    try:
        out = fs.create(hpath, False)
        out.write(bytearray(text.encode()))
        out.close()
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hpath = _hadoop(spark, path)
    fs.mkdirs(hpath)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as a whole."""
    fs, hpath = _hadoop(spark, path)
    source = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a folder; False if it is gone or the new name is taken."""
    fs, hpath = _hadoop(spark, path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    return not fs.exists(target) and fs.exists(hpath) and fs.rename(hpath, target)


def remove(spark: SparkSession, path: str) -> None:
    fs, hpath = _hadoop(spark, path)
    fs.delete(hpath, True)
