"""Write, audit, publish: versioned table folders behind one pointer.

A run claims a version number and writes all its tables below ``versions/<number>``.  Readers follow the pointer file
``CURRENT``; it is replaced by one atomic rename once every data test of the run has passed.  A run that fails, or is
killed half way, leaves the pointer and the published tables as they were.

A number is claimed by creating its file exclusively, so two runs at once get two numbers.  On HDFS and local disks create
and rename are atomic; on an object store without an atomic rename use a committer or catalogue that has one.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def create_exclusively(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already."""
    fs, where = _fs(spark, path)
    fs.mkdirs(where.getParent())
    if fs.getScheme() == "file":  # Hadoop's local create first looks, then writes
        try:
            os.close(os.open(where.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            return True
        except FileExistsError:
            return False
    try:
        fs.create(where, False).close()
        return True
    except Py4JJavaError as e:
        if fs.exists(where):
            return False
        raise e


def claim_number(spark: SparkSession, folder: str, above: int = 0) -> int:
    """The next free number in ``folder``, larger than ``above``; no other caller gets it."""
    fs, where = _fs(spark, folder)
    taken = [int(f.getPath().getName()) for f in fs.listStatus(where)
             if f.getPath().getName().isdigit()] if fs.exists(where) else []
    number = max([above, *taken]) + 1
    while not create_exclusively(spark, f"{folder}/{number}"):
        number += 1
    return number


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put ``text`` at ``path``: readers see the former file or this one, whole."""
    fs, where = _fs(spark, path)
    jvm = spark._jvm
    new = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(new, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(new), fs.makeQualified(where), options)


def _read_text(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def begin(spark: SparkSession, root: str) -> int:
    """Claim the version that a run writes."""
    return claim_number(spark, f"{root}/claims")


def version_path(root: str, version: int) -> str:
    return f"{root}/versions/{version:06d}"


def publish(spark: SparkSession, root: str, version: int) -> bool:
    """Make ``version`` the one that readers see; False if a newer one is published already."""
    now = current(spark, root)
    if now is not None and now > version:
        return False
    replace_text(spark, f"{root}/{POINTER}", str(version))
    return True


def current(spark: SparkSession, root: str) -> int | None:
    """The published version, None before the first one."""
    path = f"{root}/{POINTER}"
    return int(_read_text(spark, path)) if path_exists(spark, path) else None


def published_path(spark: SparkSession, root: str, layer: str, name: str) -> str:
    root = root.rstrip("/")
    version = current(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return f"{version_path(root, version)}/{layer}/{name}"


def read_published(spark: SparkSession, root: str, layer: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A table of the published version.  The version is looked up once: a later publication does not change the frame."""
    return spark.read.format(fmt).load(published_path(spark, root, layer, name))
