"""Paths on the cluster's file systems: commit markers and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_SCRATCH_SETTING = "spark.checkpoint.dir"


def exists(spark: SparkSession, uri: str) -> bool:
    file_system, path = _resolve(spark, uri)
    return file_system.exists(path)


def size_of(spark: SparkSession, uri: str) -> int:
    """Bytes of all files below ``uri``."""
    file_system, path = _resolve(spark, uri)
    return file_system.getContentSummary(path).getLength()


def children(spark: SparkSession, uri: str) -> list[str]:
    """Names directly below ``uri``; none if it does not exist."""
    file_system, path = _resolve(spark, uri)
    return [found.getPath().getName() for found in file_system.listStatus(path)] if file_system.exists(path) else []


def files_below(spark: SparkSession, uri: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change in ms) of every data file below ``uri``, by path; none if it does not exist.

    Hidden files, whose names begin with a dot or an underscore, are no data.
    """
    file_system, path = _resolve(spark, uri)
    if not file_system.exists(path):
        return []
    found, files = [], file_system.listFiles(path, True)
    while files.hasNext():
        status = files.next()
        if status.getPath().getName()[0] not in "._":
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


def changed_at(spark: SparkSession, uri: str) -> int:
    """Time of change of a file or folder, in ms."""
    file_system, path = _resolve(spark, uri)
    return file_system.getFileStatus(path).getModificationTime()


def make_folder(spark: SparkSession, uri: str) -> None:
    file_system, path = _resolve(spark, uri)
    file_system.mkdirs(path)


def mount(spark: SparkSession, uri: str) -> str:
    """A ``viewfs:`` name, for this application, for a folder that exists: the same files below another scheme."""
    file_system, path = _resolve(spark, uri)
    name = f"mount{uuid.uuid4().hex}"
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    settings.set(f"fs.viewfs.mounttable.{name}.link./data", file_system.makeQualified(path).toString())
    return f"viewfs://{name}/data"


def remove(spark: SparkSession, uri: str) -> None:
    """Delete a file or folder, if it is there."""
    file_system, path = _resolve(spark, uri)
    file_system.delete(path, True)


def read_text(spark: SparkSession, uri: str) -> str:
    """A small file."""
    file_system, path = _resolve(spark, uri)
    stream = file_system.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, uri: str, text: str) -> bool:
    """Write a small file that appears whole or not at all. False, and no change, if there is one already.

    The text goes to a file of another name first. Renaming it never replaces a
    file on the file systems that clusters use for this; a local rename would, so
    there the new name is made as a link, which never does.
    """
    file_system, path = _resolve(spark, uri)
    staged = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{uuid.uuid4().hex}")
    stream = file_system.create(staged, False)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    try:
        if file_system.getUri().getScheme() != "file":
            return not file_system.exists(path) and file_system.rename(staged, path)
        file = spark.sparkContext._jvm.java.io.File
        links = spark.sparkContext._jvm.java.nio.file.Files
        try:
            links.createLink(file(path.toUri().getPath()).toPath(), file(staged.toUri().getPath()).toPath())
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True
    finally:
        file_system.delete(staged, False)


def replace_text(spark: SparkSession, uri: str, text: str) -> None:
    """Write a small file, in place of one that is there."""
    file_system, path = _resolve(spark, uri)
    stream = file_system.create(path, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()


def committed(spark: SparkSession, uri: str) -> bool:
    """True if a Spark job finished writing ``uri``. A half-written folder has no marker."""
    return exists(spark, f"{uri.rstrip('/')}/_SUCCESS")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the application ends.

    The folder is the one named by ``spark.checkpoint.dir``. Only a local
    session, where driver and tasks share a disk, may go without that setting.
    """
    base = spark.conf.get(_SCRATCH_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SCRATCH_SETTING} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="spindlewatch-")
        spark.sparkContext.setCheckpointDir(base)
    uri = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    file_system, path = _resolve(spark, uri)
    file_system.deleteOnExit(path)
    return uri


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the scratch folder and read back, so that all its readers see the same partitions."""
    uri = scratch_folder(df.sparkSession, name)
    df.write.parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


def _resolve(spark: SparkSession, uri: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path
