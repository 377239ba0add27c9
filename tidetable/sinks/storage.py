"""The few file-system calls the sinks need, on any Hadoop URI."""

from __future__ import annotations

import time as clock
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _conf(spark: SparkSession):
    return spark.sparkContext._jsc.hadoopConfiguration()


def _resolve(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(_conf(spark)), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have ``path``, which must exist, deleted when the driver ends in good order."""
    fs, target = _resolve(spark, path)
    fs.deleteOnExit(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none if it does not exist."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def changed_at(spark: SparkSession, path: str) -> float:
    """When something directly below ``path`` last came or went, in unix seconds."""
    fs, target = _resolve(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    fs, target = _resolve(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is no such file.

    A local file that is being replaced is gone for a moment, or at odds with its checksum, so it is
    looked for again.
    """
    fs, target = _resolve(spark, path)
    for turn in range(_TURNS):
        try:
            stream = fs.open(target)
            try:
                return bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
        except Py4JJavaError as error:
            kind = error.java_exception.getClass().getSimpleName()
            if kind not in ("FileNotFoundException", "ChecksumException"):
                raise
            if kind == "FileNotFoundException" and not fs.exists(target.getParent()):
                return None
        clock.sleep(0.02 * turn)
    return None


_TURNS = 4


def _write(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _resolve(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in the place of ``path``; readers meet the old one or the new one."""
    _renamed(spark, path, text, overwrite=True)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file complete with its text; False if there is one of that name already."""
    return _renamed(spark, path, text, overwrite=False)


def _renamed(spark: SparkSession, path: str, text: str, overwrite: bool) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE if overwrite else rename.NONE
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    _write(spark, draft, text)
    target = hadoop.Path(path)
    try:
        hadoop.FileContext.getFileContext(target.toUri(), _conf(spark)).rename(hadoop.Path(draft), target, options)
    except Py4JJavaError as error:
        delete_path(spark, draft)
        if not overwrite and "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True
