"""Folder checks and small state files through the Hadoop file system of the path."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def join(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *(p.strip("/") for p in parts)])


def _open(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _open(spark, path)
    return fs.exists(at)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, empty if there is no such folder."""
    fs, at = _open(spark, path)
    if not fs.exists(at):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(at))


def state(spark: SparkSession, path: str) -> tuple:
    """Name, bytes, number of files and time of each child of a folder: differs after a change."""
    fs, at = _open(spark, path)
    found = []
    for child in fs.listStatus(at):
        size = fs.getContentSummary(child.getPath())
        found.append((child.getPath().getName(), size.getLength(), size.getFileCount(),
                      child.getModificationTime()))
    return tuple(sorted(found))


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete exactly this folder; a folder whose name merely starts alike is not touched."""
    fs, at = _open(spark, path)
    if at.getParent() is None:
        raise ValueError(f"refusing to delete a file system root: {path}")
    return fs.delete(at, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, at = _open(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see the old or the new text, never a part."""
    fs, draft = _open(spark, f"{path}.next")
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        draft.toUri(), spark._jsc.hadoopConfiguration()
    )
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(draft, jvm.org.apache.hadoop.fs.Path(path), options)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless one is there; of several writers exactly one gets True.

    The text is complete before the name exists. Hadoop's rename without overwriting decides on the
    name node; a local rename would replace silently, but a hard link does not.
    """
    fs, draft = _open(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    try:
        if fs.getScheme() == "file":
            link, known = (
                jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath() for p in (target, draft)
            )
            jvm.java.nio.file.Files.createLink(link, known)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                draft.toUri(), spark._jsc.hadoopConfiguration()
            )
            rename = jvm.org.apache.hadoop.fs.Options.Rename
            options = spark.sparkContext._gateway.new_array(rename, 1)
            options[0] = rename.NONE
            context.rename(draft, target, options)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    finally:
        fs.delete(draft, False)
    return True
