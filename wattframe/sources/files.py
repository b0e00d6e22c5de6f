"""Folders of any store that Spark reaches, moved and removed from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(context._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _located(spark, path)
    return store.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """What is in a folder; nothing if there is none."""
    store, where = _located(spark, path)
    return [f.getPath().getName() for f in store.listStatus(where)] if store.exists(where) else []


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of all files below a folder: another one means other content. Empty
    without the folder. For tables of few files."""
    store, where = _located(spark, path)
    found, each = [], store.listFiles(where, True) if store.exists(where) else None
    while each is not None and each.hasNext():
        f = each.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, if there is one."""
    store, where = _located(spark, path)
    store.delete(where, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``; no file is opened."""
    store, where = _located(spark, path)
    return store.getContentSummary(where).getLength()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder. ``target`` must not exist."""
    store, where = _located(spark, source)
    _, to = _located(spark, target)
    if store.exists(to):
        raise FileExistsError(target)
    store.mkdirs(to.getParent())
    if not store.rename(where, to):
        raise OSError(f"{source} could not be moved to {target}")


def switch(spark: SparkSession, fresh: str, path: str, aside: str) -> None:
    """Put the complete folder ``fresh`` in the place of ``path``.

    The old folder stands at ``aside`` in between. If this is broken off there, ``path`` is
    missing and ``aside`` is whole: :func:`mend` puts it back.
    """
    remove(spark, aside)
    if exists(spark, path):
        move(spark, path, aside)
    move(spark, fresh, path)
    remove(spark, aside)


def mend(spark: SparkSession, path: str, aside: str) -> None:
    """Undo a switch that was broken off."""
    if not exists(spark, path) and exists(spark, aside):
        move(spark, aside, path)
