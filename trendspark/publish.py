"""Atomic publication of whole tables: a folder for each version and a pointer that is swapped last.

A whole-table overwrite deletes first, so a job that fails leaves no table, and a reader can meet files of two runs. Here
a run writes ``<table>/_versions/<version>`` and only then replaces the small file ``<table>/_current`` that names it, by
one rename. A failed or killed run leaves the pointer, and so the table, as it was; its unfinished folder is removed by
the next publication. A reader resolves the pointer once, so all files of its frame are of one version, and the versions
before the current one are kept for readers that still use them.

Paths are any that Spark's file systems know; one writer at a time publishes a table.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from trendspark.sinks import write_table

POINTER, VERSIONS = "_current", "_versions"
#: Versions kept besides the current one.
KEPT = 1


class Store:
    """The few file operations of a table folder, on whatever file system holds it."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.fs = self.path().getFileSystem(self.conf)

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def read(self, name: str) -> str | None:
        path = self.path(name)
        if not self.fs.exists(path):
            return None
        stream = self.fs.open(path)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write a small file beside ``name`` and rename it over it."""
        beside = self.path(f"{name}.{uuid.uuid4().hex}")
        stream = self.fs.create(beside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        options = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
        options[0] = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        context.rename(beside, self.path(name), options)

    def folders(self, name: str) -> list[str]:
        path = self.path(name) if name else self.path()
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def remove(self, *parts: str) -> None:
        self.fs.delete(self.path(*parts), True)


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version that readers see; None for a table that was never published."""
    return Store(spark, root).read(POINTER)


def publish(df: DataFrame, root: str, partition_cols=(), kept: int = KEPT) -> str:
    """Write ``df`` as the next version of the table at ``root`` and make it current; returns the version."""
    store = Store(df.sparkSession, root)
    version = datetime.now(UTC).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]
    write_table(df, f"{store.root}/{VERSIONS}/{version}", partition_cols, whole=True)
    before = store.read(POINTER)
    store.replace(POINTER, version)
    # unfinished folders of failed runs, and finished ones beyond those kept
    published = [v for v in (store.read("_published") or "").split() if v] + ([before] if before else [])
    published = list(dict.fromkeys(published))[-kept:] if kept else []
    store.replace("_published", "\n".join(published))
    for folder in store.folders(VERSIONS):
        if folder != version and folder not in published:
            store.remove(VERSIONS, folder)
    return version


def read_table(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The current (or a kept) version of a published table; a folder that was never published is read as it is."""
    version = version or current_version(spark, root)
    return spark.read.parquet(f"{root.rstrip('/')}/{VERSIONS}/{version}" if version else root)
