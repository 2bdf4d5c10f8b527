"""Listing of input files: path, modification time and size, from the file system's names alone."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import SparkSession


class File(NamedTuple):
    path: str            # as readers take it
    uri: str             # as ``_metadata.file_path`` names it
    modified_ms: int
    size: int


def list_files(spark: SparkSession, *paths: str) -> list[File]:
    """Files at some paths (files, folders, patterns), hidden ones left out, sorted by path.

    One entry per file comes to the driver, as it does whenever Spark plans a scan.
    """
    jvm, conf, out = spark._jvm, spark._jsc.hadoopConfiguration(), []
    for each in paths:
        pattern = jvm.org.apache.hadoop.fs.Path(each)
        system = pattern.getFileSystem(conf)
        for status in system.globStatus(pattern) or []:
            found = system.listFiles(status.getPath(), True)
            while found.hasNext():
                file = found.next()
                if not file.getPath().getName().startswith(("_", ".")):
                    path = str(file.getPath())
                    uri = jvm.org.apache.hadoop.fs.Path(path).toUri().toString()
                    out.append(File(path, uri, file.getModificationTime(), file.getLen()))
    return sorted(out)


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """Digest of the names, times and sizes of all files at some paths.

    Two calls agree as long as no file was added, removed or written again.
    """
    seen = [(f.uri, f.modified_ms, f.size) for f in list_files(spark, *paths)]
    return hashlib.sha256(repr(seen).encode()).hexdigest()[:16]
