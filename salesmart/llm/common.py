"""Shared helpers: staged tables, files in the shared folder, shipped code.

Everything written between jobs goes under ``spark.checkpoint.dir``.  It is
read from the session; a folder of our own is chosen only when it is unset
and the master is local (tests).  Tables are staged as Parquet, so a lost
executor costs a re-read and never needs a cached or local copy.
"""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Python's and Java's regex for words: runs of anything but ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"

PACKAGE = Path(__file__).resolve().parents[1]


def shared_folder(spark: SparkSession) -> str:
    """URI of a fresh folder below ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    base = (context.getConf().get("spark.checkpoint.dir", None)
            or spark.conf.get("spark.checkpoint.dir", None)
            or context.getCheckpointDir())
    if not base:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/llm/{uuid.uuid4().hex[:16]}"


def stage(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    path = shared_folder(df.sparkSession)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now.

    It deletes them when the driver collects the garbage that refers to them,
    which a driver with a large heap may put off until the job's end.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors, once per application.

    Skipped when PYTHONPATH already names the repository (the workers inherit it).
    """
    context = spark.sparkContext
    if str(PACKAGE.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    if getattr(context, "_salesmart_shipped", False):
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='ship-')}/{PACKAGE.name}", "zip",
                                  PACKAGE.parent, PACKAGE.name)
    context.addPyFile(archive)
    context._salesmart_shipped = True


def tidy(run):
    """``run``, a function of a task's batches, that gives what it freed back to the system at its end.

    Its worker waits for the next task, beside others: what the allocators of Python and Arrow
    keep for later would add up in all of them.
    """
    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)

    return whole


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(df: DataFrame, name: str) -> Column:
    """Column by exact name, dots and blanks included."""
    return df[f"`{name.replace('`', '``')}`"]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def open_folder(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


class SharedFile:
    """A file written in the shared folder: visible under its name only when whole.

    A retried or speculative task writes under its own temporary name and
    moves it over the first result, which has the same bytes.
    """

    def __init__(self, folder: str, name: str):
        self.fs, base = open_folder(folder)
        self.fs.create_dir(base, recursive=True)
        self.path = f"{base}/{name}"
        self.part = f"{base}/.{name}.{uuid.uuid4().hex[:8]}"

    def __enter__(self):
        self.stream = self.fs.open_output_stream(self.part, compression=None)
        return self.stream

    def __exit__(self, kind, value, trace):
        self.stream.close()
        if kind is None:
            self.fs.move(self.part, self.path)
        else:
            self.fs.delete_file(self.part)


def pieces(batch: pa.RecordBatch, place: int, size: int = 1 << 22):
    """Parts of ``batch`` whose values in one column hold about ``size`` bytes, one row at least.

    So no more than a part is turned into Python values at a time.
    """
    ends = np.cumsum(pc.binary_length(batch.column(place)).fill_null(0).to_numpy().astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        done = int(ends[begin - 1]) if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(begin, stop - begin)
        begin = stop


def slices(texts: list[str], size: int = 1 << 22):
    """Index ranges of ``texts`` of about ``size`` characters, one text at least."""
    begin = total = 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= size:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)
