"""Incremental ingest of landed CSV files.

``ingest_available`` appends files that a Structured Streaming file source has
not seen yet; it suits folders in which a file never changes.

``ingest_changed`` is for folders in which a file may be landed again under its
old name, which must replace its old rows.  A file stream knows files by
name only, so this job compares the folder's listing (name, time, size) with
the ledger of what was taken, and reads just the files that are new or
different.  The landed table has one partition per source file; writing
a file's rows replaces its partition (dynamic overwrite), so old rows vanish
and a run that failed half-way can simply be run again.  The ledger is
written last.

Cleansing is *not* done per file: the duplicate rule removes every copy of a
key, so a later file can retract a row that was fine before.  It runs over the
landed table (``Warehouse``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LANDING
from ..sinks.tables import _delete
from ..sources.csv_landing import read_landing_csv
from ..sources.listing import list_files

LEDGER = "source_file string, modified_ms long, source_size long, taken_at timestamp"
#: Size in the ledger of a file that is gone.
GONE = -1
#: Files taken together in one run of ``ingest_changed``; more are taken in rounds.
FILES_PER_ROUND = 1000


def ingest_available(spark: SparkSession, source_dir: str, table: str, sink_path: str,
                     checkpoint: str, max_files_per_trigger: int | None = None) -> int:
    """Append all not-yet-seen CSV files of ``table``; returns batches run."""
    reader = (spark.readStream.schema(LANDING[table]).option("header", True)
              .option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(source_dir)
    q = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(sink_path))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return len(q.recentProgress)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def ledger_path(sink_path: str) -> str:
    return f"{sink_path.rstrip('/')}_ledger"


def taken_files(spark: SparkSession, sink_path: str) -> dict[str, tuple[int, int]]:
    """Source file -> (time, size) of the version whose rows the landed table holds."""
    path = ledger_path(sink_path)
    if not _exists(spark, path):
        return {}
    rows = spark.read.schema(LEDGER).parquet(path)
    newest = rows.groupBy("source_file").agg(F.max_by(F.struct("modified_ms", "source_size"), "taken_at").alias("v"))
    return {r["source_file"]: tuple(r["v"]) for r in newest.collect() if r["v"]["source_size"] != GONE}


def ingest_changed(spark: SparkSession, source_dir: str, table: str, sink_path: str,
                   files_per_round: int = FILES_PER_ROUND, drop_removed: bool = False) -> int:
    """Take new and replaced files of ``source_dir`` into the landed table; returns how many.

    With ``drop_removed`` the rows of files that are gone from the folder go, too.
    """
    listed, known = list_files(spark, source_dir), taken_files(spark, sink_path)
    changed = [f for f in listed if known.get(f.uri) != (f.modified_ms, f.size)]
    for begin in range(0, len(changed), files_per_round):
        part = changed[begin:begin + files_per_round]
        held = {f.uri: list_files(spark, _partition(spark, sink_path, f.uri)) for f in part if f.uri in known}
        rows = read_landing_csv(spark, [f.path for f in part], table, source_column="source_file")
        # few files per partition; a large source file is split over several writers
        (rows.hint("rebalance", "source_file").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("source_file").parquet(sink_path))
        for uri, old in held.items():
            folder = _partition(spark, sink_path, uri)
            if set(old) & set(list_files(spark, folder)):  # the new version has no rows that would replace the old ones
                _delete(spark, folder)
        _record(spark, [(f.uri, f.modified_ms, f.size) for f in part], sink_path)
    gone = sorted(set(known) - {f.uri for f in listed}) if drop_removed else []
    for name in gone:
        _delete(spark, _partition(spark, sink_path, name))
    if gone:
        _record(spark, [(name, known[name][0], GONE) for name in gone], sink_path)
    return len(changed) + len(gone)


def _partition(spark: SparkSession, sink_path: str, name: str) -> str:
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return os.path.join(sink_path, f"source_file={utils.escapePathName(name)}")


def _record(spark: SparkSession, files: list[tuple[str, int, int]], sink_path: str) -> None:
    rows = spark.createDataFrame(files, "source_file string, modified_ms long, source_size long")
    rows.withColumn("taken_at", F.current_timestamp()).write.mode("append").parquet(ledger_path(sink_path))


def landed(spark: SparkSession, sink_path: str, table: str, with_source: bool = False) -> DataFrame:
    """The landed rows; a partition filter on ``source_file`` prunes files."""
    schema = T.StructType([*LANDING[table].fields, T.StructField("source_file", T.StringType())])
    if not _exists(spark, sink_path):
        return spark.createDataFrame([], schema if with_source else LANDING[table])
    rows = spark.read.schema(schema).parquet(sink_path)
    return rows if with_source else rows.drop("source_file")
