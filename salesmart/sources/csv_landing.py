"""CSV landing files: upload (write) and ingest (schema-on-read, with a channel for bad records).

Files are read by the names in their own header line, whatever the order of
their columns; columns that the table does not have are ignored.  Quotes
inside a quoted field are doubled, and a quoted field may hold line breaks, so
a file is one split (land files of a bounded size; ``multiline=False`` reads
larger ones in splits, if no field holds a line break).

A record with too few or too many fields is no row of the table: it goes to
``bad_records`` with its text.  A key or count that does not parse becomes NULL,
which the missing-value rule then removes; ``bad_records`` names it, too.
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LANDING
from .listing import list_files

CORRUPT = "_corrupt_record"
MALFORMED, UNPARSABLE = "malformed", "unparsable"


class LandingError(ValueError):
    """What is wrong with a landing file's header, as text."""


def land_csv(df: DataFrame, path: str) -> None:
    """Land a table as CSV files with a header (re-landing replaces them)."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def header_of(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names in the first line of a file; only that line is read."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine() or ""
    finally:
        stream.close()
    return tuple(next(csv.reader([line.lstrip("﻿")]), []))


def _raw(spark: SparkSession, files: list[str], table: str, multiline: bool) -> DataFrame:
    """The table's columns as text, the file and, of a malformed record, its text; one read per kind of header."""
    wanted = LANDING[table].fieldNames()
    kinds: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        kinds.setdefault(header_of(spark, file), []).append(file)
    parts = []
    for header, members in sorted(kinds.items()):
        place: dict[str, int] = {}
        for i, name in enumerate(header):
            place.setdefault(name.strip().lower(), i)
        lost = [c for c in wanted if c not in place]
        if lost:
            raise LandingError(f"{members[0]}: no column {', '.join(lost)} in the header {', '.join(header)}")
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))]
                              + [T.StructField(CORRUPT, T.StringType())])
        rows = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
                .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
                .option("multiLine", multiline).csv(members))
        # Spark refuses plans that need the corrupt record alone: the test of it names a field, too
        malformed = F.concat_ws("", CORRUPT, F.substring("c0", 1, 0)) != ""
        parts.append(rows.select(*(F.col(f"c{place[c]}").alias(c) for c in wanted), F.col(CORRUPT).alias("_record"),
                                 malformed.alias("_malformed"), F.col("_metadata.file_path").alias("_file")))
    if not parts:
        return spark.createDataFrame([], T.StructType(
            [T.StructField(c, T.BooleanType() if c == "_malformed" else T.StringType())
             for c in [*wanted, "_record", "_malformed", "_file"]]))
    return reduce(DataFrame.unionByName, parts)


def _read(spark: SparkSession, path: str | list[str], table: str, multiline: bool) -> DataFrame:
    files = list_files(spark, *([path] if isinstance(path, str) else path))
    return _raw(spark, [f.path for f in files if f.size], table, multiline)


def read_landing_csv(spark: SparkSession, path: str | list[str], table: str,
                     source_column: str | None = None, multiline: bool = True) -> DataFrame:
    """Landed CSV with the table's landing schema (no inference), malformed records left out.

    Empty fields become NULL; a key or count that does not parse becomes NULL
    too.  ``source_column`` adds the file that a row comes from.
    """
    rows = _read(spark, path, table, multiline).where(~F.col("_malformed"))
    source = [F.col("_file").alias(source_column)] if source_column else []
    return rows.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in LANDING[table].fields), *source)


def bad_records(spark: SparkSession, path: str | list[str], table: str, multiline: bool = True) -> DataFrame:
    """(table_name, source_file, reason, column_name, record): malformed records and fields that do not parse."""
    rows = _read(spark, path, table, multiline)
    name = F.lit(table).alias("table_name")
    malformed = rows.where("_malformed").select(
        name, F.col("_file").alias("source_file"), F.lit(MALFORMED).alias("reason"),
        F.lit(None).cast("string").alias("column_name"), F.col("_record").alias("record"))
    typed = [f for f in LANDING[table].fields if not isinstance(f.dataType, T.StringType)]
    lost = F.filter(F.array(*(F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
                              for f in typed)), lambda c: c.isNotNull())
    record = F.concat_ws(",", *LANDING[table].fieldNames())
    unparsable = (rows.where(~F.col("_malformed"))
                  .select(name, F.col("_file").alias("source_file"), F.lit(UNPARSABLE).alias("reason"),
                          F.explode(lost).alias("column_name"), record.alias("record")))
    return malformed.unionByName(unparsable)
