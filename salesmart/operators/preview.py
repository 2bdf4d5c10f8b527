"""Table and file previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import PREVIEWABLE

# Rows shown by the table preview and the file preview.
TABLE_PREVIEW_ROWS = 5
FILE_PREVIEW_LINES = 20


def check_table(name: str) -> str:
    if name not in PREVIEWABLE:
        raise ValueError("Invalid table name")
    return name


def preview_table(df: DataFrame, order_by: str | list[str] | None,
                  n: int = TABLE_PREVIEW_ROWS) -> DataFrame:
    """First ``n`` rows by ``order_by`` (a TakeOrderedAndProject: per-task
    top-n, then a merge of n rows per task -- no full sort, but every
    partition is read).  ``order_by=None`` is the original's "any n rows":
    a plain limit that reads only as many partitions as it needs."""
    if order_by is None:
        return df.limit(n)
    return df.orderBy(order_by).limit(n)


def preview_lines(spark: SparkSession, path: str, n: int = FILE_PREVIEW_LINES) -> DataFrame:
    """First ``n`` raw lines of one text/CSV file (line 1 is the header).

    Only the head of the file is read: a bounded ``head`` of n lines goes
    through its splits in order and stops.
    """
    lines = [(i, r["value"]) for i, r in enumerate(spark.read.text(path).head(n), 1)]
    return spark.createDataFrame(lines, "line_no long, line string")


def numbered_lines(spark: SparkSession, path: str, skip_header: bool = False, stage=None) -> DataFrame:
    """(line_no, line) of all lines of a file, or of a folder's files in the order of their names.

    Every split counts its lines; a running sum over the counts, one row per
    split, tells where each split's numbers begin, and within a split lines
    are numbered as they are read.  So nothing is sorted and no task sees more
    than a split.  ``skip_header`` leaves out the first line of each file.
    ``stage`` (see ``plans.stage.Stager.stage``) stores the counts, so that they
    are broadcast only if they fit.
    """
    block = ["_file", "_start"]
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"))
    # the rows of a split are neighbours in one partition, so their ids have no gaps
    counts = lines.groupBy(*block).agg(F.count(F.lit(1)).alias("_lines"), F.min("_id").alias("_first"))
    head = F.when((F.col("_start") == 0) & F.lit(skip_header), 1).otherwise(0)
    in_file = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    files = counts.groupBy("_file").agg(F.sum(F.col("_lines") - head).alias("_in_file"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = files.select(F.col("_file").alias("_of"), F.coalesce(F.sum("_in_file").over(earlier), F.lit(0)).alias("_files_before"))
    begins = (counts.withColumn("_head", head)
              .withColumn("_before", F.coalesce(F.sum(F.col("_lines") - F.col("_head")).over(in_file), F.lit(0)))
              .join(files, F.col("_file") == F.col("_of"))
              .select(*block, "_first", "_head", (F.col("_before") + F.col("_files_before") - F.col("_head")).alias("_offset")))
    begins = stage(begins, "line_counts") if stage is not None else begins
    numbered = lines.join(begins, block).where(F.col("_id") - F.col("_first") >= F.col("_head"))
    return numbered.select((F.col("_offset") + F.col("_id") - F.col("_first") + 1).alias("line_no"), "line")
