"""Table writes: append, full refresh, CSV export."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BASE_TABLES, METRICS, typed


def append(df: DataFrame, path: str) -> None:
    """``INSERT INTO`` semantics: running twice stores every row twice (``append_load`` does not)."""
    df.write.mode("append").parquet(path)


LOAD = "load_id"


def _ledger(path: str) -> str:
    return f"{path.rstrip('/')}_loads"


def committed_loads(spark: SparkSession, path: str) -> list[str]:
    """Loads of an appended table that are complete."""
    ledger = spark._jvm.org.apache.hadoop.fs.Path(_ledger(path))
    if not ledger.getFileSystem(spark._jsc.hadoopConfiguration()).exists(ledger):
        return []
    rows = spark.read.schema(f"{LOAD} string, at timestamp").parquet(_ledger(path))
    return [r[LOAD] for r in rows.select(LOAD).distinct().collect()]


def append_load(df: DataFrame, path: str, load_id: str) -> bool:
    """Append ``df`` once under the name ``load_id``; False if that load is there already.

    The rows of a load are one partition of the table, which a retry after a
    failure overwrites, and the ledger names the loads that are complete, so
    an append that is run again never doubles rows.  A second append that is
    meant takes another name.
    """
    spark = df.sparkSession
    if load_id in committed_loads(spark, path):
        return False
    (df.withColumn(LOAD, F.lit(load_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(LOAD).parquet(path))
    (spark.createDataFrame([(load_id,)], f"{LOAD} string").withColumn("at", F.current_timestamp())
     .write.mode("append").parquet(_ledger(path)))
    return True


def read_loads(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all complete loads of an appended table."""
    loads = committed_loads(spark, path)
    if not loads:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])).parquet(path)
    return rows.where(F.col(LOAD).isin(loads)).drop(LOAD)


def refresh(df: DataFrame, path: str, partition_by: str | None = None,
            only: list[str] | None = None) -> None:
    """Truncate-or-create then insert: running twice equals running once.

    A partitioned refresh replaces the whole table as well.  With ``only``,
    a list of values of ``partition_by``, just these partitions are
    replaced, and those that ``df`` has no rows for are removed.
    Never point ``path`` at a table that ``df`` itself reads.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    seen = Observation()
    w = df.observe(seen, F.collect_set(partition_by).alias("parts")).write.mode("overwrite")
    w = w.option("partitionOverwriteMode", "static" if only is None else "dynamic")
    w.partitionBy(partition_by).parquet(path)
    for gone in set(only or ()) - set(seen.get.get("parts") or ()):
        _delete(df.sparkSession, os.path.join(path, f"{partition_by}={gone}"))


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header row and no index column: quotes are doubled, blanks kept.

    One file per task by default; ``single_file`` funnels the result through
    one task and is meant for small, already-aggregated results only.
    """
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def create_empty_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Typed, empty Parquet tables for the base and metric tables.

    Creation order: dimensions, metric tables, then the fact (the fact's
    keys refer to the dimensions).  Returns table -> path.
    """
    order = [t for t in BASE_TABLES if t != "transactions"] + list(METRICS) + ["transactions"]
    paths = {}
    for t in order:
        schema = METRICS[t] if t in METRICS else typed(t)
        paths[t] = os.path.join(root, t)
        spark.createDataFrame([], schema).write.mode("ignore").parquet(paths[t])
    return paths
