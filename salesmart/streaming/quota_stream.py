"""Daily query quota over a stream of request logs that may come late.

A request is admitted iff it is among the first ``limit`` requests of its
client on its day, whatever the order in which the log arrives.  So the state
is what decides that: the ``limit`` first requests of every client-day
(``firsts``), stored as a table partitioned by day and by the micro-batch
that wrote it.  Each micro-batch (``foreachBatch``)

1. reads the newest stored version of the days it touches (partition pruned);
2. adds its own requests and keeps the ``limit`` first per client-day.  Spark
   plans ``row_number() <= limit`` as a *partial* ``WindowGroupLimit`` before
   the shuffle, so a client with a third of all requests brings ``limit`` rows
   per task, not its whole traffic;
3. answers its own requests by comparing them with the last admitted one, in
   an equi join of which AQE can split a hot client-day;
4. takes back the answers of earlier requests that a late one has pushed out.

Answers are a log: partition ``batch``, and ``revision`` true for an answer
taken back.  ``current_decisions`` gives the newest answer of each request.

A micro-batch that is run again after a failure reads versions older than its
own and overwrites exactly its own partitions, so the outcome is the same.
Versions that a later committed one replaced are deleted.  With
``keep_days`` the state of days that lie more than that many days before the
newest day is dropped; requests for such a closed day are refused (``late``).
"""

from __future__ import annotations

import os
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.quota import DAILY_LIMIT
from ..plans.stage import Stager
from ..session import configure
from ..sinks.tables import _delete

SOURCE = "client string, ts timestamp, request_id long"
FIRSTS = SOURCE + ", day date, batch long"
OUTPUT = "client string, request_id long, ts timestamp, day date, admitted boolean"
#: Name of the partition of a null day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
DECISIONS = OUTPUT + ", revision boolean, late boolean, batch long"


def firsts_path(sink_path: str) -> str:
    return f"{sink_path.rstrip('/')}_firsts"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A partitioned table; empty if nothing was written yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _write(df: DataFrame, path: str, *parts: str) -> None:
    """Replaces the partitions that ``df`` has rows for, and no others."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))


def _versions(spark: SparkSession, path: str, before: int) -> dict[date | None, list[int]]:
    """Day -> batches before ``before`` that stored a version of it, from the names of the partitions."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "day=*", "batch=*"))
    found: dict[date | None, list[int]] = {}
    for status in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []:
        target = status.getPath()
        day, batch = target.getParent().getName()[len("day="):], int(target.getName()[len("batch="):])
        if batch < before:
            found.setdefault(None if day == NO_DAY else date.fromisoformat(day), []).append(batch)
    return {day: sorted(batches) for day, batches in found.items()}


def _version_filter(versions: dict[date, int]):
    chosen = F.lit(False)
    for day, batch in versions.items():
        chosen = chosen | (F.col("day").eqNullSafe(F.lit(day)) & (F.col("batch") == batch))
    return chosen


def decide(batch: DataFrame, batch_id: int, sink_path: str, limit: int = DAILY_LIMIT,
           keep_days: int | None = None) -> None:
    """One micro-batch: answers its requests and takes back what they push out."""
    spark = batch.sparkSession
    stager = Stager(spark, f"quota-{batch_id}")
    requests = stager.put(batch.select("client", "ts", "request_id", F.to_date("ts").alias("day")), "requests")
    touched = [r["day"] for r in requests.select("day").distinct().collect()]
    if not touched:
        return
    state = firsts_path(sink_path)
    stored = _read(spark, state, FIRSTS)
    versions = _versions(spark, state, batch_id)
    known = [d for d in [*versions, *touched] if d is not None]
    closed = max(known) - timedelta(days=keep_days) if keep_days is not None and known else None
    is_open = F.lit(True) if closed is None else F.coalesce(F.col("day") >= F.lit(closed), F.lit(True))

    prior = stored.where(_version_filter({d: v[-1] for d, v in versions.items() if d in touched})).select(
        "client", "ts", "request_id", "day")
    order = Window.partitionBy("client", "day").orderBy("ts", "request_id")
    ranked = (prior.unionByName(requests.where(is_open)).withColumn("_rn", F.row_number().over(order))
              .where(F.col("_rn") <= limit).drop("_rn"))
    firsts = stager.put(ranked, "firsts")
    cut = stager.stage(firsts.groupBy("client", "day").agg(F.max(F.struct("ts", "request_id")).alias("_cut"))
                       .select(F.col("client").alias("_client"), F.col("day").alias("_day"), "_cut"), "cutoffs")
    same = F.col("client").eqNullSafe(F.col("_client")) & F.col("day").eqNullSafe(F.col("_day"))
    request = F.struct("ts", "request_id")

    answers = requests.join(cut, same, "left").select(
        "client", "request_id", "ts", "day",
        F.coalesce((request <= F.col("_cut")) & is_open, F.lit(False)).alias("admitted"),
        F.lit(False).alias("revision"), (~is_open).alias("late"))
    taken_back = prior.join(cut, same).where(request > F.col("_cut")).select(
        "client", "request_id", "ts", "day", F.lit(False).alias("admitted"),
        F.lit(True).alias("revision"), F.lit(False).alias("late"))
    number = F.lit(batch_id).cast("long").alias("batch")
    _write(answers.unionByName(taken_back).select("*", number), sink_path, "batch")
    # few files per day, and a day with many clients is split over several writers
    _write(firsts.select("*", number).hint("rebalance", "day"), state, "day", "batch")

    for day, batches in versions.items():
        folder = os.path.join(state, f"day={NO_DAY if day is None else day}")
        if closed is not None and day is not None and day < closed:
            _delete(spark, folder)
            continue
        for old in batches[:-1]:  # a retry of this batch reads the newest version before it
            _delete(spark, os.path.join(folder, f"batch={old}"))


def current_decisions(spark: SparkSession, sink_path: str) -> DataFrame:
    """The newest answer of every request (``OUTPUT``); an answer taken back beats the one it revises."""
    rows = _read(spark, sink_path, DECISIONS)
    newest = F.max_by(F.col("admitted"), F.struct("batch", "revision")).alias("admitted")
    return rows.groupBy("client", "request_id", "ts", "day").agg(newest)


def run_quota_stream(spark: SparkSession, source_dir: str, sink_path: str, checkpoint: str,
                     limit: int = DAILY_LIMIT, max_files_per_trigger: int | None = None,
                     keep_days: int | None = None) -> None:
    """Process all request-log files not yet seen (availableNow)."""
    session = configure(spark.newSession())
    for name in ("spark.sql.shuffle.partitions",):
        session.conf.set(name, spark.conf.get(name))
    reader = session.readStream.schema(SOURCE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (reader.parquet(source_dir).writeStream
             .foreachBatch(lambda df, n: decide(df, n, sink_path, limit, keep_days))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
