"""Materialisation points and size-checked broadcasts.

``Stager.put`` writes a DataFrame as Parquet under the shared checkpoint
folder and reads it back: lineage is cut (a lost executor costs a re-read,
not a recompute of the whole upstream plan) and the row count is known
exactly (observed during the write, so sizing costs no extra job).  ``Stager.side`` marks a build side for
broadcast only when that measured count times the schema's row width fits
under the session's broadcast threshold; otherwise the join stays a
shuffle join and AQE (skew split, coalescing) handles it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import conf_bytes, scratch_path, scratch_root

# Upper bound on the broadcast size when the session sets none.
DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024


def row_width(schema: T.StructType) -> int:
    """Conservative in-memory bytes per row (UnsafeRow: 8 per field + data)."""
    width = 8
    for f in schema.fields:
        t = f.dataType
        if isinstance(t, T.StringType):
            width += 8 + 32
        elif isinstance(t, T.DecimalType) and t.precision > 18:
            width += 8 + 16
        else:
            width += 8
    return width


def broadcast_limit(spark: SparkSession) -> int:
    """The session's ``autoBroadcastJoinThreshold`` in bytes (<= 0: never)."""
    return conf_bytes(spark, "spark.sql.autoBroadcastJoinThreshold", DEFAULT_BROADCAST_BYTES)


#: Parquet codec of staged tables: written once, read a few times.
CODEC = "zstd"
STAGE_DATABASE = "salesmart_stage"


def stage_database(spark: SparkSession) -> str:
    """Catalog database of the bucketed staged tables, located in the
    shared checkpoint folder (never the default warehouse directory)."""
    loc = scratch_root(spark) + "/catalog"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {STAGE_DATABASE} LOCATION '{loc}'")
    return STAGE_DATABASE


def _observed_rows(obs: Observation) -> int | None:
    """The count that came with the write; None if Spark found the table empty while planning and dropped it."""
    try:
        return obs.get.get("rows")
    except Py4JError:
        return None


@dataclass
class Staged:
    df: DataFrame
    path: str
    _rows: int | None = None

    @property
    def rows(self) -> int:
        """Row count (observed during the write; else read from the footers)."""
        if self._rows is None:
            self._rows = self.df.count()
        return self._rows


@dataclass
class Stager:
    spark: SparkSession
    prefix: str
    enabled: bool = True
    staged: dict[str, Staged] = field(default_factory=dict)

    def put(self, df: DataFrame, name: str, bucket_by: str | None = None,
            partition_by: str | None = None) -> DataFrame:
        """Write ``df`` once, return the re-read table (lazy when disabled).

        ``bucket_by`` stores the table hash-bucketed on that column (one file
        per bucket, ``spark.sql.shuffle.partitions`` buckets) as a catalog
        table at the staged path.  Only for *unique* keys (cleansed
        dimensions): a bucket can then never be skewed, and later joins and
        aggregations on the key read this side without a shuffle.
        ``partition_by`` stores one folder per value; the rebalance keeps the
        files few and splits a value with many rows over several writers.
        """
        if not self.enabled:
            return df
        path = scratch_path(self.spark, self.prefix, name, unique=True)
        # the row count is observed while writing: no second job to size it
        obs = Observation(f"stage_{name}_{path.rsplit('/', 1)[-1]}")
        counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        if bucket_by:
            n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            table = f"{stage_database(self.spark)}.{name}_{path.rsplit('/', 1)[-1]}"
            (counted.repartition(n, bucket_by).write.mode("overwrite").format("parquet").option("compression", CODEC)
             .bucketBy(n, bucket_by).sortBy(bucket_by).option("path", path)
             .saveAsTable(table))
            back = self.spark.table(table)
        elif partition_by:
            (counted.hint("rebalance", partition_by).write.mode("overwrite").option("compression", CODEC)
             .partitionBy(partition_by).parquet(path))
            back = self.spark.read.schema(df.schema).parquet(path)
        else:
            counted.write.mode("overwrite").option("compression", CODEC).parquet(path)
            back = self.spark.read.schema(df.schema).parquet(path)
        rows = _observed_rows(obs)
        self.staged[name] = Staged(back, path, rows)
        return back

    def fits_broadcast(self, name: str) -> bool:
        st = self.staged.get(name)
        if st is None:
            return False
        limit = broadcast_limit(self.spark)
        return limit > 0 and st.rows * row_width(st.df.schema) <= limit

    def fits_lookup(self, rows: int) -> bool:
        """Whether a set of that many long keys, as counted, may be broadcast.

        A counted size is held against AQE's threshold for measured sizes; a
        session that broadcasts nothing broadcasts no lookups either.
        """
        if broadcast_limit(self.spark) <= 0:
            return False
        limit = conf_bytes(self.spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", broadcast_limit(self.spark))
        return limit > 0 and rows * row_width(T.StructType([T.StructField("key", T.LongType())])) <= limit

    def side(self, df: DataFrame, name: str) -> DataFrame:
        """Build side of a join: broadcast iff the staged table ``name`` fits."""
        return F.broadcast(df) if self.fits_broadcast(name) else df

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """``quality`` stage hook: materialise, then size-check for broadcast."""
        return self.side(self.put(df, name), name)

    def rows(self, name: str) -> int | None:
        st = self.staged.get(name)
        return None if st is None else st.rows
