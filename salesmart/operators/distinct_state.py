"""Distinct customers of any period from stored monthly state, without the fact.

Monthly distinct counts cannot be added up.  What can be merged is kept beside
the monthly tables:

* **exact**: bitmaps.  A row holds, for one month and key, which customers of one
  bucket of 32,768 ids occurred; months are merged by OR and counted by bits.
  A bucket bounds the row (4 KiB in memory; sparse bitmaps compress to little on
  disk), so a key that sees a third of all customers is many rows, in many tasks.
* **sketch**: one HyperLogLog sketch per month and key, merged by union, for
  dashboards; the relative error is about 1.04 / sqrt(2 ** LG_K), 1.6%.

Refreshing a month rewrites that month's state only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .metrics import MONTH, SPECS, month_key
from .rollups import PERIODS, ROLLUPS, rollup

LG_K = 12
#: Relative error that five standard deviations of the sketch stay within.
SKETCH_ERROR = 5 * 1.04 / 2 ** (LG_K / 2)

#: Bitmaps of 4 KiB that one task merges: 64 MiB.
BITMAPS_PER_PARTITION = 16_384

#: Metric tables with a distinct measure: their key, the measure and the column that is counted.
MEASURES = {spec.name: (spec.key, m.name, m.column) for spec in SPECS.values()
            for m in spec.measures if m.kind == "count_distinct"}


def monthly_bitmaps(fact: DataFrame, metric: str) -> DataFrame:
    """(month_year, <key>, bucket, bits) of one metric's distinct measure."""
    key, _, member = MEASURES[metric]
    rows = fact.select(month_key().alias(MONTH), key, member).where(F.col(member).isNotNull())
    # different positions move, not bitmaps: a bucket's meet in one task, at most 32,768 of them
    places = rows.select(MONTH, key, F.bitmap_bucket_number(member).alias("bucket"),
                         F.bitmap_bit_position(member).alias("place")).distinct()
    return (places.repartition(MONTH, key, "bucket").groupBy(MONTH, key, "bucket")
            .agg(F.bitmap_construct_agg("place").alias("bits"))
            .select(F.date_format(MONTH, "yyyy-MM").alias("month_year"), key, "bucket", "bits"))


def monthly_sketches(fact: DataFrame, metric: str) -> DataFrame:
    """(month_year, <key>, sketch) of one metric's distinct measure."""
    key, _, member = MEASURES[metric]
    return (fact.select(month_key().alias(MONTH), key, member).groupBy(MONTH, key)
            .agg(F.hll_sketch_agg(member, LG_K).alias("sketch"))
            .select(F.date_format(MONTH, "yyyy-MM").alias("month_year"), key, "sketch"))


def merge_partitions(rows: int) -> int:
    """Partitions in which so many bitmaps are merged, each of bounded memory.

    Bitmaps are mostly zeros: shuffled bytes, which AQE goes by, tell little of
    what they take in a sort.
    """
    return -(-rows // BITMAPS_PER_PARTITION) or 1


def distinct_in_periods(bitmaps: DataFrame, metric: str, period: str, partitions: int | None = None) -> DataFrame:
    """(<label>, <key>, <measure>): exact distinct members per quarter or year."""
    key, name, _ = MEASURES[metric]
    label, fn = PERIODS[period]
    rows = bitmaps.select(fn("month_year").alias(label), key, "bucket", "bits")
    if partitions:
        rows = rows.repartition(partitions, label, key, "bucket")
    merged = (rows.groupBy(label, key, "bucket")
              .agg(F.bitmap_or_agg("bits").alias("bits")))
    return merged.groupBy(label, key).agg(F.sum(F.bitmap_count("bits")).cast("long").alias(name))


def estimated_in_periods(sketches: DataFrame, metric: str, period: str) -> DataFrame:
    """(<label>, <key>, <measure>): estimated distinct members per quarter or year."""
    key, name, _ = MEASURES[metric]
    label, fn = PERIODS[period]
    return (sketches.groupBy(fn("month_year").alias(label), key)
            .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).cast("long").alias(name)))


def exact_rollup(monthly: DataFrame, bitmaps: DataFrame, entity: str, period: str,
                 partitions: int | None = None) -> DataFrame:
    """The roll-up of an entity with true distinct counts, from stored monthly tables only."""
    spec = ROLLUPS[entity]
    key, name, _ = MEASURES[spec.source]
    label, _ = PERIODS[period]
    sums = rollup(monthly, entity, period)
    if name in sums.columns:
        sums = sums.drop(name)
    counted = distinct_in_periods(bitmaps, spec.source, period, partitions)
    # a key without any counted member has no bitmap
    joined = sums.join(counted, [label, key], "left")
    return joined.select(label, *spec.dims, F.coalesce(name, F.lit(0)).cast("long").alias(name),
                         *[c for c in spec.sums if c != name])
