"""The cleanse -> metrics -> roll-up pipeline over one input folder.

``Warehouse`` is the unit a user works with: it lands the base tables,
cleanses the four dimensions, then the fact against them, computes the
monthly metric tables and derives the roll-ups.  Each stored table
(landed fact, cleansed tables, monthly metrics) is written once as Parquet
under the shared checkpoint folder and re-read, so

* the four metrics and the reports reuse one cleansed fact instead of
  re-running the cleansing per query;
* a lost executor costs at most a re-read of a stored table;
* every broadcast decision rests on a measured row count.

Warehouses are memoised per (application, input folder, options) until a
file of the input folder changes.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.distinct_state import exact_rollup, merge_partitions, monthly_bitmaps, monthly_sketches
from ..operators.metrics import SPECS, monthly_metric
from ..operators.rollups import ROLLUPS, rollup
from ..schemas import DIMENSIONS, KEYS
from ..session import scale_partitions
from ..sinks.tables import append_load, refresh
from ..sources import csv_landing, testdata
from ..sources.listing import fingerprint, list_files
from .stage import Stager

MONTH_COLUMN = "month_year"

_CACHE: dict[tuple, tuple[str, "Warehouse"]] = {}


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, faults: str = "fact",
                 materialize: bool = True, strategy: str = "eager",
                 landing: dict[str, DataFrame] | None = None, malformed: DataFrame | None = None,
                 partition_fact: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.faults = faults
        self.strategy = strategy
        tag = f"wh-{faults}-{strategy}"
        self.stager = Stager(spark, tag, enabled=materialize)
        self._landing_override = landing
        self._malformed = malformed
        self.partition_fact = partition_fact
        self._tables: dict[str, DataFrame] = {}

    def _concurrently(self, fns) -> None:
        """Run independent table builds as concurrent Spark jobs.

        Jobs with few tasks (small dimensions, one metric) then share the
        executors instead of queueing; the scheduler interleaves their tasks.
        """
        fns = list(fns)
        if len(fns) <= 1 or not self.stager.enabled:
            for f in fns:
                f()
            return
        with ThreadPoolExecutor(max_workers=len(fns)) as pool:
            for fut in [pool.submit(f) for f in fns]:
                fut.result()

    # ------------------------------------------------------------------ input
    def landing(self, table: str) -> DataFrame:
        """Landing-layer table (the fact is landed once as Parquet)."""
        key = f"landing_{table}"
        if key not in self._tables:
            if self._landing_override is not None:
                df = self._landing_override[table]
            else:
                df = testdata.landing_table(self.spark, self.sf_dir, table, self.faults)
            if table == "transactions":
                # scanned several times by the cleansing: land it once
                df = self.stager.put(df, key)
            self._tables[key] = df
        return self._tables[key]

    # --------------------------------------------------------------- cleanse
    def clean(self, table: str) -> DataFrame:
        key = f"clean_{table}"
        if key not in self._tables:
            if table in DIMENSIONS:
                # the (usually tiny) duplicate-key set is staged: broadcast
                # when it fits, so the dimension itself is never shuffled
                df = quality.cleanse_dimension(self.landing(table), table,
                                               self._named_stage(table))
            else:
                df = quality.cleanse_transactions(self.landing("transactions"), self._dimensions(),
                                                  self.stager.stage, self.marks())
                if self.partition_fact:
                    self._tables["fact_by_month"] = self._put_by_month(df)
                    self._tables[key] = self._tables["fact_by_month"].drop(MONTH_COLUMN)
                    return self._tables[key]
            # dimensions are stored bucketed on their (now unique) key
            bucket = KEYS[table] if table in DIMENSIONS else None
            self._tables[key] = self.stager.put(df, key, bucket_by=bucket)
        return self._tables[key]

    def _dimensions(self) -> dict[str, DataFrame]:
        # the landed fact and the four cleansed dimensions are independent
        self._concurrently([lambda: self.landing("transactions")] +
                           [lambda d=d: self.clean(d) for d in DIMENSIONS])
        return {d: self.clean(d) for d in DIMENSIONS}

    def marks(self) -> DataFrame:
        """Stored classification of the fact: what is wrong with which row."""
        if "marks" not in self._tables:
            dims = self._dimensions()
            self._tables["marks"] = quality.rejected_marks(self.landing("transactions"), dims, self.stager.stage,
                                                           self.stager.fits_lookup)
        return self._tables["marks"]

    def orphans(self) -> DataFrame:
        """(transaction_id, dimension, key_value) of references that fail, from the marks."""
        return quality.referential_orphans(None, None, self._named_stage("orphans"), self.marks())

    def rejects(self) -> DataFrame:
        """Stored rejects report of all five tables: (table_name, key_value, reason)."""
        if "rejects" not in self._tables:
            marks = self.marks()
            tables = DIMENSIONS + ("transactions",)
            built: dict[str, DataFrame] = {}

            def build(t: str) -> None:
                # each table stages its own small sets; the five are independent
                r = quality.reject_reasons(self.landing(t), t, None, self._named_stage(f"rejects_{t}"),
                                           marks if t == "transactions" else None)
                built[t] = r.select("table_name", F.col(r.columns[1]).alias("key_value"),
                                    "reason")

            self._concurrently([lambda t=t: build(t) for t in tables])
            parts = [built[t] for t in tables]
            if self._malformed is not None:
                parts.append(self._malformed.select("table_name", F.lit(None).cast("long").alias("key_value"), "reason"))
            out = parts[0]
            for p in parts[1:]:
                out = out.unionByName(p)
            self._tables["rejects"] = self.stager.put(out, "rejects")
        return self._tables["rejects"]

    def _named_stage(self, prefix: str):
        return lambda df, name: self.stager.stage(df, f"{prefix}_{name}")

    def dimension_side(self, table: str) -> DataFrame:
        """Cleansed dimension as a join build side (broadcast iff it fits)."""
        return self.stager.side(self.clean(table), f"clean_{table}")

    def cleansed(self) -> dict[str, DataFrame]:
        return {t: self.clean(t) for t in DIMENSIONS + ("transactions",)}

    # --------------------------------------------------------------- metrics
    def monthly(self, name: str) -> DataFrame:
        if name not in self._tables:
            # the monthly metrics job builds all four tables at once
            self.clean("transactions")
            self._concurrently([lambda n=n: self._monthly(n) for n in SPECS])
        return self._tables[name]

    def _monthly(self, name: str) -> DataFrame:
        if name not in self._tables:
            spec = SPECS[name]
            df = monthly_metric(self.clean("transactions"), self.dimension_side(spec.dimension),
                                spec, self.strategy)
            self._tables[name] = self.stager.put(df, name)
        return self._tables[name]

    def distinct_state(self, name: str, kind: str = "bitmaps") -> DataFrame:
        """Stored mergeable monthly state of a metric's distinct measure (``bitmaps`` or ``sketches``)."""
        key = f"{name}_{kind}"
        if key not in self._tables:
            make = {"bitmaps": monthly_bitmaps, "sketches": monthly_sketches}[kind]
            self._tables[key] = self.stager.put(make(self.clean("transactions"), name), key)
        return self._tables[key]

    def exact_rollup(self, entity: str, period: str) -> DataFrame:
        """Roll-up with true distinct counts, merged from stored monthly state."""
        source = ROLLUPS[entity].source
        return exact_rollup(self.monthly(source), self.distinct_state(source), entity, period, self.state_partitions(source))

    def state_partitions(self, name: str) -> int | None:
        """Partitions that merging a metric's bitmaps takes, by their counted number."""
        key = f"{name}_bitmaps"
        return merge_partitions(self.stager.staged[key].rows) if key in self.stager.staged else None

    def fact_by_month(self) -> DataFrame:
        """The cleansed fact, stored with one partition per month (column ``month_year``)."""
        if "fact_by_month" not in self._tables:
            fact = self.clean("transactions")
            if "fact_by_month" not in self._tables:  # clean() has stored it when partition_fact is set
                self._tables["fact_by_month"] = self._put_by_month(fact)
        return self._tables["fact_by_month"]

    def _put_by_month(self, fact: DataFrame) -> DataFrame:
        month = fact.withColumn(MONTH_COLUMN, F.date_format("timestamp", "yyyy-MM"))
        return self.stager.put(month, "fact_by_month", partition_by=MONTH_COLUMN)

    def publish(self, root: str, months: list[str] | None = None,
                names: tuple[str, ...] = tuple(SPECS), load_id: str | None = None) -> dict[str, str]:
        """Write the monthly tables under ``root/<name>``, partitioned by month.

        With ``months`` only those months are recomputed, from their partitions
        of the cleansed fact, and only their partitions are replaced, so
        re-running a month never double-counts it; a month that has become
        empty loses its partition.  Without ``months`` the whole table is
        replaced: months that are gone from the data are gone from it, too.

        With ``load_id`` the rows are appended instead, once under that name
        (``sinks.tables.append_load``); a retry changes nothing.
        """
        paths = {}
        for name in names:
            spec = SPECS[name]
            if months:
                fact = self.fact_by_month().where(F.col(MONTH_COLUMN).isin(months))
                df = monthly_metric(fact, self.dimension_side(spec.dimension), spec, self.strategy)
            else:
                df = self.monthly(name)
            paths[name] = os.path.join(root, name)
            if load_id:
                append_load(df, paths[name], load_id)
                continue
            # rebalance, not repartition: few files per month, and AQE splits
            # a month holding a large share of the rows over several writers
            refresh(df.hint("rebalance", "month_year"), paths[name], partition_by="month_year",
                    only=months or None)
        return paths

    def rollup(self, entity: str, period: str) -> DataFrame:
        return rollup(self.monthly(ROLLUPS[entity].source), entity, period)

    def table(self, name: str) -> DataFrame:
        """Scan a stored table by name; anything off the allow-list raises."""
        from ..operators.preview import check_table
        check_table(name)
        return self.monthly(name) if name in SPECS else self.clean(name)

    # ----------------------------------------------------------------- views
    def register_views(self) -> list[str]:
        """Temp views for ad-hoc SQL: cleansed tables, metrics, roll-ups."""
        names = []
        for t, df in self.cleansed().items():
            df.createOrReplaceTempView(t)
            names.append(t)
        for name in SPECS:
            self.monthly(name).createOrReplaceTempView(name)
            names.append(name)
        for entity in ROLLUPS:
            for period in ("quarterly", "yearly"):
                v = f"{period}_{entity}"
                self.rollup(entity, period).createOrReplaceTempView(v)
                names.append(v)
        return names


def from_csv(spark: SparkSession, folder: str, strategy: str = "eager", partition_fact: bool = False) -> Warehouse:
    """Warehouse over landed CSV files: ``<folder>/<table>/`` per base table
    (customers, employees, payments, products, transactions), header row.

    Records with too few or too many fields are in the rejects report as ``malformed``.
    """
    tables = DIMENSIONS + ("transactions",)
    bad = [csv_landing.bad_records(spark, os.path.join(folder, t), t) for t in tables]
    malformed = reduce(DataFrame.unionByName, bad).where(F.col("reason") == csv_landing.MALFORMED)
    landing = {t: csv_landing.read_landing_csv(spark, os.path.join(folder, t), t)
               for t in tables}
    return Warehouse(spark, folder, "csv", strategy=strategy, landing=landing, malformed=malformed,
                     partition_fact=partition_fact)


def warehouse(spark: SparkSession, sf_dir: str, faults: str = "fact",
              strategy: str = "eager", partition_fact: bool = False) -> Warehouse:
    """Memoised warehouse of ``sf_dir`` for this Spark application.

    A table that was landed again gives a new warehouse: the memo also
    holds the names, times and sizes of the files it was built from.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), faults, strategy, partition_fact)
    sources = [os.path.join(sf_dir, f"{t}.parquet") for t in testdata.SOURCES]
    state = fingerprint(spark, *sources)
    scale_partitions(spark, sum(f.size for f in list_files(spark, *sources)))
    built, wh = _CACHE.get(key, ("", None))
    if wh is None or built != state:
        wh = Warehouse(spark, sf_dir, faults, strategy=strategy, partition_fact=partition_fact)
        _CACHE[key] = state, wh
    return wh
