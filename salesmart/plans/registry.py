"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables of ``sf_dir`` (or tables Spark
derived from them) in full.  Intermediate stored tables go to the shared
checkpoint folder.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checks import oracle
from ..functions.columns import client_key
from ..operators import kpi, preview, quality, quota, runs
from ..operators.distinct_state import SKETCH_ERROR, distinct_in_periods, estimated_in_periods
from ..operators.metrics import SPECS, average_columns, monthly_metric
from ..operators.rollups import ROLLUPS, exact_distinct_rollup
from ..schemas import DIMENSIONS, METRICS
from ..session import INPUT_PER_PARTITION, configure, scratch_path
from ..sinks import tables as sinks
from ..sources import csv_landing, testdata
from ..sources.listing import list_files
from ..streaming.ingest import ingest_available, ingest_changed, landed
from ..streaming.quota_stream import current_decisions, run_quota_stream
from .adhoc import run_sql
from .stage import Stager
from .warehouse import warehouse

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values used by the test-table mapping of the run log.
RUN_LOG_NOW = datetime(2024, 1, 15, 0, 0, 0)
RUN_LOG_PIPELINES = ["click", "error"]
QUOTA_TEST_LIMIT = 5
QUOTA_AS_OF = "2024-01-15"


def _wh(spark, sf_dir, faults="fact"):
    configure(spark)
    return warehouse(spark, sf_dir, faults)


# ------------------------------------------------------------------ metrics

def _monthly(name: str) -> Query:
    return lambda spark, sf: _wh(spark, sf).monthly(name)


def _rollup(entity: str, period: str) -> Query:
    return lambda spark, sf: _wh(spark, sf).rollup(entity, period)


def _monthly_join_first(spark, sf):
    """Literal join-then-aggregate shape; must equal the eager plan."""
    wh = _wh(spark, sf)
    return monthly_metric(wh.clean("transactions"), wh.clean("customers"),
                          "monthly_customer", strategy="join_first")


def _monthly_customer_avg(spark, sf):
    """Optional average money per transaction line, DECIMAL(18,2)."""
    return average_columns(_wh(spark, sf).monthly("monthly_customer"), "monthly_customer")


# ------------------------------------------------------------------ quality

def _dq(table: str, faults: str) -> Query:
    return lambda spark, sf: _wh(spark, sf, faults).clean(table)


def _dedupe_drop_all(spark, sf):
    configure(spark)
    li = testdata.read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return quality.drop_all_duplicates(li, ["l_orderkey", "l_linenumber"],
                                       Stager(spark, "dedupe").stage)


def _ref_orphans(spark, sf):
    return _wh(spark, sf, "all").orphans()


def _rejects(spark, sf):
    """Row-level rejects of all five tables: (table_name, key_value, reason)."""
    return _wh(spark, sf, "all").rejects()


def _reject_counts(spark, sf):
    return quality.reject_counts(_rejects(spark, sf))


# ------------------------------------------------------------------ kpis

def _employee_exact(period: str) -> Query:
    def q(spark, sf):
        wh = _wh(spark, sf)
        return exact_distinct_rollup(wh.clean("transactions"), wh.dimension_side("employees"),
                                     period)
    return q


def _exact_from_state(entity: str, period: str) -> Query:
    return lambda spark, sf: _wh(spark, sf).exact_rollup(entity, period)


def _sketch_within_error(spark, sf):
    """Exact customers per employee and year, and whether the sketches' estimate is within its error."""
    wh = _wh(spark, sf)
    bitmaps = wh.distinct_state("monthly_employee")
    exact = distinct_in_periods(bitmaps, "monthly_employee", "yearly", wh.state_partitions("monthly_employee"))
    rough = estimated_in_periods(wh.distinct_state("monthly_employee", "sketches"), "monthly_employee", "yearly")
    name = "unique_customers_serviced"
    joined = exact.join(rough.withColumnRenamed(name, "estimate"), ["year", "employee_id"], "left")
    error = F.abs(F.col("estimate") - F.col(name)) <= F.greatest(F.lit(1.0), F.col(name) * SKETCH_ERROR)
    return joined.select("year", "employee_id", name, F.coalesce(error, F.lit(False)).alias("within_error"))


def _kpi_period_totals(spark, sf):
    return kpi.period_totals(_wh(spark, sf).clean("transactions"))


def _kpi_first_seen(spark, sf):
    return kpi.first_seen_customers(_wh(spark, sf).clean("transactions"))


# ------------------------------------------------------------------ side datasets

def _quota_admission(spark, sf):
    configure(spark)
    return quota.admissions(testdata.request_log(spark, sf), QUOTA_TEST_LIMIT,
                            Stager(spark, "quota").stage)


def _quota_remaining(spark, sf):
    configure(spark)
    return quota.remaining(testdata.request_log(spark, sf), QUOTA_TEST_LIMIT)


def _quota_stream_of(spark, sf, chunks_of):
    """The request log lands in three chunks; the stream runs once per chunk
    (availableNow), carrying its state across runs."""
    configure(spark)
    log = testdata.request_log(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    base = scratch_path(spark, "quota_stream", unique=True)
    src, sink, ckpt = (os.path.join(base, p) for p in ("source", "sink", "checkpoint"))
    for chunk in chunks_of(log):
        chunk.write.mode("append").parquet(src)
        run_quota_stream(spark, src, sink, ckpt, QUOTA_TEST_LIMIT)
    return current_decisions(spark, sink).select(
        "client", "request_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "day", "admitted")


def _quota_stream(spark, sf):
    """Chunks in time order."""
    def by_time(log):
        bounds = log.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
        if bounds["lo"] is None:
            return [log]
        step = (bounds["hi"] - bounds["lo"]) / 3
        third = (F.when(F.col("ts") < F.lit(bounds["lo"] + step), 0)
                 .when(F.col("ts") < F.lit(bounds["lo"] + 2 * step), 1).otherwise(2))
        return [log.where(third == i) for i in range(3)]
    return _quota_stream_of(spark, sf, by_time)


def _quota_stream_late(spark, sf):
    """Chunks that each hold requests of all days, so most requests come late."""
    return _quota_stream_of(spark, sf, lambda log: [
        log.where(F.pmod(F.xxhash64("request_id"), F.lit(3)) == i) for i in range(3)])


def _quota_remaining_as_of(spark, sf):
    configure(spark)
    return quota.remaining_as_of(testdata.request_log(spark, sf), QUOTA_AS_OF,
                                 limit=QUOTA_TEST_LIMIT)


def _latest_run(spark, sf):
    configure(spark)
    return runs.latest_runs(testdata.run_log(spark, sf), RUN_LOG_NOW, RUN_LOG_PIPELINES)


def _client_key(spark, sf):
    configure(spark)
    h = testdata.client_headers(spark, sf)
    return h.select("request_id", "forwarded_for", "real_ip", "remote_addr",
                    client_key("forwarded_for", "real_ip", "remote_addr").alias("client_key"))


# ------------------------------------------------------------------ previews

def _preview_top5(spark, sf):
    preview.check_table("transactions")
    return preview.preview_table(_wh(spark, sf).clean("transactions"), "transaction_id")


def _preview_first_n(spark, sf):
    configure(spark)
    path = scratch_path(spark, "landing_csv", "products", unique=True)
    prods = testdata.landing_table(spark, sf, "products", "none")
    csv_landing.land_csv(prods.orderBy("product_id"), path)
    first = sorted(f for f in spark.read.text(path).inputFiles()
                   if os.path.basename(f).startswith("part-"))[0]
    return preview.preview_lines(spark, first, preview.FILE_PREVIEW_LINES)


def _adhoc(name: str) -> Query:
    def q(spark, sf):
        return run_sql(_wh(spark, sf), oracle.ADHOC[name])
    return q


# ------------------------------------------------------------------ sinks / sources

def _append_twice(spark, sf):
    df = _wh(spark, sf).monthly("monthly_customer")
    path = scratch_path(spark, "sink", "append", unique=True)
    sinks.append(df, path)
    sinks.append(df, path)
    return spark.read.schema(METRICS["monthly_customer"]).parquet(path)


def _append_loads(*loads: str) -> Query:
    """Appends under names; a name that comes again is a retry."""
    def q(spark, sf):
        df = _wh(spark, sf).monthly("monthly_customer")
        path = scratch_path(spark, "sink", "loads", unique=True)
        for load in loads:
            sinks.append_load(df, path, load)
        return sinks.read_loads(spark, path, METRICS["monthly_customer"])
    return q


def _all_lines(spark, sf):
    """Every product line of all landed files, numbered through, headers left out."""
    configure(spark)
    path = scratch_path(spark, "landing_csv", "lines", unique=True)
    csv_landing.land_csv(testdata.landing_table(spark, sf, "products", "none").orderBy("product_id"), path)
    return preview.numbered_lines(spark, path, skip_header=True, stage=Stager(spark, "lines").stage)


def _refresh_twice(spark, sf):
    df = _wh(spark, sf).monthly("monthly_customer")
    path = scratch_path(spark, "sink", "refresh", unique=True)
    sinks.refresh(df, path)
    sinks.refresh(df, path)
    return spark.read.schema(METRICS["monthly_customer"]).parquet(path)


def _month_refresh(spark, sf):
    """Publish all months, then recompute the first month in place."""
    wh = _wh(spark, sf)
    root = scratch_path(spark, "published", unique=True)
    wh.publish(root, names=("monthly_customer",))
    first = wh.monthly("monthly_customer").agg(F.min("month_year")).first()[0]
    wh.publish(root, months=[first] if first else None, names=("monthly_customer",))
    cols = METRICS["monthly_customer"].fieldNames()
    return spark.read.parquet(os.path.join(root, "monthly_customer")).select(*cols)


def _value_edges(spark, sf):
    """Which edge values of amounts and times the value rule lets through."""
    configure(spark)
    rows = testdata.value_edges(spark, sf)
    return rows.select("transaction_id", quality.invalid_values("transactions").alias("rejected"),
                       quality.invalid_values("products").alias("price_rejected"))


def _full_refresh_shrinks(spark, sf):
    """Publish all months, then the data without the last one: its partition is gone."""
    df = _wh(spark, sf).monthly("monthly_customer")
    path = scratch_path(spark, "sink", "shrink", unique=True)
    sinks.refresh(df, path, partition_by="month_year")
    last = df.agg(F.max("month_year")).first()[0]
    sinks.refresh(df.where(F.col("month_year") < last), path, partition_by="month_year")
    return spark.read.schema(METRICS["monthly_customer"]).parquet(path)


def _export_roundtrip(spark, sf):
    df = _wh(spark, sf).monthly("monthly_product")
    path = scratch_path(spark, "export", "monthly_product", unique=True)
    sinks.export_csv(df, path)
    return spark.read.schema(METRICS["monthly_product"]).option("header", True).csv(path)


def _ingest_csv_roundtrip(spark, sf):
    """Land the raw fact as CSV, ingest it with the landing schema, cleanse."""
    wh = _wh(spark, sf)
    path = scratch_path(spark, "landing_csv", "transactions", unique=True)
    csv_landing.land_csv(testdata.landing_table(spark, sf, "transactions", "fact"), path)
    fact = csv_landing.read_landing_csv(spark, path, "transactions")
    return _cleansed(spark, wh, fact, "ingest_csv")


def _ingest_stream(spark, sf):
    """CSV files picked up by a file stream (availableNow), then cleansed."""
    wh = _wh(spark, sf)
    base = scratch_path(spark, "ingest_stream", unique=True)
    src, sink, ckpt = (os.path.join(base, p) for p in ("source", "landed", "checkpoint"))
    land = testdata.landing_table(spark, sf, "transactions", "fact")
    # files of a bounded size, half of them per batch
    files = _stream_files(spark, sf)
    csv_landing.land_csv(land.repartition(files, "transaction_id"), src)
    ingest_available(spark, src, "transactions", sink, ckpt, max_files_per_trigger=-(-files // 2))
    return _cleansed(spark, wh, spark.read.parquet(sink), "ingest_stream")


def _stream_files(spark, sf) -> int:
    """CSV files that the raw fact lands in: four, or one per 4 MB of what it is made from."""
    sources = list_files(spark, *(os.path.join(sf, f"{t}.parquet") for t in ("lineitem", "orders")))
    return max(4, -(-sum(f.size for f in sources) // INPUT_PER_PARTITION))


def _cleansed(spark, wh, fact, prefix: str) -> DataFrame:
    """An ingested fact against the warehouse's dimensions; the small sets between are staged."""
    stager = Stager(spark, prefix)
    dims = {d: wh.dimension_side(d) for d in DIMENSIONS}
    return quality.cleanse_transactions(fact, dims, stager.stage, fits=stager.fits_lookup)


def _land_files(spark, rows, folder: str) -> None:
    """CSV files ``<file>.csv`` by the column ``file``, one task each; files of the same name are replaced."""
    part = f"{folder}_{uuid.uuid4().hex[:8]}"
    rows.repartition("file").write.partitionBy("file").option("header", True).csv(part)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for file in list_files(spark, part):
        source = jvm.org.apache.hadoop.fs.Path(file.path)
        target = jvm.org.apache.hadoop.fs.Path(folder, f"{source.getParent().getName()}.csv")
        jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, target.getFileSystem(conf), target, True, True, conf)


def _ingest_replaced(spark, sf):
    """Landed files, of which a quarter is landed again with fewer rows under the old names."""
    configure(spark)
    base = scratch_path(spark, "ingest_replaced", unique=True)
    src, sink = os.path.join(base, "source"), os.path.join(base, "landed")
    n = 4 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    land = testdata.landing_table(spark, sf, "transactions", "none").withColumn("file", F.pmod("transaction_id", F.lit(n)))
    _land_files(spark, land, src)
    ingest_changed(spark, src, "transactions", sink)
    _land_files(spark, land.where("transaction_id % 4 = 0 AND product_id % 2 = 0"), src)
    ingest_changed(spark, src, "transactions", sink)
    return landed(spark, sink, "transactions")


def _fresh_after_relanding(spark, sf):
    """A warehouse over a copy of the input, again after its line items were landed anew."""
    configure(spark)
    copy = scratch_path(spark, "relanded", unique=True)
    for t in testdata.SOURCES:
        spark.read.parquet(os.path.join(sf, f"{t}.parquet")).write.parquet(os.path.join(copy, f"{t}.parquet"))
    warehouse(spark, copy).monthly("monthly_payment").count()
    lines = spark.read.parquet(os.path.join(sf, "lineitem.parquet")).where(F.col("l_orderkey") % 2 == 0)
    lines.write.mode("overwrite").parquet(os.path.join(copy, "lineitem.parquet"))
    return warehouse(spark, copy).monthly("monthly_payment")


def _awkward_products(spark, sf):
    """Products whose names hold quotes, separators, line breaks and blanks."""
    p = testdata.read(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    kind, name = F.col("p_partkey") % 5, F.col("p_name")
    return p.select(F.col("p_partkey").alias("product_id"),
                    F.when(kind == 0, F.concat(name, F.lit(', "M8"'))).when(kind == 1, F.concat(name, F.lit("\nsecond line")))
                    .when(kind == 2, F.concat(F.lit('"'), name, F.lit('"'))).when(kind == 3, F.concat(F.lit("  "), name, F.lit(" ")))
                    .otherwise(name).alias("product_name"),
                    F.col("p_type").alias("product_category"),
                    F.col("p_retailprice").cast("decimal(10,2)").cast("string").alias("unit_price"))


def _land_awkward(spark, sf) -> str:
    """Two orders of columns, and files with records of three or five fields and keys that are no numbers."""
    base = scratch_path(spark, "landing_csv", "awkward", unique=True)
    rows = _awkward_products(spark, sf)
    csv_landing.land_csv(rows.where(F.col("product_id") % 2 == 0), os.path.join(base, "plain"))
    csv_landing.land_csv(rows.where(F.col("product_id") % 2 == 1)
                         .select("unit_price", F.lit("x").alias("note"), "product_name", "product_id", "product_category"),
                         os.path.join(base, "reordered"))
    key, kind = F.col("product_id").cast("string"), F.col("product_id") % 50
    line = (F.when(kind == 0, F.concat(key, F.lit(",short,c"))).when(kind == 1, F.concat(key, F.lit(",n,c,1.00,long")))
            .when(kind == 2, F.concat(F.lit("k"), key, F.lit(",n,c,1.00"))))
    head = spark.range(4).select(F.col("id").alias("b"), F.lit(0).alias("o"),
                                 F.lit("product_id,product_name,product_category,unit_price").alias("value"))
    body = rows.select((F.col("product_id") % 4).alias("b"), F.lit(1).alias("o"), line.alias("value")).where("value IS NOT NULL")
    # each of the four files is written by one task, its header first
    (head.unionByName(body).repartition("b").sortWithinPartitions("b", "o").select("b", "value")
     .write.partitionBy("b").text(os.path.join(base, "broken")))
    return base


def _csv_awkward(spark, sf):
    configure(spark)
    rows = csv_landing.read_landing_csv(spark, _land_awkward(spark, sf), "products")
    return rows.where("product_id IS NOT NULL")


def _csv_bad_records(spark, sf):
    configure(spark)
    bad = csv_landing.bad_records(spark, _land_awkward(spark, sf), "products")
    return bad.select("table_name", "reason", "column_name", "record")


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for name in SPECS:
        q[name] = _monthly(name)
    for period in ("quarterly", "yearly"):
        for entity in ROLLUPS:
            q[f"{period}_{entity}"] = _rollup(entity, period)
    q["monthly_customer_join_first"] = _monthly_join_first
    q["monthly_customer_avg"] = _monthly_customer_avg
    for t in DIMENSIONS:
        q[f"dq_{t}"] = _dq(t, "all")
    q["dq_transactions"] = _dq("transactions", "fact")
    q["dq_transactions_faulty_dims"] = _dq("transactions", "all")
    q["dedupe_drop_all"] = _dedupe_drop_all
    q["ref_orphans"] = _ref_orphans
    q["dq_rejects"] = _rejects
    q["dq_reject_counts"] = _reject_counts
    q["yearly_employee_exact"] = _employee_exact("yearly")
    q["quarterly_employee_exact"] = _employee_exact("quarterly")
    for entity in ("employee", "payment"):
        for period in ("quarterly", "yearly"):
            q[f"{period}_{entity}_from_state"] = _exact_from_state(entity, period)
    q["yearly_employee_sketch"] = _sketch_within_error
    q["kpi_period_totals"] = _kpi_period_totals
    q["kpi_first_seen_customers"] = _kpi_first_seen
    q["quota_admission"] = _quota_admission
    q["quota_remaining"] = _quota_remaining
    q["quota_stream"] = _quota_stream
    q["quota_stream_late"] = _quota_stream_late
    q["quota_remaining_as_of"] = _quota_remaining_as_of
    q["latest_run"] = _latest_run
    q["client_key"] = _client_key
    q["preview_top5"] = _preview_top5
    q["preview_first_n"] = _preview_first_n
    q["dq_value_edges"] = _value_edges
    q["metrics_full_refresh_shrinks"] = _full_refresh_shrinks
    for name in oracle.ADHOC:
        q[name] = _adhoc(name)
    q["metrics_append_twice"] = _append_twice
    q["metrics_append_retry"] = _append_loads("first", "first")
    q["metrics_append_loads"] = _append_loads("first", "first", "second", "second")
    q["preview_all_lines"] = _all_lines
    q["metrics_refresh_twice"] = _refresh_twice
    q["metrics_month_refresh"] = _month_refresh
    q["export_csv_roundtrip"] = _export_roundtrip
    q["ingest_csv_roundtrip"] = _ingest_csv_roundtrip
    q["ingest_stream_available_now"] = _ingest_stream
    q["ingest_replaced_file"] = _ingest_replaced
    q["warehouse_fresh_after_relanding"] = _fresh_after_relanding
    q["csv_awkward_fields"] = _csv_awkward
    q["csv_bad_records"] = _csv_bad_records
    return q


def oracle_sql() -> dict[str, str]:
    s: dict[str, str] = {}
    for name in SPECS:
        s[name] = oracle.monthly(name)
    for period in ("quarterly", "yearly"):
        for entity in ROLLUPS:
            s[f"{period}_{entity}"] = oracle.rollup(entity, period)
    s["monthly_customer_join_first"] = oracle.monthly("monthly_customer")
    s["monthly_customer_avg"] = oracle.monthly_customer_avg()
    for t in DIMENSIONS:
        s[f"dq_{t}"] = oracle.dq_table(t, "all")
    s["dq_transactions"] = oracle.dq_table("transactions", "fact")
    s["dq_transactions_faulty_dims"] = oracle.dq_table("transactions", "all")
    s["dedupe_drop_all"] = oracle.dedupe_drop_all()
    s["ref_orphans"] = oracle.ref_orphans()
    s["dq_rejects"] = oracle.rejects()
    s["dq_reject_counts"] = oracle.reject_counts()
    s["yearly_employee_exact"] = oracle.employee_exact("yearly")
    s["quarterly_employee_exact"] = oracle.employee_exact("quarterly")
    for period in ("quarterly", "yearly"):
        s[f"{period}_employee_from_state"] = oracle.employee_exact(period)
        s[f"{period}_payment_from_state"] = oracle.payment_exact(period)
    s["yearly_employee_sketch"] = oracle.employee_distinct_within_error()
    s["kpi_period_totals"] = oracle.kpi_period_totals()
    s["kpi_first_seen_customers"] = oracle.kpi_first_seen_customers()
    s["quota_admission"] = oracle.quota_admission(QUOTA_TEST_LIMIT)
    s["quota_remaining"] = oracle.quota_remaining(QUOTA_TEST_LIMIT)
    s["quota_stream"] = oracle.quota_admission(QUOTA_TEST_LIMIT)
    s["quota_stream_late"] = oracle.quota_admission(QUOTA_TEST_LIMIT)
    s["quota_remaining_as_of"] = oracle.quota_remaining_as_of(QUOTA_AS_OF, QUOTA_TEST_LIMIT)
    s["latest_run"] = oracle.latest_run(RUN_LOG_NOW.strftime("%Y-%m-%d %H:%M:%S"),
                                        RUN_LOG_PIPELINES)
    s["client_key"] = oracle.client_key()
    s["preview_top5"] = oracle.preview_top5()
    s["dq_value_edges"] = oracle.value_edges()
    s["metrics_full_refresh_shrinks"] = oracle.without_last_month("monthly_customer")
    s["preview_first_n"] = oracle.preview_first_n(preview.FILE_PREVIEW_LINES)
    for name in oracle.ADHOC:
        s[name] = oracle.adhoc(name)
    s["metrics_append_twice"] = oracle.appended_twice("monthly_customer")
    s["metrics_append_retry"] = oracle.monthly("monthly_customer")
    s["metrics_append_loads"] = oracle.appended_twice("monthly_customer")
    s["preview_all_lines"] = oracle.all_product_lines()
    s["metrics_refresh_twice"] = oracle.monthly("monthly_customer")
    s["metrics_month_refresh"] = oracle.monthly("monthly_customer")
    s["export_csv_roundtrip"] = oracle.monthly("monthly_product")
    s["ingest_csv_roundtrip"] = oracle.dq_table("transactions", "fact")
    s["ingest_stream_available_now"] = oracle.dq_table("transactions", "fact")
    s["ingest_replaced_file"] = oracle.landed_after_replacement()
    s["warehouse_fresh_after_relanding"] = oracle.monthly_of_even_orders("monthly_payment")
    s["csv_awkward_fields"] = oracle.awkward_products()
    s["csv_bad_records"] = oracle.bad_product_records()
    return s
