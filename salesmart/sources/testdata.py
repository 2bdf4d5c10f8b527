"""Landing-layer star schema derived from the driver's test tables.

The mapping and the injected faults are the ones documented in
``FIXTURES.md``; the DuckDB oracle in ``salesmart.checks.oracle`` spells
out the same expressions in SQL.  Every builder reads only the parquet
columns it needs, so Catalyst prunes the scans.

``faults`` selects which tables carry the deterministic faults:
``"fact"`` (default pipeline input: clean dimensions, faulty transactions),
``"all"`` or ``"none"``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LANDING, MONEY
from .listing import fingerprint


#: Driver tables that the star schema is made from.
SOURCES = ("customer", "nation", "supplier", "orders", "part", "lineitem")

_SCANS: dict[tuple[str, str], tuple[str, DataFrame]] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one driver table (memoised until its files change: the footer read happens once)."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    key, state = (spark.sparkContext.applicationId, path), fingerprint(spark, path)
    if _SCANS.get(key, ("",))[0] != state:
        _SCANS[key] = state, spark.read.parquet(path)
    return _SCANS[key][1]


def _conform(df: DataFrame, table: str) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name)
                      for f in LANDING[table].fields])


def _repeat_where(df: DataFrame, cond) -> DataFrame:
    """Append a second copy of the rows matching ``cond`` (duplicate fault)."""
    return df.unionByName(df.where(cond))


def _money_text(c) -> F.Column:
    return c.cast(MONEY).cast("string")


def customers(spark: SparkSession, sf_dir: str, faulty: bool = False) -> DataFrame:
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                               "c_mktsegment")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    df = c.join(n, c.c_nationkey == n.n_nationkey, "inner")
    cid = F.col("c_custkey")
    email = F.concat(F.lower("c_name"), F.lit("@example.com"))
    if faulty:
        email = F.when(cid % 97 == 0, F.lit(None).cast("string")).otherwise(email)
    df = df.select(
        cid.alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("customer_first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("customer_last_name"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
        F.col("c_nationkey").alias("customer_postal"),
        email.alias("customer_email"),
        cid.cast("string").alias("customer_phone"),
    )
    if faulty:
        df = _repeat_where(df, F.col("customer_id") % 89 == 0)
    return _conform(df, "customers")


def employees(spark: SparkSession, sf_dir: str, faulty: bool = False) -> DataFrame:
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    df = s.join(n, s.s_nationkey == n.n_nationkey, "inner")
    sid = F.col("s_suppkey")
    city = F.col("n_name")
    if faulty:
        city = F.when(sid % 31 == 0, F.lit(None).cast("string")).otherwise(city)
    df = df.select(
        sid.alias("employee_id"),
        F.col("s_name").alias("employee_name"),
        sid.cast("string").alias("employee_ssn"),
        sid.cast("string").alias("employee_phone"),
        F.col("n_name").alias("employee_state"),
        city.alias("employee_city"),
        F.col("s_nationkey").alias("employee_postal"),
    )
    if faulty:
        df = _repeat_where(df, F.col("employee_id") % 29 == 0)
    return _conform(df, "employees")


def payments(spark: SparkSession, sf_dir: str, faulty: bool = False) -> DataFrame:
    # Distinct order priorities: partial aggregation keeps this a tiny shuffle.
    pr = read(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    df = pr.select(
        F.substring("o_orderpriority", 1, 1).cast("long").alias("payment_id"),
        F.substring("o_orderpriority", 3, 1 << 20).alias("payment_type"),
    )
    if faulty:
        # The three extra landing rows of the fixture.
        extra = spark.createDataFrame(
            [(6, None), (7, "GIFT"), (7, "GIFT")], "payment_id long, payment_type string")
        df = df.unionByName(extra)
    return _conform(df, "payments")


def products(spark: SparkSession, sf_dir: str, faulty: bool = False) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    pid = F.col("p_partkey")
    price = _money_text(F.col("p_retailprice"))
    if faulty:
        price = (F.when(pid % 83 == 0, F.lit("-1.00"))
                 .when(pid % 79 == 0, F.lit("n/a"))
                 .when(pid % 73 == 0, F.lit("0.00"))
                 .otherwise(price))
    df = p.select(
        pid.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
        price.alias("unit_price"),
    )
    if faulty:
        df = _repeat_where(df, F.col("product_id") % 71 == 0)
    return _conform(df, "products")


def transactions(spark: SparkSession, sf_dir: str, faulty: bool = True) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                             "o_orderpriority")
    # Both sides grow with the data (orders is a quarter of lineitem): a
    # shuffle join on the order key, never a broadcast of orders.
    df = li.join(o.hint("merge"), li.l_orderkey == o.o_orderkey, "inner")
    tid = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    ts = F.col("o_orderdate").cast("string")
    cust = F.col("o_custkey")
    pay = F.substring("o_orderpriority", 1, 1).cast("long")
    amount = _money_text(F.col("l_extendedprice"))
    if faulty:
        ts = F.when(tid % 113 == 0, F.lit("2020-13-45")).otherwise(ts)
        cust = F.when(tid % 101 == 0, F.lit(None).cast("long")).otherwise(cust)
        pay = F.when(tid % 109 == 0, F.lit(99).cast("long")).otherwise(pay)
        amount = (F.when(tid % 107 == 0, F.lit("abc"))
                  .when(tid % 103 == 0, F.lit("-5.00"))
                  .otherwise(amount))
    df = df.select(
        tid.alias("transaction_id"),
        ts.alias("timestamp"),
        cust.alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("employee_id"),
        pay.alias("payment_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        amount.alias("total_amount"),
    )
    return _conform(df, "transactions")


BUILDERS = {"customers": customers, "employees": employees, "payments": payments,
            "products": products, "transactions": transactions}


def landing_table(spark: SparkSession, sf_dir: str, table: str, faults: str = "fact"
                  ) -> DataFrame:
    """One landing table; ``faults`` in {"fact", "all", "none"}."""
    if faults not in ("fact", "all", "none"):
        raise ValueError(f"faults must be fact, all or none, not {faults!r}")
    faulty = faults != "none" if table == "transactions" else faults == "all"
    return BUILDERS[table](spark, sf_dir, faulty)


def landing_tables(spark: SparkSession, sf_dir: str, faults: str = "fact") -> dict[str, DataFrame]:
    """All five landing tables."""
    return {t: landing_table(spark, sf_dir, t, faults) for t in BUILDERS}


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log for the query quota: one row per request."""
    e = read(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    return e.select(F.col("user_id").cast("string").alias("client"),
                    F.col("ts").cast("timestamp_ntz").alias("ts"),
                    F.col("event_id").alias("request_id"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline run log (pipeline_name, status, last_updated)."""
    e = read(spark, sf_dir, "events").select("event_type", "value", "ts")
    return e.select(F.col("event_type").alias("pipeline_name"),
                    F.col("value").cast("string").alias("status"),
                    F.col("ts").cast("timestamp_ntz").alias("last_updated"))


def client_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-request header triple (forwarded_for, real_ip, remote_addr)."""
    e = read(spark, sf_dir, "events").select("event_id", "user_id")
    uid = F.col("user_id").cast("string")
    eid = F.col("event_id")
    xff = (F.when(eid % 3 == 0, F.concat(F.lit("10.0.0."), uid, F.lit(":443,10.1.1.1")))
           .when(eid % 3 == 1, F.lit("")))
    rip = F.when(eid % 2 == 0, F.concat(F.lit("10.2.0."), uid))
    addr = F.concat(F.lit("10.3.0."), uid, F.lit(":8080"))
    return e.select(eid.alias("request_id"), xff.alias("forwarded_for"),
                    rip.alias("real_ip"), addr.alias("remote_addr"))


def value_edges(spark, sf_dir: str):
    """Every line item with an edge value as amount, price and time."""
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    kind, price = F.col("l_partkey") % 9, F.col("l_extendedprice").cast("decimal(10,2)").cast("string")
    amount = (F.when(kind == 0, F.lit("123456789.00")).when(kind == 1, F.lit("-0.004"))
              .when(kind == 2, F.lit("1e3")).when(kind == 3, F.concat(price, F.lit(" junk")))
              .when(kind == 4, F.lit("99999999.99")).when(kind == 5, F.lit("")).otherwise(price))
    day = F.col("l_suppkey") % 4
    time = (F.when(day == 0, F.lit("2020-01-05 25:99 junk")).when(day == 1, F.lit("2020-02-30"))
            .when(day == 2, F.lit("2020-01-05")).otherwise(F.lit("2020-01-05 10:11:12")))
    return line.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
                       amount.alias("total_amount"), amount.alias("unit_price"), time.alias("timestamp"))
