"""Scalar functions, previews, sinks and sources."""

import os

import pytest

from salesmart.functions.columns import client_key
from salesmart.operators import preview
from salesmart.schemas import LANDING, METRICS
from salesmart.session import scratch_path
from salesmart.sinks import tables as sinks
from salesmart.sources import csv_landing
from salesmart.streaming.ingest import ingest_available


def test_client_key(spark):
    rows = [("1.1.1.1:443, 2.2.2.2", "3.3.3.3", "4.4.4.4:80"),
            ("", "3.3.3.3", "4.4.4.4:80"),
            (None, "", "4.4.4.4:80"),
            (None, None, "5.5.5.5"),
            ("fe80::1", None, "x")]
    df = spark.createDataFrame(rows, "f string, r string, a string")
    got = [r.k for r in df.select(client_key("f", "r", "a").alias("k")).collect()]
    assert got == ["1.1.1.1", "3.3.3.3", "4.4.4.4", "5.5.5.5", "fe80"]


def test_preview_allow_list():
    assert preview.check_table("monthly_customer") == "monthly_customer"
    with pytest.raises(ValueError, match="Invalid table name"):
        preview.check_table("secrets")


def test_preview_lines_reads_head_of_file(spark):
    path = scratch_path(spark, "test_preview", unique=True)
    spark.range(100).selectExpr("cast(id as string) as v").coalesce(1) \
        .write.option("header", True).csv(path)
    f = [p for p in spark.read.text(path).inputFiles() if "part-" in p][0]
    got = [(r.line_no, r.line) for r in preview.preview_lines(spark, f, 4).collect()]
    assert got == [(1, "v"), (2, "0"), (3, "1"), (4, "2")]


def test_append_twice_refresh_twice(spark):
    df = spark.createDataFrame([("2020-01", "S", 1, 2, None)], METRICS["monthly_customer"])
    a = scratch_path(spark, "t_append", unique=True)
    r = scratch_path(spark, "t_refresh", unique=True)
    for _ in range(2):
        sinks.append(df, a)
        sinks.refresh(df, r)
    assert spark.read.parquet(a).count() == 2
    assert spark.read.parquet(r).count() == 1


def test_refresh_replaces_only_given_partitions(spark):
    schema = METRICS["monthly_customer"]
    p = scratch_path(spark, "t_dyn", unique=True)
    sinks.refresh(spark.createDataFrame([("2020-01", "S", 1, 1, None),
                                         ("2020-02", "S", 1, 1, None)], schema), p, "month_year")
    sinks.refresh(spark.createDataFrame([("2020-02", "S", 1, 5, None)], schema), p, "month_year", ["2020-02"])
    got = sorted((r.month_year, r.total_products_bought) for r in spark.read.parquet(p).collect())
    assert got == [("2020-01", 1), ("2020-02", 5)]


def test_csv_landing_roundtrip_nulls_and_bad_keys(spark):
    path = scratch_path(spark, "t_csv", unique=True)
    os.makedirs(path)
    with open(os.path.join(path, "t.csv"), "w") as fh:
        fh.write("payment_id,payment_type\n1,CASH\n,CARD\nx,GIFT\n3,\n")
    got = sorted(tuple(r) for r in csv_landing.read_landing_csv(spark, path, "payments")
                 .fillna(-1, ["payment_id"]).fillna("<null>", ["payment_type"]).collect())
    assert got == [(-1, "CARD"), (-1, "GIFT"), (1, "CASH"), (3, "<null>")]


def test_stream_ingest_picks_only_new_files(spark):
    base = scratch_path(spark, "t_stream", unique=True)
    src, sink, ckpt = (os.path.join(base, p) for p in ("src", "sink", "ckpt"))
    one = spark.createDataFrame([(1, "A")], LANDING["payments"])
    csv_landing.land_csv(one, os.path.join(src, "a"))
    ingest_available(spark, os.path.join(src, "*"), "payments", sink, ckpt)
    two = spark.createDataFrame([(2, "B")], LANDING["payments"])
    csv_landing.land_csv(two, os.path.join(src, "b"))
    ingest_available(spark, os.path.join(src, "*"), "payments", sink, ckpt)
    assert sorted(r.payment_id for r in spark.read.parquet(sink).collect()) == [1, 2]


def test_create_empty_tables(spark):
    from salesmart.schemas import typed
    root = scratch_path(spark, "t_empty", unique=True)
    paths = sinks.create_empty_tables(spark, root)
    assert set(paths) == {"customers", "employees", "payments", "products", "transactions",
                          "monthly_customer", "monthly_employee", "monthly_payment",
                          "monthly_product"}
    df = spark.read.parquet(paths["transactions"])
    assert df.count() == 0 and df.schema == typed("transactions")


def test_warehouse_table_allow_list(spark, sf_small):
    from salesmart.plans.warehouse import warehouse
    wh = warehouse(spark, sf_small)
    assert wh.table("payments").count() == 5
    with pytest.raises(ValueError, match="Invalid table name"):
        wh.table("IPQueryTracking")


def test_warehouse_from_csv_equals_parquet_mapping(spark, sf_small):
    from salesmart.plans.warehouse import Warehouse, from_csv
    from salesmart.sources import testdata
    root = scratch_path(spark, "t_csv_wh", unique=True)
    for t, df in testdata.landing_tables(spark, sf_small, "all").items():
        csv_landing.land_csv(df, os.path.join(root, t))
    a = from_csv(spark, root).monthly("monthly_employee")
    b = Warehouse(spark, sf_small, "all").monthly("monthly_employee")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_batch_job_publishes_and_reruns_a_month(spark, sf_small):
    from salesmart.__main__ import main
    from salesmart.plans.warehouse import warehouse
    out = scratch_path(spark, "t_job", unique=True)
    paths = main(["--tables", sf_small, "--out", out])
    first = spark.read.parquet(paths["monthly_customer"])
    month = first.agg({"month_year": "min"}).first()[0]
    main(["--tables", sf_small, "--out", out, "--months", month])
    again = spark.read.parquet(paths["monthly_customer"]).select(*first.columns)
    ref = warehouse(spark, sf_small, "fact").monthly("monthly_customer").select(*first.columns)
    assert again.count() == ref.count()
    assert again.exceptAll(ref).count() == 0
    assert spark.read.parquet(paths["rejects"]).count() > 0


def test_refresh_drops_months_that_became_empty_or_vanished(spark):
    schema = METRICS["monthly_customer"]
    p = scratch_path(spark, "t_empty", unique=True)
    rows = spark.createDataFrame([(m, "S", 1, 1, None) for m in ("2020-01", "2020-02", "2020-03")], schema)
    sinks.refresh(rows, p, "month_year")
    sinks.refresh(rows.where("month_year > '2020-03'"), p, "month_year", ["2020-02"])
    assert sorted(r.month_year for r in spark.read.parquet(p).collect()) == ["2020-01", "2020-03"]
    sinks.refresh(rows.where("month_year = '2020-03'"), p, "month_year")
    assert [r.month_year for r in spark.read.parquet(p).collect()] == ["2020-03"]


def test_run_sql_takes_queries_only(spark, sf_small):
    import pytest
    from salesmart.plans.adhoc import QueryError, run_sql
    from salesmart.plans.warehouse import warehouse

    wh = warehouse(spark, sf_small)
    assert run_sql(wh, "SELECT count(*) AS n FROM payments; ").first()["n"] == 5
    for text in ("DROP TABLE payments", "CREATE TABLE t AS SELECT 1", "SELECT 1; DROP TABLE t",
                 "INSERT INTO payments SELECT 1, 'x'", "SELECT nothing FROM payments", "SELEC"):
        with pytest.raises(QueryError):
            run_sql(wh, text)


def test_value_rule_sees_the_whole_text(spark):
    from salesmart.functions.columns import valid_money, valid_timestamp

    good = ["0", "12.5", " 7.00 ", "99999999.99", ".5", "+3"]
    bad = ["", "abc", "1e3", "-0.004", "-1", "123456789.00", "5 x", "1,5", None]
    rows = spark.createDataFrame([(t,) for t in good + bad], "t string")
    assert [r[0] for r in rows.select(valid_money("t")).collect()] == [True] * len(good) + [False] * len(bad)
    times = spark.createDataFrame([("2020-01-05",), ("2020-01-05 10:00:00",), ("2020-01-05 25:99 junk",),
                                   ("2020-02-30",), (None,)], "t string")
    assert [r[0] for r in times.select(valid_timestamp("t")).collect()] == [True, True, False, False, False]
