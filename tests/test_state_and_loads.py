"""Distinct state, appends by name, month partitions, numbered lines."""

import datetime as dt
import os

import pytest

from salesmart.operators import distinct_state, preview
from salesmart.operators.metrics import monthly_metric
from salesmart.plans.stage import Stager
from salesmart.plans.warehouse import Warehouse, warehouse
from salesmart.schemas import METRICS, typed
from salesmart.session import scratch_path
from salesmart.sinks import tables as sinks

ROWS = [(i, dt.datetime(2020, m, 1 + i % 28), c, 1, 7, 1, 1, None) for i, (m, c) in enumerate(
    [(1, 5), (1, 5), (2, 5), (2, 40_000), (3, 1 << 40), (4, 5), (4, None), (4, -3)])]


def test_state_merges_months_exactly(spark):
    fact = spark.createDataFrame(ROWS, typed("transactions"))
    bitmaps = distinct_state.monthly_bitmaps(fact, "monthly_employee")
    got = {r["quarter_year"]: r["unique_customers_serviced"]
           for r in distinct_state.distinct_in_periods(bitmaps, "monthly_employee", "quarterly").collect()}
    assert got == {"2020-Q1": 3, "2020-Q2": 2}
    year = distinct_state.distinct_in_periods(bitmaps, "monthly_employee", "yearly").first()
    assert (year["year"], year["employee_id"], year["unique_customers_serviced"]) == ("2020", 7, 4)
    # a bucket of ids is one row, so no row grows beyond its bitmap
    assert bitmaps.selectExpr("max(length(bits)) AS n").first()["n"] == 4096
    sketches = distinct_state.monthly_sketches(fact, "monthly_employee")
    assert distinct_state.estimated_in_periods(sketches, "monthly_employee", "yearly").first()["unique_customers_serviced"] == 4


def test_a_key_without_members_counts_zero(spark):
    fact = spark.createDataFrame([ROWS[6]], typed("transactions"))
    dim = spark.createDataFrame([(7, "S")], "employee_id long, employee_state string")
    monthly = monthly_metric(fact, dim, "monthly_employee")
    out = distinct_state.exact_rollup(monthly, distinct_state.monthly_bitmaps(fact, "monthly_employee"), "employee", "yearly")
    assert out.first()["unique_customers_serviced"] == 0 and out.columns[0] == "year"


def roots(df):
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    leaves = [leaves.apply(i) for i in range(leaves.size())]
    return [x.relation().location().rootPaths().mkString(",") for x in leaves if x.nodeName() == "LogicalRelation"]


def test_rollups_from_state_do_not_read_the_fact(spark, sf_small):
    wh = warehouse(spark, sf_small)
    paths = roots(wh.exact_rollup("employee", "yearly"))
    assert any("monthly_employee_bitmaps" in p for p in paths) and not any("transactions" in p for p in paths)


def test_sketch_stays_within_its_error(spark):
    fact = spark.range(60_000).selectExpr(
        "id AS transaction_id", "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(CAST(id % 300 AS INT)) AS timestamp",
        "id % 20000 AS customer_id", "1L AS employee_id")
    n = distinct_state.estimated_in_periods(distinct_state.monthly_sketches(fact, "monthly_employee"), "monthly_employee", "yearly").first()[2]
    assert abs(n - 20_000) <= 20_000 * distinct_state.SKETCH_ERROR


def metric(spark, *ids):
    return spark.createDataFrame([("2020-01", "S", i, 1, None) for i in ids], METRICS["monthly_customer"])


def test_a_load_is_appended_once(spark, monkeypatch):
    path, schema = scratch_path(spark, "t_loads", unique=True), METRICS["monthly_customer"]
    ids = lambda: sorted(r.customer_id for r in sinks.read_loads(spark, path, schema).collect())
    assert ids() == []
    assert sinks.append_load(metric(spark, 1, 2), path, "a") and not sinks.append_load(metric(spark, 1, 2), path, "a")
    assert ids() == [1, 2]
    assert sinks.append_load(metric(spark, 1, 2), path, "b") and ids() == [1, 1, 2, 2]
    # written, but lost before the ledger: not seen, and the retry replaces it
    with monkeypatch.context() as m:
        m.setattr(sinks, "_ledger", lambda p: (_ for _ in ()).throw(RuntimeError("driver lost")) if os.path.exists(f"{path}/load_id=c")
                  else f"{p}_loads")
        with pytest.raises(RuntimeError):
            sinks.append_load(metric(spark, 9), path, "c")
    assert ids() == [1, 1, 2, 2]
    assert sinks.append_load(metric(spark, 9), path, "c") and ids() == [1, 1, 2, 2, 9]
    assert sinks.read_loads(spark, path, schema).schema == schema


def test_the_job_appends_once_per_input(spark, sf_small):
    from salesmart.__main__ import main
    out = scratch_path(spark, "t_append_job", unique=True)
    args = ["--tables", sf_small, "--out", out, "--mode", "append"]
    path = main(args)["monthly_customer"]
    once = sinks.read_loads(spark, path, METRICS["monthly_customer"]).count()
    main(args)
    assert sinks.read_loads(spark, path, METRICS["monthly_customer"]).count() == once > 0
    main([*args, "--load-id", "again"])
    assert sinks.read_loads(spark, path, METRICS["monthly_customer"]).count() == 2 * once


def test_one_month_reads_its_partition_only(spark, sf_small):
    wh = Warehouse(spark, sf_small, "fact", partition_fact=True)
    fact = wh.clean("transactions")
    assert fact.schema == typed("transactions")
    plain = warehouse(spark, sf_small).clean("transactions")
    assert fact.count() == plain.count() and fact.exceptAll(plain).count() == 0
    one = wh.fact_by_month().where("month_year IN ('1995-03')")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month_year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    files = one.inputFiles()
    assert 0 < len(one._jdf.queryExecution().optimizedPlan().collectLeaves().apply(0).relation().location().inputFiles()) >= len(
        {f for f in files if "month_year=1995-03" in f}) > 0
    months = wh.publish(scratch_path(spark, "t_month", unique=True), ["1995-03"], ("monthly_payment",))
    got = spark.read.parquet(months["monthly_payment"])
    want = wh.monthly("monthly_payment").where("month_year = '1995-03'")
    assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == want.count() > 0


@pytest.mark.parametrize("split", ["64b", "1k", "128m"])
def test_lines_are_numbered_over_splits_and_files(spark, split):
    path = scratch_path(spark, "t_lines", unique=True)
    os.makedirs(path)
    files = {"a.csv": ["head", *(f"a{i}" for i in range(57))], "b.csv": ["head"], "c.csv": ["head", "", "c1", "x" * 200, "c3"]}
    for name, lines in files.items():
        with open(os.path.join(path, name), "w") as fh:
            fh.write("\n".join(lines) + "\n")
    with open(os.path.join(path, "d.csv"), "w"):
        pass
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        every = [x for lines in files.values() for x in lines]
        got = preview.numbered_lines(spark, path, stage=Stager(spark, "t_lines").stage)
        assert sorted(map(tuple, got.collect())) == list(enumerate(every, 1))
        body = [x for lines in files.values() for x in lines[1:]]
        got = preview.numbered_lines(spark, path, skip_header=True)
        assert sorted(map(tuple, got.collect())) == list(enumerate(body, 1))
        one = preview.numbered_lines(spark, os.path.join(path, "a.csv"))
        assert sorted(map(tuple, one.collect())) == list(enumerate(files["a.csv"], 1))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
