"""Physical-plan checks: no nested-loop or cartesian joins, no Python in the
cleansing and metric plans, filters and pruning reach the scan."""

import pytest

from salesmart.plans.warehouse import Warehouse


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wh(spark, sf_small):
    return Warehouse(spark, sf_small, "fact", materialize=False)


BAD = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("table", ["transactions", "customers", "products"])
def test_cleanse_plans(wh, table):
    text = plan_text(wh.clean(table))
    for bad in BAD:
        assert bad not in text


@pytest.mark.parametrize("name", ["monthly_customer", "monthly_employee",
                                  "monthly_payment", "monthly_product"])
def test_metric_plans(wh, name):
    text = plan_text(wh.monthly(name))
    for bad in BAD:
        assert bad not in text


def test_null_rule_pushed_to_scan(spark, sf_small):
    from salesmart.operators.quality import drop_missing
    df = spark.read.parquet(f"{sf_small}/orders.parquet")
    text = plan_text(drop_missing(df, ["o_custkey"]).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_custkey)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_fact_shuffles_once_without_broadcast(spark, sf_small):
    """With broadcasting off, whole fact rows cross one exchange (the final
    anti join); the duplicate count only ships ids after a partial agg."""
    from salesmart.operators import quality
    from salesmart.schemas import DIMENSIONS
    w = Warehouse(spark, sf_small, "fact")
    land, dims = w.landing("transactions"), {d: w.clean(d) for d in DIMENSIONS}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = quality.cleanse_transactions(land, dims)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_small_removed_set_is_broadcast(spark, sf_small):
    w = Warehouse(spark, sf_small, "fact")
    w.clean("transactions")
    assert w.stager.fits_broadcast("removed_ids")
    assert w.stager.fits_broadcast("missing_keys")


def test_bucketed_dimensions_join_without_shuffling_the_dimension(spark, sf_small):
    from salesmart.operators.metrics import monthly_metric
    w = Warehouse(spark, sf_small, "fact")
    fact, cust = w.clean("transactions"), w.clean("customers")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(monthly_metric(fact, cust, "monthly_customer"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    # the dimension is read bucketed; only the aggregated fact side moves
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan, plan
    assert "hashpartitioning(customer_id#" in plan
    assert plan.count("Exchange hashpartitioning(customer_id") == 1, plan


def test_staged_row_counts_are_observed_exactly(spark):
    from salesmart.plans.stage import Stager
    st = Stager(spark, "t_obs")
    df = spark.range(1234).selectExpr("id", "id % 7 as k").where("k <> 3")
    back = st.put(df, "plain")
    bucketed = st.put(df, "bucketed", bucket_by="id")
    assert st.staged["plain"]._rows == back.count() == df.count()
    assert st.staged["bucketed"]._rows == bucketed.count() == df.count()
    assert st.fits_broadcast("plain")


def _scans(df, path):
    """How many scans of the stored fact a plan holds (one entry)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    leaves = [leaves.apply(i) for i in range(leaves.size())]
    roots = [x.relation().location().rootPaths().mkString(",") for x in leaves if x.nodeName() == "LogicalRelation"]
    return [sum(path in r for r in roots)]


def test_the_fact_is_read_three_times_and_never_by_the_reports(spark, sf_small):
    """Marks: one pass counts the keys, one marks the rows; the reports read the marks."""
    from salesmart.operators import quality
    w = Warehouse(spark, sf_small, "all")
    fact = w.stager.staged["landing_transactions"].path if w.landing("transactions") else ""
    dims = {d: w.clean(d) for d in ("customers", "employees", "payments", "products")}
    assert len(w.landing("transactions").inputFiles()) > 0 and fact
    assert _scans(quality.faulty_keys(w.landing("transactions"), dims), fact) == [1]
    faulty = w.stager.put(quality.faulty_keys(w.landing("transactions"), dims), "faulty")
    marks = quality.rejected_marks(w.landing("transactions"), dims, lambda df, name: faulty if name == "missing_keys" else df)
    assert _scans(marks, fact) == [1]
    assert _scans(quality.cleanse_transactions(w.landing("transactions"), dims, w.stager.stage, w.marks()), fact) == [1]
    for report in (w.orphans(), quality.transaction_reasons(w.marks())):
        assert _scans(report, fact) == [0]
