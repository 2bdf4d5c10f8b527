"""Metrics and roll-ups: shapes, label edges, invariants."""

import decimal

from pyspark.sql import functions as F

from salesmart.functions.columns import quarter_label
from salesmart.operators.metrics import monthly_metric
from salesmart.operators.rollups import exact_distinct_rollup, rollup
from salesmart.plans.warehouse import warehouse


def test_quarter_label_edges_and_null(spark):
    df = spark.createDataFrame([("2020-01",), ("2020-03",), ("2020-04",), ("2020-12",),
                                (None,)], "m string")
    got = [r.q for r in df.select(quarter_label("m").alias("q")).collect()]
    assert got == ["2020-Q1", "2020-Q1", "2020-Q2", "2020-Q4", "-Q"]


def test_eager_equals_join_first(spark, sf_small):
    wh = warehouse(spark, sf_small)
    fact = wh.clean("transactions")
    for name, dim in (("monthly_customer", "customers"), ("monthly_employee", "employees"),
                      ("monthly_payment", "payments"), ("monthly_product", "products")):
        a = monthly_metric(fact, wh.clean(dim), name, "eager")
        b = monthly_metric(fact, wh.clean(dim), name, "join_first")
        assert a.schema == b.schema
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_money_and_lines_are_conserved(spark, sf_small):
    wh = warehouse(spark, sf_small)
    fact_total = wh.clean("transactions").agg(F.sum("total_amount"), F.count("*")).first()
    m = wh.monthly("monthly_product").agg(F.sum("total_money_made"),
                                          F.sum("products_sold")).first()
    q = wh.rollup("product", "quarterly").agg(F.sum("total_money_made")).first()
    y = wh.rollup("product", "yearly").agg(F.sum("total_money_made")).first()
    assert decimal.Decimal(fact_total[0]) == m[0] == q[0] == y[0]
    assert fact_total[1] == m[1]


def test_summed_distincts_overcount_exact(spark, sf_small):
    wh = warehouse(spark, sf_small)
    summed = wh.rollup("employee", "yearly").agg(F.sum("unique_customers_serviced")).first()[0]
    exact = exact_distinct_rollup(wh.clean("transactions"), wh.clean("employees")) \
        .agg(F.sum("unique_customers_serviced")).first()[0]
    assert summed >= exact


def test_payment_rollup_drops_distinct_measure(spark, sf_small):
    wh = warehouse(spark, sf_small)
    cols = rollup(wh.monthly("monthly_payment"), "payment", "quarterly").columns
    assert cols == ["quarter_year", "payment_id", "payment_type", "total_times_used",
                    "total_revenue"]


def test_metric_schemas(spark, sf_small):
    from salesmart.schemas import METRICS
    wh = warehouse(spark, sf_small)
    for name, schema in METRICS.items():
        got = wh.monthly(name).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in schema]


def test_counts_lines_not_quantity(spark):
    fact = spark.createDataFrame(
        [(1, "2020-01-02 00:00:00", 1, 1, 1, 1, 50, decimal.Decimal("1.00")),
         (2, "2020-01-03 00:00:00", 1, 2, 1, 1, 70, decimal.Decimal("2.00"))],
        "transaction_id long, timestamp string, customer_id long, product_id long, "
        "employee_id long, payment_id long, quantity int, total_amount decimal(10,2)"
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    cust = spark.createDataFrame([(1, "S")], "customer_id long, customer_state string")
    r = monthly_metric(fact, cust, "monthly_customer").first()
    assert (r.month_year, r.total_products_bought, r.total_money_spent) == \
        ("2020-01", 2, decimal.Decimal("3.00"))
