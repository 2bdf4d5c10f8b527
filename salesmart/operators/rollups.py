"""Quarterly and yearly roll-ups of the monthly metric tables.

They read the stored monthly tables, like views would, and re-aggregate
by a period label derived from ``month_year``.  Faithful details:

* the distinct measures are *sums of monthly distinct counts* (an
  over-count across months); ``exact_distinct_rollup`` recomputes the true
  figure from the fact;
* the payment roll-ups drop ``unique_customer_usage``;
* the quarter label is built with a NULL-as-empty concat.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import quarter_label, year_label
from ..schemas import TOTAL


@dataclass(frozen=True)
class RollupSpec:
    source: str                       # monthly table
    dims: tuple[str, str]             # dimension columns in output order
    sums: tuple[str, ...]             # summed measures in output order
    money: str                        # the decimal measure


# Roll-up definitions (output names and order).
ROLLUPS = {
    "customer": RollupSpec("monthly_customer", ("customer_state", "customer_id"),
                           ("total_products_bought", "total_money_spent"),
                           "total_money_spent"),
    "employee": RollupSpec("monthly_employee", ("employee_state", "employee_id"),
                           ("unique_customers_serviced", "total_products_sold",
                            "total_money_made"), "total_money_made"),
    "payment": RollupSpec("monthly_payment", ("payment_id", "payment_type"),
                          ("total_times_used", "total_revenue"), "total_revenue"),
    "product": RollupSpec("monthly_product", ("product_category", "product_id"),
                          ("products_sold", "total_money_made"), "total_money_made"),
}

PERIODS = {"quarterly": ("quarter_year", quarter_label), "yearly": ("year", year_label)}


def rollup(monthly: DataFrame, entity: str, period: str) -> DataFrame:
    """``quarterly`` / ``yearly`` roll-up of one monthly metric table."""
    spec = ROLLUPS[entity]
    label, fn = PERIODS[period]
    aggs = [F.sum(m).alias(m) for m in spec.sums]
    out = (monthly.select(fn("month_year").alias(label), *spec.dims, *spec.sums)
           .groupBy(label, *spec.dims).agg(*aggs))
    return out.select(label, *spec.dims,
                      *[(F.col(m).cast(TOTAL) if m == spec.money else F.col(m).cast("long"))
                        .alias(m) for m in spec.sums])


def exact_distinct_rollup(fact: DataFrame, employees: DataFrame, period: str = "yearly"
                          ) -> DataFrame:
    """Employee roll-up with the *true* distinct customer count per period.

    Aggregates the fact by (period, employee) directly -- the distinct is
    planned as two partial aggregations, so a hot employee never lands in
    one task whole -- then joins the dimension for the state.
    """
    label, fn = PERIODS[period]
    # group on a truncated DATE; format the label after aggregation
    unit = "quarter" if period == "quarterly" else "year"
    g = (fact.select(F.trunc("timestamp", unit).alias("_period"), "employee_id",
                     "customer_id", "product_id", "total_amount")
         .groupBy("_period", "employee_id")
         .agg(F.count_distinct("customer_id").alias("unique_customers_serviced"),
              F.count("product_id").alias("total_products_sold"),
              F.sum("total_amount").alias("total_money_made"))
         .withColumn(label, fn(F.date_format("_period", "yyyy-MM"))))
    g = g.join(employees.select("employee_id", "employee_state"), "employee_id", "inner")
    return g.select(label, "employee_state", "employee_id",
                    F.col("unique_customers_serviced").cast("long").alias(
                        "unique_customers_serviced"),
                    F.col("total_products_sold").cast("long").alias("total_products_sold"),
                    F.col("total_money_made").cast(TOTAL).alias("total_money_made"))


__all__ = ["ROLLUPS", "rollup", "exact_distinct_rollup"]
