"""Monthly metrics per customer, employee, payment type and product.

One spec-driven builder.  Each metric is ``fact JOIN dimension GROUP BY
(month, dimension key, dimension attribute)`` with COUNT, COUNT(DISTINCT)
and SUM measures.

Default physical shape (``eager``): aggregate the fact by ``(month, key)``
first -- partial aggregation on the map side, so a hot key collapses to one
row per task before the shuffle -- then join the much smaller result to the
dimension for its attribute.  That equals join-then-aggregate whenever the
dimension key is unique, which the duplicate rule guarantees for cleansed
dimensions.  ``join_first`` keeps the literal shape for dimensions that may
repeat a key.

The month is grouped as a DATE (first day of the month, a 4-byte key) and
formatted as ``yyyy-MM`` only after aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import TOTAL


@dataclass(frozen=True)
class Measure:
    name: str
    kind: str          # count | count_distinct | sum
    column: str

    def expr(self):
        c = F.col(self.column)
        if self.kind == "count":
            return F.count(c)
        if self.kind == "count_distinct":
            return F.count_distinct(c)
        if self.kind == "sum":
            return F.sum(c)
        raise ValueError(self.kind)

    def typed(self, c):
        return c.cast(TOTAL) if self.kind == "sum" else c.cast("long")


@dataclass(frozen=True)
class MetricSpec:
    name: str
    dimension: str
    key: str
    attribute: str
    columns: tuple[str, ...]          # output order
    measures: tuple[Measure, ...]


# Metric definitions (grain, measures, output names and order).
SPECS = {
    "monthly_customer": MetricSpec(
        "monthly_customer", "customers", "customer_id", "customer_state",
        ("month_year", "customer_state", "customer_id", "total_products_bought",
         "total_money_spent"),
        (Measure("total_products_bought", "count", "product_id"),
         Measure("total_money_spent", "sum", "total_amount"))),
    "monthly_employee": MetricSpec(
        "monthly_employee", "employees", "employee_id", "employee_state",
        ("month_year", "employee_state", "employee_id", "unique_customers_serviced",
         "total_products_sold", "total_money_made"),
        (Measure("unique_customers_serviced", "count_distinct", "customer_id"),
         Measure("total_products_sold", "count", "product_id"),
         Measure("total_money_made", "sum", "total_amount"))),
    "monthly_payment": MetricSpec(
        "monthly_payment", "payments", "payment_id", "payment_type",
        ("month_year", "payment_id", "payment_type", "unique_customer_usage",
         "total_times_used", "total_revenue"),
        (Measure("unique_customer_usage", "count_distinct", "customer_id"),
         Measure("total_times_used", "count", "payment_id"),
         Measure("total_revenue", "sum", "total_amount"))),
    "monthly_product": MetricSpec(
        "monthly_product", "products", "product_id", "product_category",
        ("month_year", "product_category", "product_id", "products_sold",
         "total_money_made"),
        (Measure("products_sold", "count", "product_id"),
         Measure("total_money_made", "sum", "total_amount"))),
}

MONTH = "_month"


def month_key(ts: str = "timestamp"):
    return F.trunc(F.col(ts), "MM")


def monthly_metric(fact: DataFrame, dimension: DataFrame, spec: MetricSpec | str,
                   strategy: str = "eager", ts: str = "timestamp") -> DataFrame:
    """Monthly metric table ``spec`` from a typed fact and its dimension."""
    if isinstance(spec, str):
        spec = SPECS[spec]
    aggs = [m.expr().alias(m.name) for m in spec.measures]
    dim = dimension.select(spec.key, spec.attribute)
    if strategy == "eager":
        used = {spec.key} | {m.column for m in spec.measures}
        grouped = (fact.select(month_key(ts).alias(MONTH), *sorted(used))
                   .groupBy(MONTH, spec.key).agg(*aggs))
        out = grouped.join(dim, spec.key, "inner")
    elif strategy == "join_first":
        out = (fact.withColumn(MONTH, month_key(ts)).join(dim, spec.key, "inner")
               .groupBy(MONTH, spec.key, spec.attribute).agg(*aggs))
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    types = {m.name: m for m in spec.measures}
    cols = []
    for c in spec.columns:
        if c == "month_year":
            cols.append(F.date_format(F.col(MONTH), "yyyy-MM").alias(c))
        elif c in types:
            cols.append(types[c].typed(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return out.select(cols)


def average_columns(metric: DataFrame, spec: MetricSpec | str) -> DataFrame:
    """Add the optional average-per-line column (money / lines), DECIMAL(18,2)."""
    if isinstance(spec, str):
        spec = SPECS[spec]
    money = next(m.name for m in spec.measures if m.kind == "sum")
    lines = next(m.name for m in spec.measures if m.kind == "count")
    avg = F.when(F.col(lines) > 0, F.col(money) / F.col(lines)).cast(TOTAL)
    return metric.withColumn(f"avg_{money}_per_line", avg)
