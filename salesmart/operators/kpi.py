"""Period KPIs: transaction counts and amounts, first-seen customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import quarter_label, year_label
from ..schemas import TOTAL


def period_totals(fact: DataFrame) -> DataFrame:
    """``(grain, period, transactions, total_amount)`` for month, quarter, year.

    One pass over the fact (aggregated by month); each monthly row is then
    exploded into its month, quarter and year labels and re-aggregated --
    a few hundred rows, so the fact is scanned exactly once.
    """
    monthly = (fact.groupBy(F.date_format(F.trunc("timestamp", "MM"), "yyyy-MM").alias("p"))
               .agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("amt")))
    labels = F.array(*[F.struct(F.lit(g).alias("grain"), fn.alias("period"))
                       for g, fn in (("month", F.col("p")), ("quarter", quarter_label("p")),
                                     ("year", year_label("p")))])
    out = (monthly.select(F.explode(labels).alias("g"), "n", "amt")
           .groupBy(F.col("g.grain").alias("grain"), F.col("g.period").alias("period"))
           .agg(F.sum("n").alias("n"), F.sum("amt").alias("amt")))
    return out.select("grain", "period", F.col("n").cast("long").alias("transactions"),
                      F.col("amt").cast(TOTAL).alias("total_amount"))


def first_seen_customers(fact: DataFrame) -> DataFrame:
    """Customers by month of their first transaction (accounts-opened proxy)."""
    first = fact.groupBy("customer_id").agg(F.min("timestamp").alias("first_ts"))
    return (first.groupBy(F.date_format("first_ts", "yyyy-MM").alias("month_year"))
            .agg(F.count(F.lit(1)).cast("long").alias("new_customers")))
