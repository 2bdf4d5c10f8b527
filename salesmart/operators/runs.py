"""Latest run per pipeline from a run log (the status page)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import local_time_text

# The nine pipelines the status page follows.
PIPELINES = (
    "IngestProducts", "IngestPayments", "IngestCustomers", "IngestEmployees",
    "IngestTransactions", "CalculateMonthlyCustomerMetrics",
    "CalculateMonthlyProductMetrics", "CalculateMonthlyPaymentMetrics",
    "CalculateMonthlyEmployeeMetrics",
)


def latest_runs(run_log: DataFrame, now: datetime, pipelines=PIPELINES,
                tz: str = "UTC", window: timedelta = timedelta(days=1)) -> DataFrame:
    """Newest run per followed pipeline updated within ``now`` +- ``window``.

    ``(pipeline_name, status, last_updated)`` with the time rendered in
    ``tz`` as ``yyyy-MM-dd HH:mm:ss``.  Pipelines without a run in the
    window are omitted; of runs updated at the same time the one with the
    largest status counts.  ``max`` of a struct is partially aggregated, so
    one busy pipeline never gathers in one task.
    """
    lo, hi = now - window, now + window
    recent = run_log.where(F.col("pipeline_name").isin(list(pipelines))
                           & F.col("last_updated").between(F.lit(lo).cast("timestamp_ntz"),
                                                           F.lit(hi).cast("timestamp_ntz")))
    newest = recent.groupBy("pipeline_name").agg(
        F.max(F.struct("last_updated", "status")).alias("_run"))
    return newest.select("pipeline_name", F.col("_run.status").alias("status"),
                         local_time_text("_run.last_updated", tz).alias("last_updated"))
