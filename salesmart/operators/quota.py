"""Per-client daily query quota, computed from a request log.

The original keeps a mutable counter row per client: on each request it
resets the counter when the stored date is not today, admits the request
while the counter is below the limit and then increments it; refused
requests are not counted.  Over a log ``(client, ts, request_id)`` that is
exactly: *a request is admitted iff it is among the first ``limit``
requests of its client on its day*, ordered by ``(ts, request_id)``.

Physical shape.  A plain ``row_number()`` over ``(client, day)`` would
send all requests of a client-day to one task -- a hot client (say a third
of all traffic) would then be sorted in a single task.  Instead:

1. the ``limit``-th request per client-day is found with ``row_number() <=
   limit`` followed by a max; Spark plans that filter as a *partial*
   ``WindowGroupLimit`` before the shuffle, so at most ``limit`` rows per
   client-day leave each task;
2. every request is compared with its client-day cutoff through an
   equi-join on ``(client, day)`` -- one small row per client-day on the
   build side.  With the cut-offs staged, that side is either broadcast
   (measured size) or a plain shuffle, so AQE can split a hot client-day
   on the request side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: queries allowed per client and day.
DAILY_LIMIT = 10


def _with_day(log: DataFrame) -> DataFrame:
    return log.withColumn("day", F.to_date("ts"))


def _cutoffs(d: DataFrame, limit: int) -> DataFrame:
    """``(client, day, _cut)``: (ts, request_id) of the last admitted request."""
    w = Window.partitionBy("client", "day").orderBy("ts", "request_id")
    return (d.select("client", "day", "ts", "request_id")
            .withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= limit)
            .groupBy("client", "day")
            .agg(F.max(F.struct("ts", "request_id")).alias("_cut")))


def admissions(log: DataFrame, limit: int = DAILY_LIMIT, stage=None) -> DataFrame:
    """Every request with its decision ``admitted``.

    ``stage`` (see ``plans.stage.Stager.stage``) stores the cut-off table:
    the join then gets a measured build side (broadcast when it fits) or a
    plain shuffle on both sides, which lets AQE split a hot client-day.
    """
    d = _with_day(log)
    cut = _cutoffs(d, limit)
    if stage is not None:
        cut = stage(cut, "quota_cutoffs")
    # a request without client counts for the client NULL, as it does in the windows
    cut = cut.select(F.col("client").alias("_client"), F.col("day").alias("_day"), "_cut")
    joined = d.join(cut, F.col("client").eqNullSafe(F.col("_client")) & (F.col("day") == F.col("_day")), "left")
    admitted = F.struct("ts", "request_id") <= F.col("_cut")
    return joined.select("client", "request_id", "ts", "day",
                         F.coalesce(admitted, F.lit(False)).alias("admitted"))


def remaining(log: DataFrame, limit: int = DAILY_LIMIT) -> DataFrame:
    """``(client, day, requests, admitted, remaining)`` per client-day.

    remaining = max(0, limit - used) with used = min(limit, requests); a
    plain partial aggregation, skew-safe.
    """
    d = _with_day(log)
    n = F.col("requests")
    return (d.groupBy("client", "day").agg(F.count(F.lit(1)).alias("requests"))
            .select("client", "day", n.alias("requests"),
                    F.least(n, F.lit(limit)).cast("long").alias("admitted"),
                    F.greatest(F.lit(0), F.lit(limit) - n).cast("long").alias("remaining")))


def remaining_as_of(log: DataFrame, as_of, clients: DataFrame | None = None,
                    limit: int = DAILY_LIMIT) -> DataFrame:
    """Remaining queries on day ``as_of`` for every known client.

    A client without requests that day (or never seen) has the full limit.
    ``clients`` defaults to every client in the log.
    """
    day = F.lit(as_of).cast("date")
    known = (clients if clients is not None else log.select("client")).distinct()
    today = (log.where(F.to_date("ts") == day).groupBy("client")
             .agg(F.count(F.lit(1)).alias("requests")))
    n = F.coalesce(F.col("requests"), F.lit(0))
    return (known.join(today, "client", "left")
            .select("client", day.alias("day"),
                    F.greatest(F.lit(0), F.lit(limit) - n).cast("long").alias("remaining")))
