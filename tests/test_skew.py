"""A hot key holding a third of the fact: results stay exact and AQE splits
the skewed side of the sort-merge anti join (broadcasts disabled, skew
thresholds lowered so a small fixture counts as skewed)."""

from salesmart.operators import quality
from salesmart.plans.stage import Stager
from salesmart.schemas import LANDING

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_duplicate_id_is_split_and_exact(spark):
    n = 3000
    rows = [(7 if i % 3 == 0 else 100 + i, "2020-01-05 00:00:00", 1, 1, 1, 1, 1, "1.00")
            for i in range(n)]
    fact = spark.createDataFrame(rows, LANDING["transactions"]).repartition(6)
    dims = {t: spark.createDataFrame([(1,)], f"{k} long")
            for t, k in quality.FACT_KEYS.items()}
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        # the warehouse path: the removed-id set is staged as a table, so the
        # anti join reads both sides from plain shuffles (skew-splittable)
        out = quality.cleanse_transactions(fact, dims, Stager(spark, "t_skew").stage)
        got = out.count()
        ids = out.select("transaction_id").distinct().count()
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    # every copy of the hot id is gone, every other row stays
    assert got == ids == n - n // 3
    assert "SortMergeJoin" in plan
    assert "skew=true" in plan or "isSkewJoin=true" in plan, plan


def test_hot_client_day_is_split_and_exact(spark):
    import datetime as dt
    from salesmart.operators import quota
    base = dt.datetime(2024, 1, 1)
    rows = [("hot" if i % 3 == 0 else f"c{i % 50}", base + dt.timedelta(seconds=i), i)
            for i in range(3000)]
    log = spark.createDataFrame(rows, "client string, ts timestamp_ntz, request_id long") \
        .repartition(6)
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        out = quota.admissions(log, 5, Stager(spark, "t_skew_quota").stage)
        got = out.where("admitted").groupBy("client").count().collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert {r["count"] for r in got} == {5}
    assert "skew=true" in plan, plan


def test_rejects_of_a_hot_id_and_hot_keys(spark):
    """A third of the rows share an id, another third lacks the same customer: every row has its reason."""
    n = 3000
    rows = [(7 if i % 3 == 0 else 100 + i, "2020-01-05 00:00:00", 99 if i % 3 == 1 else 1, 1, 1, 1, 1,
             "x" if i % 30 in (0, 1) else "1.00") for i in range(n)] + [(None, "t", 1, 1, 1, 1, 1, "1.00")] * 500
    fact = spark.createDataFrame(rows, LANDING["transactions"]).repartition(6)
    dims = {t: spark.createDataFrame([(1,)], f"{k} long") for t, k in quality.FACT_KEYS.items()}
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        st = Stager(spark, "t_skew_rejects")
        marks = quality.rejected_marks(fact, dims, st.stage)
        got = {r["reason"]: r["count"] for r in quality.transaction_reasons(marks, st.stage).groupBy("reason").count().collect()}
        orphans = quality.referential_orphans(None, None, st.stage, marks).groupBy("dimension", "key_value").count().collect()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == {"duplicate": n // 3, "invalid": n // 30, "orphan": n // 3 - n // 30, "missing": 500}
    assert [tuple(r) for r in orphans] == [("customers", 99, n // 3 - n // 30)]
