"""Quota admission vs a brute-force replay of the counter; latest runs."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from salesmart.operators import quota, runs
from salesmart.session import scratch_path
from salesmart.streaming.quota_stream import current_decisions, decide, firsts_path, run_quota_stream


def replay(rows, limit):
    """The original per-request counter, replayed in time order."""
    state, out = {}, {}
    for client, ts, rid in sorted(rows, key=lambda r: (r[1], r[2])):
        day, used = state.get(client, (None, 0))
        if day != ts.date():
            day, used = ts.date(), 0
        ok = used < limit
        if ok:
            used += 1
        state[client] = (day, used)
        out[rid] = ok
    return out


def make_log(n=400, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for rid in range(n):
        client = "hot" if rnd.random() < 0.35 else f"c{rnd.randrange(6)}"
        rows.append((client, base + dt.timedelta(minutes=rnd.randrange(60 * 24 * 4)), rid))
    return rows


def test_admissions_match_counter_replay(spark):
    rows = make_log()
    log = spark.createDataFrame(rows, "client string, ts timestamp_ntz, request_id long")
    for limit in (1, 3, 10):
        got = {r.request_id: r.admitted for r in quota.admissions(log, limit).collect()}
        assert got == replay(rows, limit)


def test_remaining(spark):
    rows = make_log(100)
    log = spark.createDataFrame(rows, "client string, ts timestamp_ntz, request_id long")
    for r in quota.remaining(log, 4).collect():
        assert r.remaining == max(0, 4 - r.requests)
        assert r.admitted == min(4, r.requests)
    asof = {r.client: r.remaining for r in
            quota.remaining_as_of(log, "2030-01-01", limit=10).collect()}
    assert set(asof.values()) == {10}


def test_stream_equals_batch(spark):
    rows = make_log(300, seed=3)
    log = spark.createDataFrame(rows, "client string, ts timestamp, request_id long")
    base = scratch_path(spark, "test_quota_stream", unique=True)
    src, sink, ckpt = (os.path.join(base, p) for p in ("src", "sink", "ckpt"))
    cut = dt.datetime(2024, 1, 3)
    log.where(F.col("ts") < F.lit(cut)).write.parquet(src, mode="append")
    run_quota_stream(spark, src, sink, ckpt, 3)
    log.where(F.col("ts") >= F.lit(cut)).write.parquet(src, mode="append")
    run_quota_stream(spark, src, sink, ckpt, 3)
    got = {r.request_id: r.admitted for r in spark.read.parquet(sink).collect()}
    assert got == replay(rows, 3)


def _decisions(spark, sink):
    return {r.request_id: r.admitted for r in current_decisions(spark, sink).collect()}


def test_late_requests_get_the_batch_answers(spark):
    """Three shuffled batches: after each one the answers are those of a batch run over what has come."""
    rows = make_log(300, seed=5)
    random.Random(1).shuffle(rows)
    base = scratch_path(spark, "test_quota_late", unique=True)
    src, sink, ckpt = (os.path.join(base, p) for p in ("src", "sink", "ckpt"))
    for end in (100, 200, 300):
        spark.createDataFrame(rows[end - 100:end], "client string, ts timestamp, request_id long").write.parquet(src, mode="append")
        run_quota_stream(spark, src, sink, ckpt, 3)
        assert _decisions(spark, sink) == replay(rows[:end], 3)
    log = spark.read.parquet(sink)
    assert log.where("revision").count() > 0 and log.where("revision and admitted").count() == 0
    versions = spark.read.parquet(firsts_path(sink)).groupBy("day").agg(F.count_distinct("batch").alias("n"))
    assert versions.agg(F.max("n")).first()[0] <= 2  # replaced versions are deleted


def test_a_batch_that_runs_again_changes_nothing(spark):
    rows = make_log(120, seed=9)
    frames = [spark.createDataFrame(rows[i::2], "client string, ts timestamp, request_id long") for i in range(2)]
    sink = scratch_path(spark, "test_quota_retry", unique=True)
    decide(frames[0], 0, sink, 2)
    decide(frames[1], 1, sink, 2)
    once = sorted(map(str, spark.read.parquet(sink).collect()))
    decide(frames[1], 1, sink, 2)
    assert sorted(map(str, spark.read.parquet(sink).collect())) == once
    assert _decisions(spark, sink) == replay(rows, 2)


def test_closed_days_refuse_and_lose_their_state(spark):
    day = lambda d, h, i: ("a", dt.datetime(2024, 1, d, h), i)
    sink = scratch_path(spark, "test_quota_closed", unique=True)
    schema = "client string, ts timestamp, request_id long"
    decide(spark.createDataFrame([day(1, 5, 1), day(9, 5, 2)], schema), 0, sink, 2, keep_days=3)
    decide(spark.createDataFrame([day(1, 6, 3), day(8, 5, 4), (None, dt.datetime(2024, 1, 9), 5)], schema), 1, sink, 2, keep_days=3)
    got = {r.request_id: (r.admitted, r.late) for r in spark.read.parquet(sink).collect()}
    assert got == {1: (False, True), 2: (True, False), 3: (False, True), 4: (True, False), 5: (True, False)}
    assert {str(r.day) for r in spark.read.parquet(firsts_path(sink)).select("day").distinct().collect()} == {"2024-01-08", "2024-01-09"}


def test_hot_client_reaches_the_shuffle_as_a_few_rows(spark):
    """A partial group limit lies below the exchange of the ranking."""
    from pyspark.sql import Window
    log = spark.createDataFrame(make_log(300), "client string, ts timestamp, request_id long").withColumn("day", F.to_date("ts"))
    order = Window.partitionBy("client", "day").orderBy("ts", "request_id")
    plan = log.withColumn("n", F.row_number().over(order)).where("n <= 3")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_latest_runs(spark):
    now = dt.datetime(2024, 1, 15)
    rows = [("IngestProducts", "Failed", dt.datetime(2024, 1, 14, 9)),
            ("IngestProducts", "Succeeded", dt.datetime(2024, 1, 15, 9)),
            ("IngestPayments", "Succeeded", dt.datetime(2024, 1, 10)),   # too old
            ("Other", "Succeeded", dt.datetime(2024, 1, 15, 1))]         # not followed
    log = spark.createDataFrame(rows, "pipeline_name string, status string, "
                                      "last_updated timestamp_ntz")
    got = [tuple(r) for r in runs.latest_runs(log, now).collect()]
    assert got == [("IngestProducts", "Succeeded", "2024-01-15 09:00:00")]
    got = [tuple(r) for r in runs.latest_runs(log, now, tz="Asia/Tokyo").collect()]
    assert got == [("IngestProducts", "Succeeded", "2024-01-15 18:00:00")]
