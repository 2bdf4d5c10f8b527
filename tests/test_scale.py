"""What a task holds and what the shuffles move as the input grows."""

import os

import pytest

from salesmart import session
from salesmart.operators import distinct_state, quality
from salesmart.plans import registry
from salesmart.plans.stage import Stager
from salesmart.plans.warehouse import warehouse
from salesmart.schemas import LANDING, typed

DIMS = {"customers": (1, 2), "products": (1,), "employees": (1,), "payments": (1,)}


@pytest.fixture
def settings(spark):
    """Settings of one test, taken back afterwards."""
    kept = {}

    def put(**values):
        for k, v in values.items():
            key = "spark.sql." + k.replace("__", ".")
            kept.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, v)
    yield put
    for key, v in kept.items():
        spark.conf.unset(key) if v is None else spark.conf.set(key, v)
    session.scale_partitions(spark, 0)


def facts(spark, hot=10_000):
    rows = [(i, "2020-01-05 00:00:00", i % 4, i % 3, 1, 1, 1, "x" if i % 7 == 0 else "1.00") for i in range(200)]
    rows += [(5, "2020-01-05 00:00:00", 1, None if i % 2 else 1, 1, 1, 1, "1.00") for i in range(hot)]
    return spark.createDataFrame(rows, LANDING["transactions"])


def dims_of(spark):
    return {t: spark.createDataFrame([(k,) for k in DIMS[t]], f"{key} long") for t, key in quality.FACT_KEYS.items()}


def counted(df):
    return {tuple(r) for r in df.groupBy(*df.columns).count().collect()}


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions_follow_the_input(spark, settings, sf_small, monkeypatch):
    """A fixed number of shuffle partitions lets a task's share grow with the input."""
    settings(adaptive__advisoryPartitionSizeInBytes="64MB")
    monkeypatch.setattr(session, "INPUT_PER_PARTITION", 4 << 10)
    size = sum(os.path.getsize(f"{sf_small}/{t}.parquet") for t in ("customer", "nation", "supplier", "orders", "part", "lineitem"))
    wh = warehouse(spark, sf_small + "/")
    wanted = -(-size // (4 << 10))
    assert wanted > 8 and session.partitions_for(spark, size) == wanted
    text = registry.testdata.landing_table(spark, sf_small, "transactions")._jdf.queryExecution().executedPlan().toString()
    assert f", {wanted}), ENSURE_REQUIREMENTS" in text, text
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(session.MERGED_PARTITION)
    # a smaller input takes the session's own number again
    monkeypatch.setattr(session, "INPUT_PER_PARTITION", 1 << 40)
    assert warehouse(spark, sf_small) is wh
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None


def test_marks_move_no_keys_of_sound_rows(spark, settings):
    """Ids are too many for a broadcast, lacking keys are not: no mark crosses a join's exchange."""
    fact, dims = facts(spark), dims_of(spark)
    before = counted(quality.rejected_marks(fact, dims))
    settings(autoBroadcastJoinThreshold="16")
    st = Stager(spark, "t_marks")
    faulty = st.put(quality.faulty_keys(fact, dims), "faulty")
    assert not st.fits_broadcast("faulty")
    marks = quality.rejected_marks(fact, dims, lambda df, name: faulty if name == "missing_keys" else df, st.fits_lookup)
    text = plan(marks)
    assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text, text
    assert counted(marks) == before
    # 5,000 of the copies miss a key and are no copies; the row that was there is one
    assert (5, "transactions", 5, 5001) in before and (5, "missing", None, 5000) in before


def test_marks_of_keys_too_many_to_broadcast(spark, settings):
    fact, dims = facts(spark), dims_of(spark)
    before = counted(quality.rejected_marks(fact, dims))
    some = lambda rows: rows < 2
    st = Stager(spark, "t_marks_some")
    assert counted(quality.rejected_marks(fact, dims, st.stage, some)) == before
    settings(autoBroadcastJoinThreshold="-1")
    assert not st.fits_lookup(0)
    assert counted(quality.cleanse_transactions(fact, dims, st.stage, fits=st.fits_lookup)) == counted(
        quality.cleanse_transactions(fact, dims))


def test_bitmaps_do_not_cross_an_exchange_while_built(spark):
    """4 KiB a row: what moves to build one are its different positions."""
    fact = spark.range(3000).selectExpr(
        "id AS transaction_id", "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(CAST(id % 90 AS INT)) AS timestamp",
        "id % 700 * 1000 AS customer_id", "id % 3 AS employee_id")
    bitmaps = distinct_state.monthly_bitmaps(fact, "monthly_employee")
    text = plan(bitmaps).split("== Initial Plan ==")[0]
    below = text[text.index("partial_bitmap_construct_agg"):]
    assert "Exchange" not in text[:text.index("partial_bitmap_construct_agg")] and "Exchange" in below
    exact = {(r[0], r[1]): r[2] for r in fact.groupBy("employee_id", "customer_id").count().groupBy("employee_id").count()
             .selectExpr("'2020'", "employee_id", "count").collect()}
    for partitions in (None, 1, distinct_state.merge_partitions(100_000)):
        out = distinct_state.distinct_in_periods(bitmaps, "monthly_employee", "yearly", partitions)
        assert {(r[0], r[1]): r[2] for r in out.collect()} == exact
    assert distinct_state.merge_partitions(0) == 1 and distinct_state.merge_partitions(100_000) == 7


def test_streamed_files_stay_of_a_size(spark, sf_small, monkeypatch):
    assert registry._stream_files(spark, sf_small) == 4
    monkeypatch.setattr(registry, "INPUT_PER_PARTITION", 1 << 10)
    size = sum(os.path.getsize(f"{sf_small}/{t}.parquet") for t in ("lineitem", "orders"))
    assert registry._stream_files(spark, sf_small) == -(-size // (1 << 10)) > 4


def test_typed_rows_cross_the_exchange(spark, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    out = quality.cleanse_transactions(facts(spark), dims_of(spark))
    assert out.schema == typed("transactions")
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("LeftAnti") < text.index("total_amount")
