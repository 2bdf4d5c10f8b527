"""Data-quality rules: order of rules, drop-all duplicates, NULL logic."""

from pyspark.sql import functions as F

from salesmart.operators import quality
from salesmart.schemas import LANDING


def fact_rows(spark, rows):
    return spark.createDataFrame(rows, LANDING["transactions"])


def dims(spark, customers=(1,), products=(1,), employees=(1,), payments=(1,)):
    def one(name, ids):
        key = quality.FACT_KEYS[name]
        return spark.createDataFrame([(i,) for i in ids], f"{key} long")
    return {"customers": one("customers", customers), "products": one("products", products),
            "employees": one("employees", employees), "payments": one("payments", payments)}


def ok(tid, amount="10.00", ts="2020-01-05 00:00:00", cust=1, prod=1, emp=1, pay=1):
    return (tid, ts, cust, prod, emp, pay, 1, amount)


def ids(df):
    return sorted(r[0] for r in df.select("transaction_id").collect())


def test_duplicates_drop_every_copy(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")],
                               "k long, v string")
    out = quality.drop_all_duplicates(df, ["k"])
    # both copies of 1 go; NULL keys never compare TRUE, so they stay
    got = sorted(((r.k is None, r.k or 0, r.v) for r in out.collect()))
    assert got == [(False, 2, "c"), (True, 0, "d"), (True, 0, "e")]


def test_null_rule_runs_before_duplicate_rule(spark):
    # the NULL-bearing copy of 7 is removed first, so its clean twin survives
    f = fact_rows(spark, [ok(7), ok(7)[:2] + (None,) + ok(7)[3:], ok(8)])
    out = quality.cleanse_transactions(f, dims(spark))
    assert ids(out) == [7, 8]


def test_invalid_copy_takes_valid_twin_down(spark):
    # duplicate rule runs before the invalid rule: both copies of 9 go
    f = fact_rows(spark, [ok(9), ok(9, amount="abc"), ok(10)])
    assert ids(quality.cleanse_transactions(f, dims(spark))) == [10]


def test_invalid_values(spark):
    f = fact_rows(spark, [ok(1, amount="-5.00"), ok(2, amount="abc"), ok(3, ts="2020-13-45"),
                          ok(4, amount="0.00"), ok(5, ts="2020-02-03")])
    out = quality.cleanse_transactions(f, dims(spark))
    assert ids(out) == [4, 5]
    row = out.where("transaction_id = 5").first()
    assert str(row.timestamp) == "2020-02-03 00:00:00"


def test_orphans_removed_and_reported(spark):
    f = fact_rows(spark, [ok(1), ok(2, pay=99), ok(3, cust=5, prod=6)])
    d = dims(spark)
    assert ids(quality.cleanse_transactions(f, d)) == [1]
    rep = quality.referential_orphans(f, d)
    got = sorted((r.transaction_id, r.dimension, r.key_value) for r in rep.collect())
    assert got == [(2, "payments", 99), (3, "customers", 5), (3, "products", 6)]


def test_empty_dimension_removes_every_fact(spark):
    f = fact_rows(spark, [ok(1), ok(2)])
    assert ids(quality.cleanse_transactions(f, dims(spark, payments=()))) == []


def test_quantity_is_not_required(spark):
    row = ok(1)
    f = fact_rows(spark, [row[:6] + (None,) + row[7:]])
    assert ids(quality.cleanse_transactions(f, dims(spark))) == [1]


def test_products_zero_price_kept_negative_and_text_removed(spark):
    p = spark.createDataFrame([(1, "a", "c", "0.00"), (2, "b", "c", "-1.00"),
                               (3, "c", "c", "n/a"), (4, "d", "c", "5.50"),
                               (5, "e", "c", None)], LANDING["products"])
    out = quality.cleanse_dimension(p, "products")
    assert sorted(r.product_id for r in out.collect()) == [1, 4]
    assert dict(out.dtypes)["unit_price"] == "decimal(10,2)"


def test_customer_city_not_required(spark):
    c = spark.createDataFrame(
        [(1, "a", "b", None, "S", 1, "e", "p"), (2, "a", "b", "X", "S", 1, None, "p")],
        LANDING["customers"])
    assert [r.customer_id for r in quality.cleanse_dimension(c, "customers").collect()] == [1]


def test_cleansing_is_idempotent(spark):
    f = fact_rows(spark, [ok(1), ok(1), ok(2, amount="abc"), ok(3)])
    once = quality.cleanse_transactions(f, dims(spark))
    again_in = once.select(*[F.col(c).cast(t.dataType).alias(c) for c, t in
                             zip(once.columns, LANDING["transactions"].fields)])
    twice = quality.cleanse_transactions(again_in, dims(spark))
    assert ids(once) == ids(twice) == [3]


def test_reject_reasons_first_rule_wins(spark):
    f = fact_rows(spark, [ok(1), ok(1), ok(2)[:2] + (None,) + ok(2)[3:], ok(3, amount="abc"),
                          ok(4, pay=42), ok(5)])
    rej = quality.reject_reasons(f, "transactions", dims(spark))
    got = sorted((r.transaction_id, r.reason) for r in rej.collect())
    assert got == [(1, "duplicate"), (1, "duplicate"), (2, "missing"), (3, "invalid"),
                   (4, "orphan")]
    counts = {(r.table_name, r.reason): r.rejected_rows
              for r in quality.reject_counts(rej).collect()}
    assert counts[("transactions", "duplicate")] == 2


def test_result_independent_of_partitioning_and_order(spark, sf_small):
    from salesmart.plans.warehouse import Warehouse
    from salesmart.schemas import DIMENSIONS
    wh = Warehouse(spark, sf_small, "all", materialize=False)
    fact = wh.landing("transactions")
    dims = {d: wh.clean(d) for d in DIMENSIONS}
    a = quality.cleanse_transactions(fact.coalesce(1), dims)
    b = quality.cleanse_transactions(fact.repartition(7).orderBy(F.rand(5)), dims)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0
