"""CSV landing by header, bad records, files landed again, fresh results after an input changed."""

import os

import pytest

from salesmart.schemas import LANDING
from salesmart.session import scratch_path
from salesmart.sources import csv_landing
from salesmart.sources.listing import fingerprint, list_files
from salesmart.streaming.ingest import ingest_changed, landed, taken_files


def folder(spark, name):
    path = scratch_path(spark, name, unique=True)
    os.makedirs(path)
    return path


def put(path, name, text):
    with open(os.path.join(path, name), "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


HEAD = "product_id,product_name,product_category,unit_price\n"


def test_quotes_line_breaks_and_reordered_headers(spark):
    path = folder(spark, "t_csv_quotes")
    put(path, "a.csv", HEAD + '1,"Bolt, ""M8""",x,1.00\n2,"two\nlines",y,2.00\n3,  kept  ,"",\n')
    put(path, "b.csv", "\ufeffunit_price, Product_Name,extra,PRODUCT_ID,product_category\n9.5,name,zz,7,cat\n")
    put(path, "empty.csv", "")
    put(path, "_hidden.csv", "nothing\n1\n")
    rows = csv_landing.read_landing_csv(spark, path, "products")
    assert rows.schema == LANDING["products"] and rows.count() == 4
    got = {r.product_id: tuple(r)[1:] for r in rows.collect()}
    assert got == {1: ('Bolt, "M8"', "x", "1.00"), 2: ("two\nlines", "y", "2.00"),
                   3: ("  kept  ", None, None), 7: ("name", "cat", "9.5")}


def test_short_long_and_unparsable_records(spark):
    path = folder(spark, "t_csv_bad")
    put(path, "a.csv", HEAD + "1,n,c,1.00\n2,short\n3,n,c,1.00,long\nk4,n,c,1.00\n,n,c,1.00\n")
    rows = csv_landing.read_landing_csv(spark, path, "products")
    assert sorted((r.product_id for r in rows.collect()), key=str) == [1, None, None]
    bad = csv_landing.bad_records(spark, path, "products")
    assert sorted((r.reason, r.column_name, r.record) for r in bad.collect()) == [
        ("malformed", None, "2,short"), ("malformed", None, "3,n,c,1.00,long"),
        ("unparsable", "product_id", "k4,n,c,1.00")]
    assert bad.count() == 3 and bad.select("source_file").distinct().count() == 1


def test_header_without_a_column_is_an_error(spark):
    path = folder(spark, "t_csv_header")
    put(path, "a.csv", "product_id,product_name,unit_price\n1,n,1.00\n")
    with pytest.raises(csv_landing.LandingError, match="no column product_category"):
        csv_landing.read_landing_csv(spark, path, "products")
    assert csv_landing.read_landing_csv(spark, folder(spark, "t_csv_none"), "products").count() == 0


def ids(spark, sink):
    return sorted(r.product_id for r in landed(spark, sink, "products").collect())


def test_replaced_files_replace_their_rows(spark):
    src, base = folder(spark, "t_relanding"), folder(spark, "t_relanded")
    sink = os.path.join(base, "products")
    assert ids(spark, sink) == [] and ingest_changed(spark, src, "products", sink) == 0
    put(src, "a b%.csv", HEAD + "1,n,c,1\n2,n,c,1\n")
    put(src, "b.csv", HEAD + "3,n,c,1\n")
    assert ingest_changed(spark, src, "products", sink, files_per_round=1) == 2
    assert ids(spark, sink) == [1, 2, 3]
    assert ingest_changed(spark, src, "products", sink) == 0        # nothing new
    put(src, "a b%.csv", HEAD + "10,n,c,1\n")                       # landed again
    put(src, "c.csv", HEAD + "4,n,c,1\n")
    assert ingest_changed(spark, src, "products", sink) == 2
    assert ids(spark, sink) == [3, 4, 10]
    put(src, "a b%.csv", HEAD)                                      # now without rows
    assert ingest_changed(spark, src, "products", sink) == 1
    assert ids(spark, sink) == [3, 4]
    os.remove(os.path.join(src, "b.csv"))
    assert ingest_changed(spark, src, "products", sink) == 0 and ids(spark, sink) == [3, 4]
    assert ingest_changed(spark, src, "products", sink, drop_removed=True) == 1 and ids(spark, sink) == [4]
    assert len(taken_files(spark, sink)) == 2
    assert len(list_files(spark, src)) == 2


def test_a_run_that_failed_before_its_ledger_can_run_again(spark, monkeypatch):
    from salesmart.streaming import ingest
    src, sink = folder(spark, "t_retry"), os.path.join(folder(spark, "t_retry_out"), "products")
    put(src, "a.csv", HEAD + "1,n,c,1\n")

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(ingest, "_record", lost)
        with pytest.raises(RuntimeError):
            ingest_changed(spark, src, "products", sink)
    assert ingest_changed(spark, src, "products", sink) == 1 and ids(spark, sink) == [1]


def test_fingerprint_and_memo_follow_the_files(spark, sf_small):
    from salesmart.plans.warehouse import warehouse
    from salesmart.sources import testdata
    path = folder(spark, "t_memo")
    before = fingerprint(spark, path)
    for t in testdata.SOURCES:
        spark.read.parquet(f"{sf_small}/{t}.parquet").write.parquet(f"{path}/{t}.parquet")
    assert fingerprint(spark, path) != before
    wh = warehouse(spark, path)
    assert warehouse(spark, path) is wh
    spark.read.parquet(f"{sf_small}/orders.parquet").limit(10).write.mode("overwrite").parquet(f"{path}/orders.parquet")
    assert warehouse(spark, path) is not wh
    assert testdata.read(spark, path, "orders").count() == 10


def test_malformed_records_are_rejects(spark):
    from salesmart.plans.warehouse import from_csv
    path = folder(spark, "t_csv_rejects")
    for table, schema in LANDING.items():
        os.makedirs(os.path.join(path, table))
        put(os.path.join(path, table), "a.csv", ",".join(schema.fieldNames()) + "\n" + ("1,CASH\n2,CARD,long\n3\n" if table == "payments" else ""))
    wh = from_csv(spark, path)
    assert [r.payment_id for r in wh.clean("payments").collect()] == [1]
    assert sorted((r.table_name, r.key_value, r.reason) for r in wh.rejects().collect()) == [("payments", None, "malformed")] * 2
