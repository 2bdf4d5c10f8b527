"""Ad-hoc SQL: what may run, what is refused, errors as text."""

import pytest

from salesmart.plans import adhoc
from salesmart.plans.adhoc import QueryError, answer, fetch, run_sql, schema_catalog
from salesmart.plans.warehouse import Warehouse, warehouse

ANSWERED = [
    "SELECT count(*) AS n FROM payments; ",
    "WITH t AS (SELECT payment_id, sum(total_amount) AS s FROM transactions GROUP BY 1) "
    "SELECT p.payment_type, t.s FROM t JOIN payments p USING (payment_id) WHERE t.s > (SELECT avg(s) FROM t)",
    "SELECT payment_type, row_number() OVER (ORDER BY payment_id) AS r FROM payments "
    "WHERE payment_id IN (SELECT payment_id FROM transactions) AND EXISTS (SELECT 1 FROM customers)",
    "SELECT * FROM YEARLY_PAYMENT", "SELECT 1 AS x UNION ALL SELECT 2", "SELECT * FROM (VALUES (1), (2)) v(a)",
]
FILE = "text.`/etc/hostname`"
REFUSED = [
    "SELECT reflect('java.lang.System', 'setProperty', 'probe', 'set')",
    "SELECT transform(array(1), x -> reflect('java.lang.System', 'setProperty', 'probe', 'set'))",
    "SELECT sum(payment_id) FILTER (WHERE reflect('a', 'b') = 'x') FROM payments",
    "SELECT * FROM payments LATERAL VIEW explode(array(java_method('a', 'b'))) t AS z",
    "SELECT * FROM payments ORDER BY try_reflect('a', 'b')",
    f"SELECT * FROM {FILE}", f"SELECT (SELECT max(value) FROM {FILE})", f"WITH t AS (SELECT * FROM {FILE}) SELECT * FROM t",
    f"SELECT * FROM payments WHERE EXISTS (SELECT 1 FROM {FILE})", f"SELECT 1 WHERE 'a' IN (SELECT value FROM {FILE})",
    "SELECT * FROM IDENTIFIER('text.`/etc/hostname`')", "SELECT IDENTIFIER('reflect')('a', 'b')",
    "SELECT * FROM range(10)", "SELECT input_file_name() FROM payments", "SELECT current_user()",
    "SELECT TRANSFORM(payment_id) USING 'cat' FROM payments", "SELECT * FROM IPQueryTracking",
    "SELECT * FROM spark_catalog.salesmart_stage.payments", "DROP TABLE payments", "SELECT 1; DROP TABLE t",
    "INSERT INTO payments SELECT 1, 'x'", "SELECT nothing FROM payments", "SELEC", "",
]
FAILING = ["SELECT 1/0 AS x", "SELECT CAST(payment_type AS INT) AS x FROM payments", "SELECT payment_id / 0 AS x FROM payments"]


@pytest.mark.parametrize("text", ANSWERED)
def test_queries_are_answered(spark, sf_small, text):
    got = answer(warehouse(spark, sf_small), text)
    assert got["error"] is None and got["results"] and got["sql_query"] == text


@pytest.mark.parametrize("text", REFUSED)
def test_what_is_no_query_over_the_views_is_refused(spark, sf_small, text):
    wh = warehouse(spark, sf_small)
    with pytest.raises(QueryError):
        run_sql(wh, text)
    got = answer(wh, text)
    assert got["results"] == [] and got["error"]
    assert spark._jvm.java.lang.System.getProperty("probe") is None


@pytest.mark.parametrize("text", FAILING)
def test_errors_while_running_are_text(spark, sf_small, text):
    wh = warehouse(spark, sf_small)
    with pytest.raises(QueryError):
        fetch(wh, text)
    error = answer(wh, text)["error"]
    assert error and "Traceback" not in error and "at org.apache" not in error


def test_views_are_built_when_named_and_stay_in_the_child_session(spark, sf_small):
    wh = Warehouse(spark, sf_small, "fact")
    assert fetch(wh, "SELECT count(*) AS n FROM payments") == [{"n": 5}]
    assert "clean_payments" in wh._tables and "clean_transactions" not in wh._tables
    assert "payments" not in {t.name for t in spark.catalog.listTables()}
    assert fetch(wh, "SELECT count(*) AS n FROM payments", limit=1) == [{"n": 5}]


def test_catalog_lists_what_can_be_asked(spark, sf_small):
    wh = warehouse(spark, sf_small)
    catalog = schema_catalog()
    assert set(catalog) == set(adhoc.view_names())
    for name in ("yearly_employee", "quarterly_payment"):
        assert run_sql(wh, f"SELECT * FROM {name}").columns == catalog[name].fieldNames()
