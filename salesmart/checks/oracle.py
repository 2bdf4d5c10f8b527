"""DuckDB SQL oracle for every registered query.

Written from the rules and independently of the Spark code: a row stays if it
is complete, if its key is counted once among the complete rows, if its values
fit their typed columns whole, and if every dimension row it names exists.
Metrics join first and aggregate after.  The test-table mapping repeats
``FIXTURES.md``.
Tables visible to DuckDB: the driver's parquet tables as views.
"""

from __future__ import annotations

# ---------------------------------------------------------------- landing


def _landing(faults: str) -> list[str]:
    dims = faults == "all"
    fact = faults != "none"
    email = "lower(c.c_name) || '@example.com'"
    if dims:
        email = f"CASE WHEN c.c_custkey % 97 = 0 THEN NULL ELSE {email} END"
    city = "CASE WHEN s.s_suppkey % 31 = 0 THEN NULL ELSE n.n_name END" if dims else "n.n_name"
    price = "CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) AS VARCHAR)"
    if dims:
        price = (f"CASE WHEN p.p_partkey % 83 = 0 THEN '-1.00' WHEN p.p_partkey % 79 = 0 "
                 f"THEN 'n/a' WHEN p.p_partkey % 73 = 0 THEN '0.00' ELSE {price} END")
    tid = "(l.l_orderkey * 10 + l.l_linenumber)"
    ts = "CAST(o.o_orderdate AS VARCHAR)"
    cust = "o.o_custkey"
    pay = "CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT)"
    amt = "CAST(CAST(l.l_extendedprice AS DECIMAL(10,2)) AS VARCHAR)"
    if fact:
        ts = f"CASE WHEN {tid} % 113 = 0 THEN '2020-13-45' ELSE {ts} END"
        cust = f"CASE WHEN {tid} % 101 = 0 THEN NULL ELSE {cust} END"
        pay = f"CASE WHEN {tid} % 109 = 0 THEN 99 ELSE {pay} END"
        amt = (f"CASE WHEN {tid} % 107 = 0 THEN 'abc' WHEN {tid} % 103 = 0 THEN '-5.00' "
               f"ELSE {amt} END")
    rep = "UNION ALL SELECT * FROM {b} WHERE {k} % {m} = 0" if dims else ""
    payments_extra = ("UNION ALL SELECT * FROM (VALUES (6::BIGINT, NULL::VARCHAR), "
                      "(7::BIGINT, 'GIFT'), (7::BIGINT, 'GIFT')) v(payment_id, payment_type)"
                      if dims else "")
    return [
        f"""base_customers AS (
  SELECT c.c_custkey AS customer_id, split_part(c.c_name, '#', 1) AS customer_first_name,
         split_part(c.c_name, '#', 2) AS customer_last_name, c.c_mktsegment AS customer_city,
         n.n_name AS customer_state, CAST(c.c_nationkey AS INTEGER) AS customer_postal,
         {email} AS customer_email, CAST(c.c_custkey AS VARCHAR) AS customer_phone
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
        f"""land_customers AS (SELECT * FROM base_customers
  {rep.format(b='base_customers', k='customer_id', m=89)})""",
        f"""base_employees AS (
  SELECT s.s_suppkey AS employee_id, s.s_name AS employee_name,
         CAST(s.s_suppkey AS VARCHAR) AS employee_ssn, CAST(s.s_suppkey AS VARCHAR) AS employee_phone,
         n.n_name AS employee_state, {city} AS employee_city,
         CAST(s.s_nationkey AS INTEGER) AS employee_postal
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)""",
        f"""land_employees AS (SELECT * FROM base_employees
  {rep.format(b='base_employees', k='employee_id', m=29)})""",
        f"""land_payments AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS payment_id,
         substr(o_orderpriority, 3) AS payment_type
  FROM (SELECT DISTINCT o_orderpriority FROM orders) d
  {payments_extra})""",
        f"""base_products AS (
  SELECT p.p_partkey AS product_id, p.p_name AS product_name, p.p_type AS product_category,
         {price} AS unit_price
  FROM part p)""",
        f"""land_products AS (SELECT * FROM base_products
  {rep.format(b='base_products', k='product_id', m=71)})""",
        f"""land_transactions AS (
  SELECT {tid} AS transaction_id, {ts} AS "timestamp", {cust} AS customer_id,
         l.l_partkey AS product_id, l.l_suppkey AS employee_id, {pay} AS payment_id,
         CAST(trunc(l.l_quantity) AS INTEGER) AS quantity, {amt} AS total_amount
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
    ]


# ---------------------------------------------------------------- cleanse

# Columns that must be filled.
_REQUIRED = {
    "customers": ["customer_id", "customer_email", "customer_first_name", "customer_last_name",
                  "customer_phone", "customer_postal", "customer_state"],
    "employees": ["employee_id", "employee_city", "employee_name", "employee_phone",
                  "employee_postal", "employee_ssn", "employee_state"],
    "payments": ["payment_id", "payment_type"],
    "products": ["product_id", "product_name", "product_category", "unit_price"],
    "transactions": ["transaction_id", '"timestamp"', "total_amount", "customer_id",
                     "product_id", "employee_id", "payment_id"],
}
_KEY = {"customers": "customer_id", "employees": "employee_id", "payments": "payment_id",
        "products": "product_id", "transactions": "transaction_id"}
_TYPED = {
    "customers": "customer_id, customer_first_name, customer_last_name, customer_city, "
                 "customer_state, customer_postal, customer_email, customer_phone",
    "employees": "employee_id, employee_name, employee_ssn, employee_phone, employee_state, "
                 "employee_city, employee_postal",
    "payments": "payment_id, payment_type",
    "products": "product_id, product_name, product_category, "
                "CAST(unit_price AS DECIMAL(10,2)) AS unit_price",
    "transactions": 'transaction_id, CAST("timestamp" AS TIMESTAMP) AS "timestamp", '
                    "customer_id, product_id, employee_id, payment_id, quantity, "
                    "CAST(total_amount AS DECIMAL(10,2)) AS total_amount",
}


def _money_fits(c: str) -> str:
    """Plain decimal text, not negative before rounding, within DECIMAL(10,2)."""
    return (f"(regexp_full_match(trim(CAST({c} AS VARCHAR)), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)') "
            f"AND coalesce(TRY_CAST(trim({c}) AS DECIMAL(38,10)) >= 0, false) "
            f"AND TRY_CAST(trim({c}) AS DECIMAL(10,2)) IS NOT NULL)")


_TIME_FITS = 'TRY_CAST("timestamp" AS TIMESTAMP) IS NOT NULL'

_VALUES_FIT = {"products": _money_fits("unit_price"),
               "transactions": f"{_TIME_FITS} AND {_money_fits('total_amount')}"}


def _cleanse(table: str) -> list[str]:
    """CTEs <table>_s1 (complete), _s2 (unique), _s3 (values fit), clean_<table>."""
    k = _KEY[table]
    complete = " AND ".join(f"{c} IS NOT NULL" for c in _REQUIRED[table])
    ctes = [
        f"{table}_s1 AS (SELECT * FROM land_{table} WHERE {complete})",
        f"{table}_s2 AS (SELECT * FROM {table}_s1 QUALIFY count(*) OVER (PARTITION BY {k}) = 1)",
        f"{table}_s3 AS (SELECT * FROM {table}_s2 WHERE {_VALUES_FIT.get(table, 'true')})",
    ]
    known = "true"
    if table == "transactions":
        known = " AND ".join(f"EXISTS (SELECT 1 FROM clean_{d} d WHERE d.{key} = r.{key})"
                             for d, key in _KEY.items() if d != "transactions")
    ctes.append(f"clean_{table} AS (SELECT {_TYPED[table]} FROM {table}_s3 r WHERE {known})")
    return ctes


def _with(faults: str, tables=("customers", "employees", "payments", "products",
                               "transactions"), extra: list[str] | None = None) -> str:
    ctes = _landing(faults)
    for t in tables:
        ctes += _cleanse(t)
    ctes += extra or []
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- metrics

_MONTH = "strftime(\"timestamp\", '%Y-%m')"


def _metric(name: str, dim: str, attribute: str, lines: str, money: str, customers: str | None = None) -> str:
    """Per month and dimension row: lines, money and perhaps distinct customers."""
    key = _KEY[dim]
    extra = f", CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS {customers}" if customers else ""
    return f"""{name} AS (
  SELECT month_year, {attribute}, {key}, CAST(COUNT(*) AS BIGINT) AS {lines},
         CAST(SUM(total_amount) AS DECIMAL(18,2)) AS {money}{extra}
  FROM (SELECT *, {_MONTH} AS month_year FROM clean_transactions) NATURAL JOIN
       (SELECT {key}, {attribute} FROM clean_{dim}) GROUP BY ALL)"""


_MONTHLY = {
    "monthly_customer": _metric("monthly_customer", "customers", "customer_state",
                                "total_products_bought", "total_money_spent"),
    "monthly_employee": _metric("monthly_employee", "employees", "employee_state",
                                "total_products_sold", "total_money_made", "unique_customers_serviced"),
    "monthly_payment": _metric("monthly_payment", "payments", "payment_type",
                               "total_times_used", "total_revenue", "unique_customer_usage"),
    "monthly_product": _metric("monthly_product", "products", "product_category",
                               "products_sold", "total_money_made"),
}

_DAY = "strptime(month_year || '-01', '%Y-%m-%d')"
_QLABEL = f"strftime({_DAY}, '%Y') || '-Q' || quarter({_DAY})"
_YLABEL = f"strftime({_DAY}, '%Y')"

_ROLLUP = {  # entity: (monthly table, dims, sums, money)
    "customer": ("monthly_customer", ["customer_state", "customer_id"],
                 ["total_products_bought", "total_money_spent"]),
    "employee": ("monthly_employee", ["employee_state", "employee_id"],
                 ["unique_customers_serviced", "total_products_sold", "total_money_made"]),
    "payment": ("monthly_payment", ["payment_id", "payment_type"],
                ["total_times_used", "total_revenue"]),
    "product": ("monthly_product", ["product_category", "product_id"],
                ["products_sold", "total_money_made"]),
}
_MONEY = {"total_money_spent", "total_money_made", "total_revenue"}


def monthly(name: str, faults: str = "fact") -> str:
    return _with(faults, extra=[_MONTHLY[name]]) + f"SELECT * FROM {name}"


def monthly_customer_avg() -> str:
    """Average per line, rounded half-up to cents with exact integer arithmetic."""
    return (_with("fact", extra=[_MONTHLY["monthly_customer"]])
            + """SELECT *, CAST(CAST((2 * CAST(total_money_spent * 100 AS HUGEINT)
                + total_products_bought) // (2 * total_products_bought) AS DECIMAL(18,0)) * 0.01
            AS DECIMAL(18,2)) AS avg_total_money_spent_per_line
FROM monthly_customer""")


def rollup(entity: str, period: str, faults: str = "fact") -> str:
    src, dims, sums = _ROLLUP[entity]
    label, expr = ("quarter_year", _QLABEL) if period == "quarterly" else ("year", _YLABEL)
    cols = ", ".join(
        f"CAST(SUM({m}) AS {'DECIMAL(18,2)' if m in _MONEY else 'BIGINT'}) AS {m}" for m in sums)
    return (_with(faults, extra=[_MONTHLY[src]])
            + f"SELECT {expr} AS {label}, {', '.join(dims)}, {cols}\nFROM {src}\n"
            + "GROUP BY ALL")


def dq_table(table: str, faults: str) -> str:
    tables = [table] if table != "transactions" else None
    if tables:
        return _with(faults, tables) + f"SELECT * FROM clean_{table}"
    return _with(faults) + "SELECT * FROM clean_transactions"


def dedupe_drop_all() -> str:
    return """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1"""


def value_edges() -> str:
    """The edge values of testdata.value_edges against the value rules."""
    return f"""WITH edges AS (
  SELECT l_orderkey * 10 + l_linenumber AS transaction_id,
         CASE l_partkey % 9 WHEN 0 THEN '123456789.00' WHEN 1 THEN '-0.004' WHEN 2 THEN '1e3'
              WHEN 3 THEN CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) || ' junk'
              WHEN 4 THEN '99999999.99' WHEN 5 THEN ''
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) END AS total_amount,
         CASE l_suppkey % 4 WHEN 0 THEN '2020-01-05 25:99 junk' WHEN 1 THEN '2020-02-30'
              WHEN 2 THEN '2020-01-05' ELSE '2020-01-05 10:11:12' END AS "timestamp"
  FROM lineitem)
SELECT transaction_id, NOT ({_VALUES_FIT['transactions']}) AS rejected,
       NOT {_money_fits('total_amount')} AS price_rejected FROM edges"""


def without_last_month(name: str) -> str:
    return (_with("fact", extra=[_MONTHLY[name]])
            + f"SELECT * FROM {name} WHERE month_year < (SELECT max(month_year) FROM {name})")


def ref_orphans() -> str:
    ctes = _landing("all")
    for t in ("customers", "employees", "payments", "products", "transactions"):
        ctes += _cleanse(t)
    parts = [f"SELECT transaction_id, '{t}' AS dimension, {k} AS key_value FROM transactions_s3 r "
             f"WHERE NOT EXISTS (SELECT 1 FROM clean_{t} d WHERE d.{k} = r.{k})"
             for t, k in _KEY.items() if t != "transactions"]
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(parts)


def reject_counts() -> str:
    """Rows removed per table and first failing rule, via stage counts."""
    ctes = _landing("all")
    for t in ("customers", "employees", "payments", "products", "transactions"):
        ctes += _cleanse(t)
    parts = []
    for t in ("customers", "employees", "payments", "products", "transactions"):
        parts.append(f"SELECT '{t}' AS table_name, 'missing' AS reason, "
                     f"(SELECT count(*) FROM land_{t}) - (SELECT count(*) FROM {t}_s1) AS n")
        parts.append(f"SELECT '{t}', 'duplicate', "
                     f"(SELECT count(*) FROM {t}_s1) - (SELECT count(*) FROM {t}_s2)")
    parts.append("SELECT 'products', 'invalid', "
                 "(SELECT count(*) FROM products_s2) - (SELECT count(*) FROM products_s3)")
    parts.append("SELECT 'transactions', 'invalid', "
                 "(SELECT count(*) FROM transactions_s2) - (SELECT count(*) FROM transactions_s3)")
    parts.append("SELECT 'transactions', 'orphan', "
                 "(SELECT count(*) FROM transactions_s3) - (SELECT count(*) FROM clean_transactions)")
    body = "\nUNION ALL\n".join(parts)
    return ("WITH " + ",\n".join(ctes) + "\nSELECT table_name, reason, "
            "CAST(n AS BIGINT) AS rejected_rows FROM (\n" + body + "\n) r WHERE n > 0")


def rejects() -> str:
    """Row-level rejects as multiset differences between rule stages."""
    ctes = _landing("all")
    for t in ("customers", "employees", "payments", "products", "transactions"):
        ctes += _cleanse(t)
    parts = []
    for t in ("customers", "employees", "payments", "products", "transactions"):
        k = _KEY[t]
        stages = [("missing", f"land_{t}", f"{t}_s1"), ("duplicate", f"{t}_s1", f"{t}_s2")]
        if t == "products":
            stages.append(("invalid", "products_s2", "products_s3"))
        if t == "transactions":
            stages += [("invalid", "transactions_s2", "transactions_s3"),
                       ("orphan", "transactions_s3", "clean_transactions")]
        for reason, before, after in stages:
            parts.append(f"SELECT '{t}' AS table_name, {k} AS key_value, '{reason}' AS reason "
                         f"FROM (SELECT {k} FROM {before} EXCEPT ALL SELECT {k} FROM {after}) d")
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(parts)


def employee_exact(period: str) -> str:
    """True distinct customers per employee and quarter / year, from the fact."""
    label, expr = "year", "strftime(t.\"timestamp\", '%Y')"
    if period != "yearly":
        label, expr = "quarter_year", expr + " || '-Q' || quarter(t.\"timestamp\")"
    return _with("fact") + f"""SELECT {expr} AS {label}, e.employee_state,
       e.employee_id, CAST(COUNT(DISTINCT t.customer_id) AS BIGINT) AS unique_customers_serviced,
       CAST(COUNT(t.product_id) AS BIGINT) AS total_products_sold,
       CAST(SUM(t.total_amount) AS DECIMAL(18,2)) AS total_money_made
FROM clean_transactions t JOIN clean_employees e ON t.employee_id = e.employee_id
GROUP BY ALL"""


def payment_exact(period: str) -> str:
    """True distinct customers per payment type and quarter / year, from the fact."""
    label, expr = "year", "strftime(\"timestamp\", '%Y')"
    if period != "yearly":
        label, expr = "quarter_year", expr + " || '-Q' || quarter(\"timestamp\")"
    return _with("fact") + f"""SELECT {expr} AS {label}, payment_id, payment_type,
       CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS unique_customer_usage,
       CAST(COUNT(*) AS BIGINT) AS total_times_used, CAST(SUM(total_amount) AS DECIMAL(18,2)) AS total_revenue
FROM clean_transactions NATURAL JOIN clean_payments GROUP BY ALL"""


def employee_distinct_within_error() -> str:
    return _with("fact") + """SELECT strftime("timestamp", '%Y') AS year, employee_id,
       CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS unique_customers_serviced, true AS within_error
FROM clean_transactions GROUP BY ALL"""


def kpi_period_totals() -> str:
    return _with("fact") + f""", m AS (SELECT strftime("timestamp", '%Y-%m') AS month_year,
  count(*) AS n, sum(total_amount) AS amt FROM clean_transactions GROUP BY 1)
SELECT 'month' AS grain, month_year AS period, CAST(n AS BIGINT) AS transactions,
       CAST(amt AS DECIMAL(18,2)) AS total_amount FROM m
UNION ALL
SELECT 'quarter', {_QLABEL}, CAST(sum(n) AS BIGINT), CAST(sum(amt) AS DECIMAL(18,2))
FROM m GROUP BY {_QLABEL}
UNION ALL
SELECT 'year', {_YLABEL}, CAST(sum(n) AS BIGINT), CAST(sum(amt) AS DECIMAL(18,2))
FROM m GROUP BY {_YLABEL}"""


def kpi_first_seen_customers() -> str:
    return _with("fact") + """SELECT strftime(first_ts, '%Y-%m') AS month_year,
       CAST(count(*) AS BIGINT) AS new_customers
FROM (SELECT customer_id, min("timestamp") AS first_ts FROM clean_transactions
      GROUP BY customer_id) f
GROUP BY 1"""


# ---------------------------------------------------------------- side datasets

_LOG = """log AS (SELECT CAST(user_id AS VARCHAR) AS client, ts, event_id AS request_id,
                 CAST(ts AS DATE) AS day FROM events)"""


def quota_admission(limit: int) -> str:
    return f"""WITH {_LOG}
SELECT client, request_id, ts, day,
       ROW_NUMBER() OVER (PARTITION BY client, day ORDER BY ts, request_id) <= {limit} AS admitted
FROM log"""


def quota_remaining(limit: int) -> str:
    return f"""WITH {_LOG}
SELECT client, day, CAST(count(*) AS BIGINT) AS requests,
       CAST(least(count(*), {limit}) AS BIGINT) AS admitted,
       CAST(greatest(0, {limit} - count(*)) AS BIGINT) AS remaining
FROM log GROUP BY client, day"""


def quota_remaining_as_of(as_of: str, limit: int) -> str:
    return f"""WITH {_LOG},
today AS (SELECT client, count(*) AS n FROM log WHERE day = DATE '{as_of}' GROUP BY client)
SELECT k.client, DATE '{as_of}' AS day,
       CAST(greatest(0, {limit} - coalesce(t.n, 0)) AS BIGINT) AS remaining
FROM (SELECT DISTINCT client FROM log) k LEFT JOIN today t ON k.client = t.client"""


def latest_run(now: str, pipelines: list[str]) -> str:
    names = ", ".join(f"'{p}'" for p in pipelines)
    return f"""WITH runs AS (SELECT event_type AS pipeline_name, CAST(value AS VARCHAR) AS status,
                   ts AS last_updated FROM events)
SELECT pipeline_name, arg_max(status, struct_pack(t := last_updated, s := status)) AS status,
       strftime(max(last_updated), '%Y-%m-%d %H:%M:%S') AS last_updated
FROM runs
WHERE pipeline_name IN ({names})
  AND last_updated BETWEEN TIMESTAMP '{now}' - INTERVAL 1 DAY AND TIMESTAMP '{now}' + INTERVAL 1 DAY
GROUP BY pipeline_name"""


def client_key() -> str:
    return """WITH h AS (
  SELECT event_id AS request_id,
         CASE WHEN event_id % 3 = 0 THEN '10.0.0.' || CAST(user_id AS VARCHAR) || ':443,10.1.1.1'
              WHEN event_id % 3 = 1 THEN '' END AS forwarded_for,
         CASE WHEN event_id % 2 = 0 THEN '10.2.0.' || CAST(user_id AS VARCHAR) END AS real_ip,
         '10.3.0.' || CAST(user_id AS VARCHAR) || ':8080' AS remote_addr
  FROM events)
SELECT request_id, forwarded_for, real_ip, remote_addr,
       split_part(CASE WHEN forwarded_for IS NOT NULL AND length(forwarded_for) > 0
                         THEN split_part(forwarded_for, ',', 1)
                       WHEN real_ip IS NOT NULL AND length(real_ip) > 0 THEN real_ip
                       ELSE remote_addr END, ':', 1) AS client_key
FROM h"""


# ---------------------------------------------------------------- previews, ad hoc


def preview_top5() -> str:
    return dq_table("transactions", "fact") + " ORDER BY transaction_id LIMIT 5"


def preview_first_n(n: int) -> str:
    """Header plus the first n-1 product rows, as raw CSV lines."""
    return _with("none", ["products"]) + f"""SELECT CAST(line_no AS BIGINT) AS line_no, line FROM (
  SELECT 1 AS line_no, 'product_id,product_name,product_category,unit_price' AS line
  UNION ALL
  SELECT 1 + ROW_NUMBER() OVER (ORDER BY product_id),
         concat_ws(',', CAST(product_id AS VARCHAR), product_name, product_category,
                   CAST(unit_price AS VARCHAR))
  FROM land_products) x WHERE line_no <= {n}"""


def all_product_lines() -> str:
    """Every product row as a CSV line, numbered by product."""
    return _with("none", ["products"]) + """SELECT ROW_NUMBER() OVER (ORDER BY product_id) AS line_no,
       concat_ws(',', CAST(product_id AS VARCHAR), product_name, product_category, unit_price) AS line
FROM land_products"""


ADHOC = {
    "adhoc_sql": """SELECT customer_state, CAST(SUM(total_money_spent) AS DECIMAL(18,2)) AS revenue,
       CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS customers
FROM monthly_customer GROUP BY customer_state""",
    "adhoc_top_products": """SELECT product_category, product_id,
       CAST(SUM(total_money_made) AS DECIMAL(18,2)) AS revenue
FROM monthly_product GROUP BY product_category, product_id
ORDER BY revenue DESC, product_id LIMIT 10""",
    "adhoc_payment_mix": """SELECT payment_type, CAST(SUM(total_times_used) AS BIGINT) AS times_used,
       CAST(SUM(total_revenue) AS DECIMAL(18,2)) AS revenue
FROM yearly_payment GROUP BY payment_type""",
}


def adhoc(name: str) -> str:
    extra = [_MONTHLY["monthly_customer"], _MONTHLY["monthly_product"],
             _MONTHLY["monthly_payment"]]
    src, dims, sums = _ROLLUP["payment"]
    cols = ", ".join(
        f"CAST(SUM({m}) AS {'DECIMAL(18,2)' if m in _MONEY else 'BIGINT'}) AS {m}" for m in sums)
    extra.append(f"yearly_payment AS (SELECT {_YLABEL} AS year, {', '.join(dims)}, {cols} "
                 f"FROM {src} GROUP BY {', '.join(dims)}, {_YLABEL})")
    return _with("fact", extra=extra) + ADHOC[name]


def appended_twice(name: str) -> str:
    return (_with("fact", extra=[_MONTHLY[name]])
            + f"SELECT * FROM {name} UNION ALL SELECT * FROM {name}")


# ---------------------------------------------------------------- landing files


def landed_after_replacement() -> str:
    """The files of ids divisible by 4 were landed again with even products only."""
    return ("WITH " + ",\n".join(_landing("none")) + "\nSELECT * FROM land_transactions "
            "WHERE transaction_id % 4 <> 0 OR product_id % 2 = 0")


def monthly_of_even_orders(name: str) -> str:
    """A metric after the line items were landed again without odd orders."""
    return monthly(name).replace("FROM lineitem l ", "FROM (SELECT * FROM lineitem WHERE l_orderkey % 2 = 0) l ")


def awkward_products() -> str:
    """Names with quotes, separators, line breaks and blanks, whatever the order of the columns."""
    return """SELECT p_partkey AS product_id,
       CASE p_partkey % 5 WHEN 0 THEN p_name || ', "M8"' WHEN 1 THEN p_name || chr(10) || 'second line'
            WHEN 2 THEN '"' || p_name || '"' WHEN 3 THEN '  ' || p_name || ' ' ELSE p_name END AS product_name,
       p_type AS product_category, CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) AS unit_price
FROM part"""


def bad_product_records() -> str:
    """Records of three and of five fields, and keys that are no numbers."""
    return """SELECT 'products' AS table_name, CASE WHEN p_partkey % 50 < 2 THEN 'malformed' ELSE 'unparsable' END AS reason,
       CASE WHEN p_partkey % 50 = 2 THEN 'product_id' END AS column_name,
       CASE p_partkey % 50 WHEN 0 THEN p_partkey || ',short,c' WHEN 1 THEN p_partkey || ',n,c,1.00,long'
            ELSE 'k' || p_partkey || ',n,c,1.00' END AS record
FROM part WHERE p_partkey % 50 < 3"""
