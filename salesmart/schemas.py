"""Table schemas of the sales star schema.

Two layers per base table:

* **landing** -- what a CSV upload holds after Spark's reader applied the
  schema.  Keys and counts are already numeric (a non-numeric key becomes
  NULL and is removed by the missing-value rule), but the columns that the
  invalid-value rule inspects (``timestamp``, ``total_amount``,
  ``unit_price``) stay strings so that rule can ``try_cast`` them itself.
  Running the NULL and duplicate rules *before* that cast is what keeps the
  original rule order meaningful.
* **typed** -- the cleansed table.
"""

from __future__ import annotations

from pyspark.sql import types as T

LONG, INT, STR = T.LongType(), T.IntegerType(), T.StringType()
MONEY = T.DecimalType(10, 2)        # unit and line amounts
TOTAL = T.DecimalType(18, 2)        # every aggregated amount
TS = T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


LANDING = {
    "customers": _struct(
        ("customer_id", LONG), ("customer_first_name", STR), ("customer_last_name", STR),
        ("customer_city", STR), ("customer_state", STR), ("customer_postal", INT),
        ("customer_email", STR), ("customer_phone", STR)),
    "employees": _struct(
        ("employee_id", LONG), ("employee_name", STR), ("employee_ssn", STR),
        ("employee_phone", STR), ("employee_state", STR), ("employee_city", STR),
        ("employee_postal", INT)),
    "payments": _struct(("payment_id", LONG), ("payment_type", STR)),
    "products": _struct(
        ("product_id", LONG), ("product_name", STR), ("product_category", STR),
        ("unit_price", STR)),
    "transactions": _struct(
        ("transaction_id", LONG), ("timestamp", STR), ("customer_id", LONG),
        ("product_id", LONG), ("employee_id", LONG), ("payment_id", LONG),
        ("quantity", INT), ("total_amount", STR)),
}

# Cleansed tables: landing columns with the raw value columns typed.
TYPED_OVERRIDES = {
    "products": {"unit_price": MONEY},
    "transactions": {"timestamp": TS, "total_amount": MONEY},
}


def typed(table: str) -> T.StructType:
    over = TYPED_OVERRIDES.get(table, {})
    return T.StructType([T.StructField(f.name, over.get(f.name, f.dataType), True)
                         for f in LANDING[table].fields])


def all_strings(table: str) -> T.StructType:
    """Schema of a raw CSV file before any typing (every column a string)."""
    return T.StructType([T.StructField(f.name, STR, True) for f in LANDING[table].fields])


# Primary key and required columns per base table (the missing-value rule).
# These column lists are the reference's rule definitions.
KEYS = {
    "customers": "customer_id",
    "employees": "employee_id",
    "payments": "payment_id",
    "products": "product_id",
    "transactions": "transaction_id",
}
REQUIRED = {
    # customer_city is deliberately not checked
    "customers": ["customer_id", "customer_email", "customer_first_name",
                  "customer_last_name", "customer_phone", "customer_postal",
                  "customer_state"],
    "employees": ["employee_id", "employee_city", "employee_name", "employee_phone",
                  "employee_postal", "employee_ssn", "employee_state"],
    "payments": ["payment_id", "payment_type"],
    "products": ["product_id", "product_name", "product_category", "unit_price"],
    # quantity is deliberately not checked
    "transactions": ["transaction_id", "timestamp", "total_amount", "customer_id",
                     "product_id", "employee_id", "payment_id"],
}

DIMENSIONS = ("customers", "employees", "payments", "products")
BASE_TABLES = DIMENSIONS + ("transactions",)

METRICS = {
    "monthly_customer": _struct(
        ("month_year", STR), ("customer_state", STR), ("customer_id", LONG),
        ("total_products_bought", LONG), ("total_money_spent", TOTAL)),
    "monthly_employee": _struct(
        ("month_year", STR), ("employee_state", STR), ("employee_id", LONG),
        ("unique_customers_serviced", LONG), ("total_products_sold", LONG),
        ("total_money_made", TOTAL)),
    "monthly_payment": _struct(
        ("month_year", STR), ("payment_id", LONG), ("payment_type", STR),
        ("unique_customer_usage", LONG), ("total_times_used", LONG),
        ("total_revenue", TOTAL)),
    "monthly_product": _struct(
        ("month_year", STR), ("product_category", STR), ("product_id", LONG),
        ("products_sold", LONG), ("total_money_made", TOTAL)),
}

# Tables a preview may read (the allow-list of the table browser).
PREVIEWABLE = BASE_TABLES + tuple(METRICS)

REQUEST_LOG = _struct(("client", STR), ("ts", TS), ("request_id", LONG))
RUN_LOG = _struct(("pipeline_name", STR), ("status", STR), ("last_updated", TS))
CLIENT_HEADERS = _struct(("forwarded_for", STR), ("real_ip", STR), ("remote_addr", STR))
