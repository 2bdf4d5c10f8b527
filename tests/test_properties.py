"""Property test: the Spark cleansing equals a brute-force replay of the
original statement sequence on random faulty fixtures."""

from collections import Counter
from decimal import Decimal, InvalidOperation

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salesmart.operators import quality
from salesmart.schemas import LANDING

TS = ["2020-01-05 00:00:00", "2021-02-03", "2020-13-45", "x", None]
AMOUNTS = ["10.00", "0.00", "-5.00", "abc", "3.5", None]
DIM_IDS = [1, 2, 3]

row = st.tuples(
    st.integers(0, 12),                                   # transaction_id (collisions wanted)
    st.sampled_from(TS),
    st.one_of(st.none(), st.integers(1, 4)),              # customer_id (4 is an orphan)
    st.integers(1, 4), st.integers(1, 3), st.integers(1, 4),
    st.one_of(st.none(), st.integers(0, 9)),              # quantity (not required)
    st.sampled_from(AMOUNTS),
)


def valid_date(s):
    return s is not None and s[:10].count("-") == 2 and s[:10] in (
        "2020-01-05", "2021-02-03")


def money(s):
    try:
        return Decimal(s)
    except (InvalidOperation, TypeError):
        return None


def brute(rows):
    required = [0, 1, 7, 2, 3, 4, 5]
    s1 = [r for r in rows if all(r[i] is not None for i in required)]
    n = Counter(r[0] for r in s1)
    s2 = [r for r in s1 if n[r[0]] == 1]
    s3 = [r for r in s2 if valid_date(r[1]) and money(r[7]) is not None and money(r[7]) >= 0
          and all(r[i] in DIM_IDS for i in (2, 3, 4, 5))]
    return sorted(r[0] for r in s3)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=0, max_size=25))
def test_cleanse_matches_brute_force(spark, rows):
    fact = spark.createDataFrame(rows, LANDING["transactions"])
    dims = {t: spark.createDataFrame([(i,) for i in DIM_IDS], f"{k} long")
            for t, k in quality.FACT_KEYS.items()}
    got = sorted(r.transaction_id for r in quality.cleanse_transactions(fact, dims).collect())
    assert got == brute(rows)
    # the rejects report accounts for every removed row exactly once
    rej = quality.reject_reasons(fact, "transactions", dims).count()
    assert rej + len(got) == len(rows)
