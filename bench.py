"""

Prints one JSON line.  Each timing covers building the query (including any
stored table it is the first to need: the landed and cleansed fact is paid
by ``dq_transactions``, each monthly table by its monthly query, as in a
real run where roll-ups read stored monthly tables) and fetching the whole
result to the driver (Arrow batches).  One untimed warm-up on the sf0.001
folder loads the JVM classes first; it shares no data with the timed run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesmart.plans import registry  # noqa: E402
from salesmart.session import build_session  # noqa: E402

HEADLINE = [
    "dq_transactions",
    "monthly_customer", "quarterly_customer", "yearly_customer",
    "monthly_employee", "quarterly_employee", "yearly_employee",
    "monthly_payment", "quarterly_payment", "yearly_payment",
    "monthly_product", "quarterly_product", "yearly_product",
    "quota_remaining", "latest_run",
]
WARMUP_DIR = "/root/testdata/sf0.001"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    # spark.checkpoint.dir comes from the environment's defaults; only when it
    # is unset does build_session pick a fresh local folder
    spark = build_session(f"local[{cpus}]", shuffle_partitions=parts,
                          extra={"spark.ui.showConsoleProgress": "false"})
    qs = registry.queries()
    if os.path.isdir(WARMUP_DIR) and os.path.abspath(WARMUP_DIR) != os.path.abspath(sf_dir):
        qs["monthly_customer"](spark, WARMUP_DIR).toArrow()

    times, rows = {}, {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        tbl = qs[name](spark, sf_dir).toArrow()
        times[name] = round(time.perf_counter() - t0, 3)
        rows[name] = tbl.num_rows
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({
        "metric": "total_seconds_15_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "shuffle_partitions": parts,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
