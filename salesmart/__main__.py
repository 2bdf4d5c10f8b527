"""Batch job: land -> cleanse -> monthly metrics -> roll-ups -> publish.

    spark-submit --py-files salesmart.zip -m salesmart --csv <landing folder> --out <root>
    python -m salesmart --tables /root/testdata/sf0.01 --out /tmp/run-x/published

``--csv`` reads ``<folder>/<table>/`` CSV files (header row) for the five base
tables; ``--tables`` maps the driver's test tables instead.  Written under
``--out``: the cleansed tables, the monthly tables partitioned by
``month_year`` (``--months`` recomputes only those months in place;
``--mode append`` adds the rows under ``--load-id`` instead, by default a
fingerprint of the input, so that a rerun over the same input adds nothing), the
quarterly and yearly roll-ups, and the rejects report.
"""

from __future__ import annotations

import argparse
import json
import os

from .operators.rollups import ROLLUPS
from .plans.warehouse import from_csv, warehouse
from .schemas import BASE_TABLES
from .session import build_session, configure
from .sinks.tables import refresh
from .sources.listing import fingerprint


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="salesmart")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="landing folder with one CSV folder per base table")
    src.add_argument("--tables", help="folder of the driver's parquet test tables")
    ap.add_argument("--faults", default="fact", choices=["fact", "all", "none"])
    ap.add_argument("--out", required=True, help="output root")
    ap.add_argument("--months", nargs="*", help="recompute only these yyyy-MM months")
    ap.add_argument("--mode", default="refresh", choices=["refresh", "append"], help="how monthly tables are written")
    ap.add_argument("--load-id", help="name of an append; another name appends the rows again")
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    args = ap.parse_args(argv)

    if args.master:
        spark = build_session(args.master)
    else:
        from pyspark.sql import SparkSession
        spark = configure(SparkSession.builder.getOrCreate())
    wh = (from_csv(spark, args.csv, partition_fact=True) if args.csv
          else warehouse(spark, args.tables, args.faults, partition_fact=True))
    load_id = None
    if args.mode == "append":
        load_id = args.load_id or "-".join([fingerprint(spark, args.csv or args.tables), *sorted(args.months or ())])

    written = {}
    for t in BASE_TABLES:
        written[t] = os.path.join(args.out, "clean", t)
        refresh(wh.clean(t), written[t])
    written.update(wh.publish(os.path.join(args.out, "monthly"), args.months, load_id=load_id))
    for entity in ROLLUPS:
        for period in ("quarterly", "yearly"):
            name = f"{period}_{entity}"
            written[name] = os.path.join(args.out, "rollups", name)
            refresh(wh.rollup(entity, period), written[name])
    written["rejects"] = os.path.join(args.out, "rejects")
    refresh(wh.rejects(), written["rejects"])
    print(json.dumps(written, indent=1))
    return written


if __name__ == "__main__":
    main()
