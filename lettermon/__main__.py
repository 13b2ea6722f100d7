"""Run the campaign monitor: ``python -m lettermon --inputs ROOT --out DIR``.

``ROOT`` holds one Parquet table per input (``<name>``, or with
``--suffix .parquet`` ``<name>.parquet``) and may be any URI Spark reads; with ``--catalog`` the inputs are read from the session catalog instead.
Writes the five campaign tables and both reports under ``DIR``.
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import replace

from pyspark.sql import SparkSession

from .config import DEFAULT
from .operators.materialize import Store
from .plans.pipeline import run
from .plans.refresh import refresh
from .sources.tables import Tables


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="lettermon")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--inputs", help="folder with one Parquet table per input")
    src.add_argument("--catalog", action="store_true", help="read inputs from the catalog")
    ap.add_argument("--suffix", default="", help="what follows a table's name in the inputs folder")
    ap.add_argument("--time-zone", help="zone in which timestamps become dates (default: the session's)")
    ap.add_argument("--zero-provision", default=DEFAULT.zero_provision, choices=["fail", "null"])
    ap.add_argument("--out", required=True, help="output folder (overwritten)")
    ap.add_argument("--product-join", default=DEFAULT.product_join,
                    choices=["product", "product_date", "case"])
    ap.add_argument("--null-safe-segments", action="store_true")
    ap.add_argument("--report-format", default="parquet")
    ap.add_argument("--partition-sinks", action="store_true",
                    help="lay the sinks out by extraction_date")
    ap.add_argument("--versioned", action="store_true",
                    help="publish all tables at once, keeping those of the run before until then")
    ap.add_argument("--refresh", metavar="DAY", type=dt.date.fromisoformat,
                    help="replace only what can have changed since a run (--partition-sinks) that knew all up to DAY")
    ap.add_argument("--late-days", type=int, default=0, help="days that rows may come late (--refresh)")
    ap.add_argument("--check-keys", choices=["fail", "quarantine"],
                    help="what to do if a table that is to have one row per key has several (default: join them all)")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("lettermon").getOrCreate()
    tables = (Tables.from_catalog(spark, zone=a.time_zone) if a.catalog
              else Tables.from_parquet(spark, a.inputs, a.suffix, a.time_zone))
    cfg = replace(DEFAULT, product_join=a.product_join, null_safe_segments=a.null_safe_segments,
                  zero_provision=a.zero_provision)
    if a.check_keys:
        tables = tables.with_checked_keys(a.check_keys, Store(spark, f"{a.out.rstrip('/')}/_keys"))
    if a.refresh:
        refresh(tables, a.out, a.refresh, cfg, a.late_days, a.report_format)
    else:
        run(tables, a.out, cfg, a.report_format, a.partition_sinks, a.versioned)


if __name__ == "__main__":
    main()
