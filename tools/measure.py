"""Time the campaign SQL's written forms against the library's, and every campaign query.

Usage: python tools/measure.py [sf_dir] [repeats]
Prints one JSON line: median warm seconds per step on local[$BENCH_CPUS],
from the sixteen input tables written once.  The written forms stay here,
outside the library: they emit the pairs that its plans avoid.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from lettermon import config as C  # noqa: E402
from lettermon.operators.materialize import Store  # noqa: E402
from lettermon.plans import monitor as M  # noqa: E402
from lettermon.plans.pipeline import Monitor  # noqa: E402
from lettermon.session import local_session  # noqa: E402
from lettermon.sources.fixtures import fixture_tables  # noqa: E402
from lettermon.sources.tables import Tables  # noqa: E402


def written_rate(m: Monitor):
    """Daily provision rate with every many-to-many row and a join of the totals."""
    t, results = m.t, m.client_products()
    dpd = t.dpd_snapshot.join(t.dc_dpd_tol_bucket, "skp_dpd_tol_bucket")
    rates = t.ft_coll_provision_rate.withColumnRenamed("flag_bucket", "code_dpd_tol_subbucket")
    prov = (results.join(dpd, ["skp_credit_case", "extraction_date"])
            .join(rates, ["product_group", "code_dpd_tol_subbucket"])
            .groupBy("property", "pilot", "extraction_date", "code_dpd_tol_subbucket", "product_group", "provision_rate")
            .agg(F.sum(F.col("due_amount") * F.col("provision_rate")).alias("amt")))
    totals = prov.groupBy("property", "extraction_date", "pilot").agg(F.sum("amt").alias("total"))
    base = totals.where(F.col("pilot") == C.BASE_PILOT).select("property", "extraction_date", F.col("total").alias("base"))
    return totals.join(base, ["property", "extraction_date"]).select(
        "property", "extraction_date", "pilot", (F.col("base").cast("double") / F.col("total").cast("double")).alias("rate"))


def written_running_total(m: Monitor):
    """Cumulative payments as the triangular self-join."""
    p = m.payment()
    a, b = p.alias("a"), p.alias("b")
    cond = reduce(lambda x, y: x & y, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in C.CLIENT_KEY])
    j = a.join(b, cond & (F.col("b.days_after_gen") <= F.col("a.days_after_gen")))
    return j.groupBy(*[F.col(f"a.{k}") for k in (*M.CLIENT_GRAIN, "days_after_gen")]).agg(F.sum("b.amt_payment"))


STEPS = {
    "daily provision rate, as written": written_rate,
    "daily provision rate, summed first": lambda m: m.daily_provision_rate(),
    "cumulative payments, self-join": written_running_total,
    "cumulative payments, range window": lambda m: m.payment_cum(),
    "q01_clients": lambda m: m.clients(),
    "q02_product_groups": lambda m: m.product_groups(),
    "q03_client_products": lambda m: m.client_products(),
    "q04_provision": lambda m: m.provision(),
    "q06_monitor_base": lambda m: m.base(),
    "q07_monitor_base_client": lambda m: m.base_client(),
    "q08_monitor_payment": lambda m: m.payment(),
    "a10_debt_paid": lambda m: m.debt_paid(),
    "q10_daily_recovery": lambda m: m.daily_recovery(),
    "q11_repaid_clients": lambda m: m.repaid_clients(),
    "q12_provision_coverage": lambda m: m.provision_coverage(),
    "q14_distinct_channels": lambda m: m.t.dc_product.select("skp_product_channel").distinct(),
    "q15_distinct_product_codes": lambda m: m.t.dc_product.select("code_product").distinct(),
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    repeats = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)
    inputs, derived = Store(spark), fixture_tables(spark, sf_dir)
    for name in derived.names():
        inputs.put(name, derived[name].repartition(cpus))
    tables = Tables.from_parquet(spark, inputs.root)

    def once(build) -> float:
        began = time.perf_counter()
        build(Monitor(tables, store=Store(spark))).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began
    out = {}
    for name, build in STEPS.items():
        once(build)
        out[name] = round(statistics.median(once(build) for _ in range(repeats)), 3)
        print(f"# {name}: {out[name]}s", file=sys.stderr, flush=True)
    print(json.dumps({"sf_dir": sf_dir, "cpus": cpus, "repeats": repeats, "seconds": out}))
    spark.stop()


if __name__ == "__main__":
    main()
