"""Benchmark of the headline queries.

The sixteen campaign input tables are first derived from the driver tables
in ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) and written once as
Parquet, as they would exist in a warehouse (timed as ``prepare_inputs``).
Each headline query then runs on ``local[$BENCH_CPUS]`` over those
tables: one warm-up run, then ``$BENCH_REPEATS`` (default 3) timed runs; a
run is building the query (including writing the intermediate tables it
reads) plus executing it to the end with the ``noop`` sink.  Shuffles start
at ``$BENCH_SHUFFLE_PARTITIONS`` (default: cpus) partitions and AQE
coalesces them.  Prints one JSON line with the median seconds per query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lettermon.operators.materialize import Store  # noqa: E402
from lettermon.plans.pipeline import Monitor  # noqa: E402
from lettermon.session import local_session  # noqa: E402
from lettermon.sources.fixtures import fixture_tables  # noqa: E402
from lettermon.sources.tables import Tables  # noqa: E402

HEADLINE = {
    # daily provision rate: weighted product join + one window over the totals
    "q05_daily_provision_rate": lambda m: m.daily_provision_rate(),
    # case-level letter base of the three arms
    "q06_monitor_base": lambda m: m.base(),
    # interval join of the base with eligible payments
    "q08_monitor_payment": lambda m: m.payment(),
    # running payment totals (RANGE window)
    "q09_monitor_payment_cum": lambda m: m.payment_cum(),
    # the two reports, end to end from the input tables
    "q10_daily_recovery": lambda m: m.daily_recovery(),
    "q11_repaid_clients": lambda m: m.repaid_clients(),
}
TOTAL = tuple(HEADLINE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = local_session(cpus, shuffle_partitions=partitions)

    t0 = time.perf_counter()
    inputs = Store(spark)
    derived = fixture_tables(spark, sf_dir)
    for name in derived.names():
        inputs.put(name, derived[name].repartition(cpus))  # a warehouse table has several files
    prepare = round(time.perf_counter() - t0, 3)
    tables = Tables.from_parquet(spark, inputs.root)  # opened once per session

    def once(build) -> float:
        t0 = time.perf_counter()
        m = Monitor(tables, store=Store(spark))
        build(m).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    medians = {}
    for name, build in HEADLINE.items():
        once(build)
        medians[name] = round(statistics.median(once(build) for _ in range(repeats)), 3)
        print(f"# {name}: {medians[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_median_total",
        "value": round(sum(medians[q] for q in TOTAL), 3),
        "unit": "sec",
        "queries": medians,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "shuffle_partitions": partitions,
        "prepare_inputs": prepare,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
