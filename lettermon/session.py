"""SparkSession for tests, benchmarks and local runs.

On a cluster, build the session the cluster way and pass it in; the
library never needs more than a plain SparkSession (it reads
``spark.checkpoint.dir`` from it when it has to materialise).
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from .operators.materialize import checkpoint_root

CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "lettermon", extra: dict | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.driver.memory", os.environ.get("LETTERMON_DRIVER_MEMORY", "16g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus)))
    for k, v in {**CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark
