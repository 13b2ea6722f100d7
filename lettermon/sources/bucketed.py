"""Tables in buckets of their join key, so that joins on it move no rows.

Letter results (S14), payments (S15) and the case-level base (K02) meet on
the credit case.  Written once in buckets of it, each further join reads
bucket by bucket: a daily run does not shuffle the years of payments again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.materialize import Store
from .tables import Tables

#: The key of each table that is kept in buckets.
BUCKETED = {
    "f_letter_result_tt": "skp_credit_case",
    "f_incoming_payment_tt": "skp_credit_case",
    "monitor_base": "skp_credit_case",
}


class BucketedStore(Store):
    """A store that keeps the tables of ``BUCKETED`` as catalog tables in
    ``buckets`` buckets, their files under the store's root like all others.

    Joins here have more keys than the case; Spark takes buckets of one of
    them for co-located if ``spark.sql.requireAllClusterKeysForCoPartition``
    is off, so the store turns it off in the session.  Rows are rebalanced
    before they are written: a bucket is few files, and a case that holds
    many rows is written by several tasks.
    """

    def __init__(self, spark: SparkSession, buckets: int, root: str | None = None, prefix: str | None = None):
        super().__init__(spark, root)
        self.buckets, self.prefix = buckets, prefix or f"lettermon_{uuid.uuid4().hex}"
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")

    def table(self, name: str) -> str:
        return f"{self.prefix}_{name}"

    def put(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        if name not in BUCKETED:
            return super().put(name, df, partition_by)
        key = BUCKETED[name]
        w = (df.hint("rebalance", key).write.format("parquet").mode("overwrite").option("path", self.path(name))
             .bucketBy(self.buckets, key).sortBy(key))
        (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(self.table(name))
        return self.get(name)

    def get(self, name: str, schema: StructType | None = None) -> DataFrame:
        return self.spark.table(self.table(name)) if name in BUCKETED else super().get(name, schema)


def with_buckets(tables: Tables, store: BucketedStore) -> Tables:
    """``tables`` with letter results and payments written to ``store`` in buckets (on first use)."""
    return Tables.from_frames({
        n: (lambda n=n: store.put(n, tables[n]) if n in BUCKETED else tables[n]) for n in tables.names()})
