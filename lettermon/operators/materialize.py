"""Materialisation: intermediate tables written once to shared storage.

A dataset read by several later steps is written once as Parquet and read
back, the way the campaign SQL creates its tables: later steps then scan
columnar files (with pushdown and file-size statistics) instead of
recomputing the plan, and a lost executor costs a re-read, not a replay of
the whole lineage.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Read from the SparkContext (``setCheckpointDir``) or the
    ``spark.checkpoint.dir`` setting.  Only a session on one machine
    (``local``, ``local[n]``) without one gets a fresh temporary folder; on
    a cluster, ``local-cluster`` too, a missing setting is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a local SparkContext (e.g. Spark Connect)
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return conf
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lettermon-ckpt-"))
    return sc.getCheckpointDir()


#: What a text format needs to be read back as it was written.
FORMAT_OPTIONS = {"csv": {"header": "true", "nullValue": "\\N", "emptyValue": ""}}


class Store:
    """Where intermediate tables go.

    ``Store(spark)`` uses a fresh folder under the session's checkpoint
    root; ``Store(spark, path)`` writes named tables under ``path`` (the
    pipeline's sinks), overwriting earlier runs.  A table is read back with
    the schema it was written with.  Folders under the checkpoint root stay
    until that root is cleared, as Spark's own checkpoints do.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, fmt: str = "parquet"):
        self.spark = spark
        self.fmt = fmt
        self.root = (root or f"{checkpoint_root(spark).rstrip('/')}/lettermon-{uuid.uuid4().hex}")

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def put(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` as table ``name`` (overwrite) and return it read back.

        With ``partition_by`` the table is laid out in one folder per value;
        rows are first rebalanced on those columns (a ``REBALANCE`` hint), so
        each value is written by few tasks and few files, while AQE splits a
        value that holds a large share of the rows over several tasks.
        """
        w = df
        if partition_by:
            w = df.hint("rebalance", *partition_by)
        w = w.write.mode("overwrite").format(self.fmt).options(**FORMAT_OPTIONS.get(self.fmt, {}))
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(self.path(name))
        return self.get(name, df.schema)

    def get(self, name: str, schema: StructType | None = None) -> DataFrame:
        reader = self.spark.read.format(self.fmt).options(**FORMAT_OPTIONS.get(self.fmt, {}))
        return (reader.schema(schema) if schema is not None else reader).load(self.path(name))
