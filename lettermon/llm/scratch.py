"""Shared intermediate tables and row locators of the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators.materialize import checkpoint_root

FILE, ROW = "__file", "__row"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the
    lineage is cut and a lost executor costs a re-read."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def located(df: DataFrame) -> DataFrame:
    """``df`` with ``__file`` and ``__row``: where each row is stored.

    The pair names a row even if its id is null or repeated.  A frame read
    from Parquet, with columns selected and rows filtered at most, is located
    in its own files.  Any other frame (joins, unions and generators repeat
    places) is written to the shared folder first.
    """
    def at(frame):
        meta = frame.metadataColumn("_metadata")
        return frame.select("*", meta["file_path"].alias(FILE), meta["row_index"].alias(ROW))
    if _places_are_unique(df):
        try:
            out = at(df)
            out.schema  # noqa: B018  analyses the plan: an error here means no such metadata
            return out
        except AnalysisException:
            pass
    return at(materialise(df, "located"))


def _places_are_unique(df: DataFrame) -> bool:
    """Whether the analysed plan of ``df`` is one scan under filters and projections."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.child()
    return plan.nodeName().startswith(("LogicalRelation", "Relation"))


def without(docs: DataFrame, gone: Callable[[DataFrame], DataFrame], how: str = "left_anti") -> DataFrame:
    """``docs`` without the rows whose places ``gone`` returns, given the
    located ``docs`` (``how="left_semi"``: only those rows); same columns.

    Columns that have the places' names themselves are put aside meanwhile."""
    aside = {c: f"{c}_{uuid.uuid4().hex}" for c in docs.columns if c.lower() in (FILE, ROW)}
    docs = located(docs.withColumnsRenamed(aside))
    found = gone(docs).select(FILE, ROW)
    out = docs.join(found, [FILE, ROW], how).drop(FILE, ROW)
    return out.withColumnsRenamed({v: k for k, v in aside.items()})


def numbered(df: DataFrame, order: list, rank: str) -> DataFrame:
    """``df`` with ``rank``: its place in the total order, from 0, gapless.

    The rows are range-partitioned and sorted on ``order`` and written; a
    row's place is its position inside its partition plus the rows of the
    partitions before it.  Only the per-partition counts meet in one task,
    so no key is ever gathered, however many rows share it.  Rows that tie
    in ``order`` get consecutive places.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialise(sorted_rows.withColumn(rank, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(F.col(rank), 33).alias("__part")
    counts = stored.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select(
        "__part", F.coalesce(F.sum("__n").over(
            W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    # one row per partition of the range shuffle: a bound that does not depend on the data
    return (stored.withColumn("__part", part).join(F.broadcast(before), "__part")
            .withColumn(rank, F.col("__before") + F.col(rank).bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("__part", "__before"))
