"""Places in a total order without gathering the rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .materialize import Store

#: ``monotonically_increasing_id`` has the partition above these bits and the row in it below.
_ROW_BITS = 33


def numbered(df: DataFrame, order: Sequence[Column], store: Store, name: str, out: str = "rank", first: int = 1) -> DataFrame:
    """``df`` with ``out``: each row's place in ``order``, gapless from ``first``.

    The rows are range-partitioned and sorted on ``order`` and written to
    ``store``; a row's place is its place in its partition plus the rows of
    the partitions before.  Only one count per partition meets in a task,
    however many rows there are.  Rows that tie get consecutive places.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    stored = store.put(name, rows)
    part = F.shiftright("__at", _ROW_BITS)
    counts = stored.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__part", F.coalesce(F.sum("__n").over(
        W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    place = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + first
    # a row per partition of the range shuffle, whose number the data do not decide
    return (stored.withColumn("__part", part).join(F.broadcast(before), "__part")
            .withColumn(out, place).drop("__at", "__part", "__before"))
