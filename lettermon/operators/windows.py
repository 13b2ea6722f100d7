"""Window operators: running totals and first-row masking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(df: DataFrame, partition: Sequence[str], order: str, value: str,
                  out: str | None = None) -> DataFrame:
    """Replace ``value`` (or add ``out``) with its running sum per ``partition``.

    The frame is RANGE from the start to the current ``order`` value, so rows
    that tie on ``order`` (peers, e.g. the same day in other segments of the
    same partition) are all included -- the result equals a triangular
    self-join on ``partition`` with ``a.order >= b.order`` followed by a sum
    (the oracle checks exactly that), at one sort per partition and without
    emitting any pair of rows.
    """
    w = (Window.partitionBy(*partition).orderBy(order)
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out or value, F.sum(value).over(w))


def first_row_number(partition: Sequence[str], order: str) -> Column:
    """row_number() per ``partition`` ordered ascending with NULLs last."""
    w = Window.partitionBy(*partition).orderBy(F.asc_nulls_last(order))
    return F.row_number().over(w)


def mask_repeats(df: DataFrame, partition: Sequence[str], order: str,
                 cols: Sequence[str], zero=0) -> DataFrame:
    """Keep ``cols`` on the first row of each ``partition`` (by ``order``,
    NULLs last) and set them to ``zero`` on every other row, so that summing
    the column over any grouping of the rows counts each partition once."""
    rn = first_row_number(partition, order)
    out = df.withColumn("__rn", rn)
    out = out.withColumns({c: F.when(F.col("__rn") == 1, F.col(c)).otherwise(F.lit(zero))
                           for c in cols})
    return out.drop("__rn")
