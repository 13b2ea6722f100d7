"""Aggregation operators: threshold counts and ratio to a base group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import half, ratio


def threshold_agg(df: DataFrame, group: Sequence, paid: str, due: str, key: str,
                  times: str | None = None) -> DataFrame:
    """Per ``group``: how many rows (counting non-NULL ``key``) and how much
    ``paid`` reached each repayment threshold of ``due``:

    ``repaid`` paid > 0, ``half`` paid >= 0.5 * due, ``full`` paid >= due.

    Counts are plain (not distinct) counts of rows; a group without a row
    over the threshold has count 0 and amount NULL.  A row stands for
    ``times`` equal rows if that column is given.  One pass, conditional
    aggregates, map-side partial aggregation.
    """
    p, d = F.col(paid), F.col(due)
    n = F.col(times) if times else F.lit(1)
    levels = {"repaid": p > 0, "half": p >= half(d), "full": p >= d}
    aggs: list[Column] = [
        F.sum(F.when(c & F.col(key).isNotNull(), n).otherwise(0)).alias(f"cnt_client_{name}")
        for name, c in levels.items()]
    aggs += [F.sum(F.when(c, p * n.cast("decimal(10,0)"))).alias(f"amt_{name}") for name, c in levels.items()]
    return df.groupBy(*group).agg(*aggs)


def ratio_to_base(totals: DataFrame, group: Sequence[str], member: str, base: str,
                  value: str, out: str, zero: str = "fail") -> DataFrame:
    """``value`` of the ``base`` member divided by each member's ``value``,
    within each ``group``.

    ``totals`` holds one row per (group, member).  Groups without a base row,
    or with a NULL group key, drop out (inner-join semantics); the base
    member itself gets 1.0.  ``zero`` as in :func:`ratio`.  Computed with one window over the small totals
    table instead of joining it with a filtered copy of itself.
    """
    w = Window.partitionBy(*group)
    is_base = F.col(member) == base
    return (totals
            .where(F.expr(" AND ".join(f"`{g}` IS NOT NULL" for g in group)))
            .withColumns({"__base": F.max(F.when(is_base, F.col(value))).over(w),
                          "__has": F.max(F.when(is_base, F.lit(1))).over(w)})
            .where(F.col("__has") == 1)
            .select(*group, member, ratio("__base", value, zero).alias(out)))
