"""Exact distinct counts as mergeable bitmaps.

``COUNT(DISTINCT a), COUNT(DISTINCT b)`` makes Spark expand every row into
one copy per count.  Here the keys get dense numbers first; a group's
numbers are bits of bitmaps of 64 bits (a long), built map-side, and a count
is the number of set bits.  Bitmaps of several groups are merged by OR, so the
same pieces give the counts of any coarser group without a second scan.

Numbers follow the order in which the groups are formed (date first), so the
keys of a group lie close together and share few bitmaps.  Keys that recur in
many groups (clients on many dates) do not: there a row has a bitmap almost to
itself.  So a bitmap is a long, which a hash aggregate keeps in place, and a
piece is never larger than its row; the 4 KB of ``bitmap_construct_agg`` for
each would be held and sorted whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .materialize import Store
from .ordering import numbered

MEASURE, BUCKET, BITS = "__measure", "__bucket", "__bits"

#: The bits of a number below this are its place in its bitmap, those above it the bitmap.
_BUCKET_BITS = 6


def dense_numbers(rows: DataFrame, key: str, order: Sequence[str], store: Store, name: str, out: str) -> DataFrame:
    """``key`` and its number ``out`` (from 1, gapless), a row per distinct
    non-NULL key, in the order of the least ``order`` values it occurs with."""
    firsts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order)).alias("__first"))
    return numbered(firsts, [F.col("__first"), F.col(key)], store, name, out).select(key, out)


def bitmap_pieces(rows: DataFrame, group: Sequence[str], keys: Mapping[str, str], sums: Mapping[str, Column] | None = None) -> DataFrame:
    """Bitmaps of ``rows`` per ``group``: a row per group, measure and bucket.

    ``keys`` maps the name of a count to the column of numbers (NULL: not
    counted) that it counts; ``sums`` maps names to amounts that are summed
    in the same pass (NULL of no row).  Every row meets its measures inside
    the scan and is aggregated before the shuffle.
    """
    sums = dict(sums or {})
    inputs = rows.select(*group, *(F.col(c).alias(f"__n_{k}") for k, c in keys.items()),
                         *(c.alias(f"__s_{k}") for k, c in sums.items()))
    measures = [F.struct(F.lit(k).alias("m"), F.col(f"__n_{k}").alias("n")) for k in keys]
    first = next(iter(keys))
    stacked = inputs.withColumn("__of", F.explode(F.array(*measures)))
    number = F.col("__of.n")
    amounts = [F.sum(F.when(F.col("__of.m") == first, F.col(f"__s_{k}"))).alias(k) for k in sums]
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit((1 << _BUCKET_BITS) - 1)).cast("int"))
    return (stacked.groupBy(*group, F.col("__of.m").alias(MEASURE), F.shiftright(number, _BUCKET_BITS).alias(BUCKET))
            .agg(F.bit_or(bit).alias(BITS), *amounts))


def rolled_up(pieces: DataFrame, group: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """The pieces of a coarser ``group``: bitmaps merged, amounts summed."""
    return pieces.groupBy(*group, MEASURE, BUCKET).agg(F.bit_or(BITS).alias(BITS), *(F.sum(s).alias(s) for s in sums))


def bitmap_counts(pieces: DataFrame, group: Sequence[str], counts: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """A row per group with its distinct ``counts`` and ``sums``."""
    here = F.when(F.col(BUCKET).isNotNull(), F.bit_count(BITS)).otherwise(0)
    return pieces.groupBy(*group).agg(
        *(F.sum(s).alias(s) for s in sums),
        *(F.sum(F.when(F.col(MEASURE) == c, here).otherwise(0)).alias(c) for c in counts))
