"""Joins on keys of which a few hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it holds more than this share of the rows; so at most ``1 / SHARE`` keys are.
SHARE = 0.01


def heavy_keys(rows: DataFrame, keys: Sequence[str], share: float = SHARE) -> DataFrame:
    """Keys that hold more than ``share`` of ``rows``, and ``__salts``: over
    how many parts each is to be spread (its share over ``share``, rounded
    up).  Counts are exact; NULL keys, which join nothing, are left out.  At
    most ``1 / share`` rows come back, whatever the data.
    """
    counts = (rows.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
              .groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")))
    total = counts.agg(F.sum("__n").alias("__total")).scalar()
    return (counts.where(F.col("__n") > total * share)
            .select(*keys, F.ceil(F.col("__n") / (total * share)).cast("int").alias("__salts")))


def spread_join(big: DataFrame, small: DataFrame, keys: Sequence[str], heavy: DataFrame, by: Sequence[str]) -> DataFrame:
    """Inner join of ``big`` and ``small`` on ``keys``, equal to
    ``big.join(small, keys)``, in which no heavy key lands in one task.

    A row of ``big`` with a heavy key goes to one of the key's parts, chosen
    by a hash of the columns ``by`` (so a repeated task chooses alike); the
    rows of ``small`` with that key are repeated for every part.  All other
    rows have the one part 0.  ``heavy`` is that of :func:`heavy_keys`; its
    size is bounded, so it is broadcast.  If no key is heavy this is the
    plain join.  The repeated rows take their keys from the parts, so a
    ``small`` that lies by its keys is dealt by key and part even in a session
    in which some of the keys are enough
    (``spark.sql.requireAllClusterKeysForCoPartition`` off, as tables in
    buckets need it).
    """
    keys = list(keys)
    salted = big.join(F.broadcast(heavy), keys, "left").withColumn(
        "__salt", F.coalesce(F.pmod(F.xxhash64(*by), F.col("__salts").cast("long")).cast("int"), F.lit(0))).drop("__salts")
    parts = F.transform(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1),
                        lambda salt: F.struct(*(F.col(k).alias(k) for k in keys), salt.alias("__salt")))
    repeated = (small.join(F.broadcast(heavy), keys, "left").withColumn("__of", F.explode(parts))
                .select("__of.*", *(c for c in small.columns if c not in keys)))
    return salted.join(repeated, [*keys, "__salt"]).drop("__salt")
