"""Checks of what joins rely on and of what they lose."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .materialize import Store


class DuplicateKeys(ValueError):
    """A table that is to have one row per key has several."""


def keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``df`` split into one row per key and the offenders.

    Of the rows of a key the least (by all columns) stays and the others are
    offenders, as are rows with a NULL in the key, which join nothing.
    Offenders have ``__rows``, the number of equal rows they stand for.
    """
    named = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    rest = [c for c in df.columns if c not in keys]
    once = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__rows"))
    least = (once.where(named).groupBy(*keys).agg(F.min(F.struct(*rest, F.lit(0).alias("__any"))).alias("__least"))
             .select(*keys, *(F.col(f"__least.{c}").alias(c) for c in rest)))
    kept = least.select(*df.columns)
    first = kept.select(*(F.col(c).alias(f"__k_{c}") for c in df.columns), F.lit(True).alias("__first"))
    same = None
    for c in df.columns:
        eq = once[c].eqNullSafe(first[f"__k_{c}"])
        same = eq if same is None else same & eq
    extra = once.join(first, same, "left")
    surplus = F.col("__rows") - F.when(F.col("__first"), 1).otherwise(0)
    return kept, extra.withColumn("__rows", surplus).where(F.col("__rows") > 0).select(*df.columns, "__rows")


def key_report(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """One row: ``table_name``, ``cnt_rows``, ``cnt_keys`` (distinct,
    without NULL), ``cnt_repeated`` (rows beyond the first of their key) and
    ``cnt_null`` (rows with a NULL in the key)."""
    named = F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    by_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = F.coalesce(F.sum("__n"), F.lit(0))
    whole = F.coalesce(F.sum(F.when(named, F.col("__n"))), F.lit(0))
    return by_key.agg(total.alias("cnt_rows"), F.count(F.when(named, 1)).alias("cnt_keys"),
                      (whole - F.count(F.when(named, 1))).alias("cnt_repeated"), (total - whole).alias("cnt_null")
                      ).select(F.lit(name).alias("table_name"), "cnt_rows", "cnt_keys", "cnt_repeated", "cnt_null")


def checked(df: DataFrame, name: str, keys: Sequence[str], policy: str, quarantine: Store) -> DataFrame:
    """``df`` held against its declared ``keys`` while it is stored.

    The table is written once, and its rows and keys are counted as metrics
    of that write.  If they agree the stored table comes back.  If not,
    ``"fail"`` raises :class:`DuplicateKeys`; ``"quarantine"`` writes the
    offenders as ``offenders_<name>`` and returns one row per key.
    """
    if policy not in ("fail", "quarantine"):
        raise ValueError(f"policy {policy!r}: fail or quarantine")
    stored = quarantine.put(f"checked_{name}", df)
    if stored.isEmpty():
        return stored
    seen = Observation(f"rows-of-{name}")
    per_key = (stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
               .observe(seen, F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("keys"),
                        F.coalesce(F.sum(F.when(F.expr(" OR ".join(f"`{k}` IS NULL" for k in keys)), F.col("__n"))),
                                   F.lit(0)).alias("nulls")))
    per_key.write.format("noop").mode("overwrite").save()
    if seen.get["rows"] == seen.get["keys"] and not seen.get["nulls"]:
        return stored
    if policy == "fail":
        raise DuplicateKeys(f"{name}: {seen.get['rows']} rows, {seen.get['keys']} keys of {', '.join(keys)}, "
                            f"{seen.get['nulls']} rows without a key")
    kept, offenders = keyed(stored, keys)
    quarantine.put(f"offenders_{name}", offenders)
    return quarantine.put(f"kept_{name}", kept)


class NotConserved(ValueError):
    """What was reported and lost does not add up to what there was."""


def by_reason(rows: DataFrame, reason: Column, group: Sequence[str], sums: Sequence[str], store: Store, name: str) -> DataFrame:
    """``rows`` summed per ``group`` and ``reason`` (a row that is reported
    has ``reported``): ``cnt_rows`` and the ``sums``, stored.

    The totals of ``rows`` are observed in the pass that writes the result,
    and the result must add up to them, else :class:`NotConserved`.
    """
    seen = Observation(f"totals-of-{name}")
    marked = rows.observe(seen, F.count(F.lit(1)).alias("cnt_rows"), *(F.sum(s).alias(s) for s in sums))
    out = store.put(name, marked.groupBy(*group, reason.alias("reason")).agg(
        F.count(F.lit(1)).alias("cnt_rows"), *(F.sum(s).cast("decimal(38,2)").alias(s) for s in sums)))
    after = out.agg(F.sum("cnt_rows").alias("cnt_rows"), *(F.sum(s).alias(s) for s in sums)).first()
    if not after["cnt_rows"] and rows.isEmpty():
        return out  # a plan known to be empty runs without metrics
    for what in ("cnt_rows", *sums):
        if (after[what] or 0) != (seen.get[what] or 0):
            raise NotConserved(f"{name}: {what} {seen.get[what]} before, {after[what]} after")
    return out
