"""Provision branch: clients, product groups, provision, daily provision rate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.exprs import product_group
from ..operators.aggregates import ratio_to_base
from ..operators.distinct import bitmap_counts, bitmap_pieces
from ..operators.skew import heavy_keys, spread_join
from ..sources.tables import Tables

CLIENT_COLUMNS = ("skp_client", "property", "pilot", "date_decision", "extraction_date",
                  "skp_credit_case", "due_amount")
CONTRACT_KEYS = ("skp_client", "skp_credit_case", "date_decision")
RESULT_COLUMNS = ("property", "extraction_date", "pilot", "skp_client", "due_amount",
                  "product_group", "skp_credit_case")
PROVISION_KEYS = ("property", "pilot", "extraction_date", "code_dpd_tol_subbucket",
                  "product_group", "provision_rate")
PRODUCT_JOINS = {
    "product": ("skp_product",),
    "product_date": ("skp_product", "date_decision"),
    "case": ("skp_credit_case", "skp_product", "date_decision"),
}


def clients(t: Tables, cfg: C.MonitorConfig = C.DEFAULT) -> DataFrame:
    """Distinct campaign cases of every arm, tagged with the arm's property.

    Each arm carries its own property value, so one DISTINCT over the union
    equals the union of per-arm DISTINCTs.
    """
    arms = []
    for arm in cfg.arms:
        df = t[arm.source].withColumnsRenamed(arm.columns)
        arms.append(df.where(F.col("extraction_date") >= F.lit(arm.start))
                    .select(*CLIENT_COLUMNS[:1], F.lit(arm.property).alias("property"),
                            *CLIENT_COLUMNS[2:]))
    return reduce(DataFrame.unionByName, arms).distinct()


def product_groups(cl: DataFrame, t: Tables, cfg: C.MonitorConfig = C.DEFAULT,
                   keep_case: bool = False) -> DataFrame:
    """Distinct (product, decision date, product group) of the campaign cases.

    Cases are matched to ``dc_credit_case`` with a left-semi join: only the
    existence of a campaign row matters for a DISTINCT result, so duplicate
    campaign rows never multiply the credit-case side.  ``keep_case`` keeps
    ``skp_credit_case`` in the result (for ``product_join="case"``).

    The code lists (credit types, channels, goods types) are broadcast:
    joined by a shuffle, all cases would meet in as many tasks as a list has codes.
    """
    cc = t.dc_credit_case.join(
        cl.select("skp_credit_case", "date_decision"), ["skp_credit_case", "date_decision"],
        "left_semi")
    joined = (cc.join(t.dc_product, "skp_product")
              .join(F.broadcast(t.cl_credit_type), "skp_credit_type")
              .join(F.broadcast(t.cl_credit_acquisition_chnl), "skp_credit_acquisition_chnl")
              .join(F.broadcast(t.dc_goods_type.withColumnRenamed("skp_goods_type", "skp_goods_type_exp")),
                    "skp_goods_type_exp"))
    group = product_group("code_credit_acquisition_chnl", "code_credit_type",
                          "skp_product_channel", "date_decision", "code_product",
                          "name_goods_category_eng").alias("goods_type")
    keys = ["skp_credit_case"] if keep_case else []
    return joined.select(*keys, "skp_product", "date_decision", group).distinct()


def _contracts(cl: DataFrame, t: Tables) -> DataFrame:
    c = t.dc_contract.select("skp_client", "skp_credit_case", "date_decision", "skp_product")
    return cl.join(c, list(CONTRACT_KEYS))


def client_products(cl: DataFrame, t: Tables, cfg: C.MonitorConfig = C.DEFAULT,
                    prod: DataFrame | None = None) -> DataFrame:
    """Campaign cases with their product group via the contract (RESULTS).

    With ``product_join="product"`` a case meets every (decision date,
    group) row of its product, so it appears once per such row -- the
    campaign SQL's many-to-many join, kept as is.  ``prod`` is the product
    group table if it is stored already: the planner then knows its size.
    """
    keys = list(PRODUCT_JOINS[cfg.product_join])
    if prod is None:
        prod = product_groups(cl, t, cfg, keep_case=cfg.product_join == "case")
    prod = prod.select(*keys, F.col("goods_type").alias("product_group"))
    return _by_product(_contracts(cl, t), prod, keys).select(*RESULT_COLUMNS)


def _by_product(cases: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """Join on the product keys; a product that holds many of the cases is spread over several tasks."""
    return spread_join(cases, side, keys, heavy_keys(cases, keys), ["skp_client", "skp_credit_case"])


def product_weights(cl: DataFrame, t: Tables, cfg: C.MonitorConfig = C.DEFAULT,
                    prod: DataFrame | None = None) -> DataFrame:
    """Product-group table collapsed to one row per (join key, group) with the
    number of rows it stands for (``weight``).

    Joining contracts to this instead of the raw table gives each case one
    row per group with a multiplicity, which sums exactly like the
    many-to-many join without its copies of equal groups.
    """
    keys = list(PRODUCT_JOINS[cfg.product_join])
    if prod is None:
        prod = product_groups(cl, t, cfg, keep_case=cfg.product_join == "case")
    return (prod.groupBy(*keys, F.col("goods_type").alias("product_group"))
            .agg(F.count(F.lit(1)).cast("decimal(9,0)").alias("weight")))


def _bucketed(cl: DataFrame, t: Tables) -> DataFrame:
    """Campaign cases with their contract's product and DPD sub-bucket."""
    dpd = t.dpd_snapshot.select("skp_credit_case", "extraction_date", "skp_dpd_tol_bucket")
    return (_contracts(cl, t).join(dpd, ["skp_credit_case", "extraction_date"])
            .join(F.broadcast(t.dc_dpd_tol_bucket), "skp_dpd_tol_bucket"))


def _rates(t: Tables) -> DataFrame:
    """Rates per product group and bucket: a short list, broadcast like the other code lists."""
    return F.broadcast(t.ft_coll_provision_rate.withColumnRenamed("flag_bucket", "code_dpd_tol_subbucket"))


def provision(cl: DataFrame, t: Tables, cfg: C.MonitorConfig = C.DEFAULT,
              weights: DataFrame | None = None) -> DataFrame:
    """Receivable, provision amount and distinct case/client counts per
    property, pilot, date, DPD sub-bucket, product group and rate.

    Cases take their DPD bucket from ``dpd_snapshot`` on (case, extraction
    date); a (group, bucket) pair without a rate drops out.  The product
    side is the weighted table of :func:`product_weights`: the amounts are
    ``sum(due * weight)`` and ``sum(due * rate * weight)``, exact decimals
    equal to summing over the many-to-many rows.  A case has a row per group
    of its product here, which the distinct counts need;
    :func:`provision_totals` needs none.  Cases and clients are counted as
    bits of their numbers (``case_no``, ``client_no`` of
    :func:`numbered_clients`; keys themselves if ``cl`` has no numbers), so
    no row is expanded and each is aggregated before the shuffle.
    """
    if weights is None:
        weights = product_weights(cl, t, cfg)
    rows = (_by_product(_bucketed(cl, t), weights, list(PRODUCT_JOINS[cfg.product_join]))
            .join(_rates(t), ["product_group", "code_dpd_tol_subbucket"]))
    due, rate, w = F.col("due_amount"), F.col("provision_rate"), F.col("weight")
    numbers = {"cnt_case": "case_no" if "case_no" in cl.columns else "skp_credit_case",
               "cnt_client": "client_no" if "client_no" in cl.columns else "skp_client"}
    amounts = {"amt_receivable": due * w, "amt_provision": (due * rate) * w}
    pieces = bitmap_pieces(rows, PROVISION_KEYS, numbers, amounts)
    return bitmap_counts(pieces, PROVISION_KEYS, list(numbers), list(amounts)).select(
        "property", "pilot", "extraction_date", F.col("amt_receivable").cast("decimal(38,2)").alias("amt_receivable"),
        F.col("amt_provision").cast("decimal(38,8)").alias("amt_provision"), "cnt_case", "cnt_client",
        "code_dpd_tol_subbucket", "product_group", "provision_rate")


def numbered_clients(cl: DataFrame, case_numbers: DataFrame, client_numbers: DataFrame) -> DataFrame:
    """``cl`` with ``case_no`` and ``client_no``; a NULL case or client has none."""
    return cl.join(case_numbers, "skp_credit_case", "left").join(client_numbers, "skp_client", "left").select(
        *cl.columns, "case_no", "client_no")


def provision_totals(cl: DataFrame, t: Tables, cfg: C.MonitorConfig = C.DEFAULT,
                     weights: DataFrame | None = None) -> DataFrame:
    """``amt_provision_total`` per property, extraction date and pilot: the sum
    of :func:`provision` over buckets, groups and rates.

    The debt is summed per (property, pilot, date, product key, bucket)
    before it meets the product groups, so no case is repeated, only such a
    sum for each group of its product.  Rates come last and are broadcast:
    no table of all product keys and buckets is made, which with
    ``product_join="case"`` has a row per case and bucket.  Exact: debts below
    10^18, weighted rates below 10^9.
    """
    keys = list(PRODUCT_JOINS[cfg.product_join])
    if weights is None:
        weights = product_weights(cl, t, cfg)
    debts = (_bucketed(cl, t).groupBy("property", "pilot", "extraction_date", *keys, "code_dpd_tol_subbucket")
             .agg(F.sum("due_amount").cast("decimal(20,2)").alias("due")))
    unit = (F.col("provision_rate") * F.col("weight")).cast("decimal(15,6)")
    return (debts.join(weights, keys).join(_rates(t), ["product_group", "code_dpd_tol_subbucket"])
            .groupBy("property", "extraction_date", "pilot")
            .agg(F.sum(F.col("due") * unit).cast("decimal(38,8)").alias("amt_provision_total")))


def daily_provision_rate(totals: DataFrame, cfg: C.MonitorConfig = C.DEFAULT) -> DataFrame:
    """Provision of the base pilot over provision of each pilot, per property
    and extraction date; (property, date) without the base pilot drop out.
    ``totals`` are those of :func:`provision_totals`."""
    return ratio_to_base(totals, ["property", "extraction_date"], "pilot", cfg.base_pilot,
                         "amt_provision_total", "daily_provision_rate", cfg.zero_provision)
