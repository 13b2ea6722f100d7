"""Letter base and payment branch: monitor_base, monitor_base_client,
monitor_payment, monitor_payment_cum."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.exprs import age_bucket, days_between, delivery_class, delivery_detail, \
    eligible_payment, money, week_start
from ..operators.intervals import within_horizon
from ..operators.materialize import Store
from ..operators.quality import by_reason
from ..operators.windows import running_total
from ..sources.tables import Tables

CLIENT_GRAIN = (
    "property", "pilot", "extraction_date", "skp_client", "text_delivery_result",
    "text_delivery_result_more", "cpd_ranges", "days_exa_assignment_group",
)


def _arm_cases(t: Tables, arm: C.Arm) -> DataFrame:
    """Case rows of one arm with the common column names, cut at its start."""
    df = t[arm.source].withColumnsRenamed(arm.columns)
    df = df.where(F.col("extraction_date") >= F.lit(arm.start))
    assigned = F.col("date_assigned") if arm.age_buckets else week_start("extraction_date")
    cols = [
        F.lit(arm.property).alias("property"),
        F.lit(arm.letter_type).alias("letter_type"),
        "pilot", "skp_client", "extraction_date", "skp_credit_case",
        assigned.alias("date_assigned"), "due_amount",
    ]
    if arm.client_list is None:
        cols.append("cpd_ranges")
    return df.select(*cols)


def monitor_base(t: Tables, cfg: C.MonitorConfig = C.DEFAULT) -> DataFrame:
    """Case-level letter base of all arms (one row per case and letter-result row).

    All arms are unioned first, so the CPD client lists are joined once
    (keyed by property) and the letter results are scanned and joined once
    on (date, case, letter type) instead of once per arm.  Inner joins: a
    case without a CPD row or a letter result of its type drops out; several
    result rows repeat the case.
    """
    listed = [a for a in cfg.arms if a.client_list is not None]
    unlisted = [a for a in cfg.arms if a.client_list is None]
    frames = []
    if listed:
        cases = reduce(DataFrame.unionByName, [_arm_cases(t, a) for a in listed])
        lists = reduce(DataFrame.unionByName, [
            t[a.client_list].select(
                F.lit(a.property).alias("property"),
                F.col("selection_date").alias("extraction_date"), "skp_client", "cpd_ranges")
            for a in listed])
        frames.append(cases.join(lists, ["property", "extraction_date", "skp_client"]))
    frames += [_arm_cases(t, a) for a in unlisted]
    cases = reduce(lambda a, b: a.unionByName(b), frames)

    types = [a.letter_type for a in cfg.arms]
    results = (t.f_letter_result_tt
               .where(F.col("skp_coll_letter_type").isin(*types))
               .select(F.col("date_generated").alias("extraction_date"), "skp_credit_case",
                       F.col("skp_coll_letter_type").alias("letter_type"),
                       "text_delivery_result"))
    base = cases.join(results, ["extraction_date", "skp_credit_case", "letter_type"])

    ages = F.when(F.col("property").isin(*[a.property for a in cfg.arms if a.age_buckets]),
                  age_bucket("extraction_date", "date_assigned")
                  ).otherwise(F.lit(C.NO_AGE_BUCKET))
    return base.select(
        "property", "pilot", "skp_client", "extraction_date", "skp_credit_case",
        "date_assigned", "due_amount", "cpd_ranges",
        ages.alias("days_exa_assignment_group"),
        delivery_detail("pilot", "text_delivery_result").alias("text_delivery_result_more"),
        delivery_class("pilot", "text_delivery_result").alias("text_delivery_result"),
    )


def case_losses(t: Tables, store: Store, cfg: C.MonitorConfig = C.DEFAULT) -> DataFrame:
    """Audit of the letter base: the arms' case rows and their debt, by
    property and by whether the base has them (``reported``) or which of its
    inner joins drops them: ``no_cpd_range`` (first) or ``no_letter_result``."""
    frames = []
    for arm in cfg.arms:
        cases = _arm_cases(t, arm).select("property", "letter_type", "extraction_date", "skp_client", "skp_credit_case", "due_amount")
        if arm.client_list is None:
            frames.append(cases.withColumn("listed", F.lit(True)))
        else:
            listed = t[arm.client_list].select(F.col("selection_date").alias("extraction_date"), "skp_client",
                                               F.lit(True).alias("listed")).distinct()
            frames.append(cases.join(listed, ["extraction_date", "skp_client"], "left"))
    answered = (t.f_letter_result_tt.where(F.col("skp_coll_letter_type").isin(*[a.letter_type for a in cfg.arms]))
                .select(F.col("date_generated").alias("extraction_date"), "skp_credit_case",
                        F.col("skp_coll_letter_type").alias("letter_type"), F.lit(True).alias("answered")).distinct())
    rows = reduce(DataFrame.unionByName, frames).join(answered, ["extraction_date", "skp_credit_case", "letter_type"], "left")
    reason = (F.when(F.col("listed").isNull(), "no_cpd_range").when(F.col("answered").isNull(), "no_letter_result")
              .otherwise("reported"))
    return by_reason(rows, reason, ["property"], ["due_amount"], store, "case_losses")


def monitor_base_client(base: DataFrame) -> DataFrame:
    """Client level: debt and number of cases per client and segment."""
    return (base.groupBy(*CLIENT_GRAIN)
            .agg(money(F.sum("due_amount")).alias("due_amount"),
                 F.count_distinct("skp_credit_case").alias("cnt_case")))


def eligible_payments(t: Tables, cfg: C.MonitorConfig = C.DEFAULT) -> DataFrame:
    """Payments that count as repayment; only the four columns used later."""
    return (t.f_incoming_payment_tt.where(eligible_payment(cfg))
            .select("skp_client", "skp_credit_case", "date_payment_incoming", "amt_payment"))


def payment_pairs(base: DataFrame, payments: DataFrame,
                  cfg: C.MonitorConfig = C.DEFAULT) -> DataFrame:
    """Each base row with each eligible payment of its client and case made
    0..horizon days after generation (``days_after_gen`` added)."""
    anchors = base.select(*CLIENT_GRAIN, "skp_credit_case")
    pairs = within_horizon(anchors, payments, ["skp_client", "skp_credit_case"],
                           "extraction_date", "date_payment_incoming", cfg.horizon_days)
    return pairs.withColumn("days_after_gen",
                            days_between("date_payment_incoming", "extraction_date"))


def monitor_payment(base: DataFrame, payments: DataFrame,
                    cfg: C.MonitorConfig = C.DEFAULT) -> DataFrame:
    """Payments 0..horizon days after letter generation, summed per client,
    segment and payment day (``payments`` already filtered to eligible)."""
    pairs = payment_pairs(base, payments, cfg)
    return (pairs.groupBy(*CLIENT_GRAIN, "date_payment_incoming")
            .agg(money(F.sum("amt_payment")).alias("amt_payment"))
            .select(*CLIENT_GRAIN, "date_payment_incoming",
                    days_between("date_payment_incoming", "extraction_date").alias("days_after_gen"),
                    "amt_payment"))


def monitor_payment_cum(payment: DataFrame) -> DataFrame:
    """Running payment total per client and day since generation.

    The running sum is keyed by the client only (property, pilot, date,
    client), not by segment, so same-day payments of the client in other
    segments are included (RANGE frame).  Rows with a NULL client key
    cannot match themselves in the campaign SQL's key equality and drop out.
    """
    keyed = payment.where(F.expr(" AND ".join(f"{k} IS NOT NULL" for k in C.CLIENT_KEY))
                          & F.col("days_after_gen").isNotNull())
    out_cols = [*CLIENT_GRAIN, "days_after_gen", "amt_payment"]
    cum = running_total(keyed.select(*out_cols), C.CLIENT_KEY, "days_after_gen", "amt_payment")
    return cum.select(*CLIENT_GRAIN, "days_after_gen", money("amt_payment").alias("amt_payment"))
