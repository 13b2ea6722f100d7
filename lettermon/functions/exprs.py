"""Scalar Column expressions of the campaign monitor (all built-in, JVM-side)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def product_group(acq_channel, credit_type, product_channel, date_decision,
                  code_product, goods_category) -> Column:
    """Product group of a case, ordered first-match rules; default ``CD``."""
    acq, ct, ch = _col(acq_channel), _col(credit_type), _col(product_channel)
    return (
        F.when((acq == C.ACQ_EXTREME) & (ct == C.CREDIT_TYPE_SS), C.GROUP_ESHOP)
        .when((acq == C.ACQ_EXTREME) & (ct == C.CREDIT_TYPE_SC), C.GROUP_MCL)
        .when((ch == C.CHANNEL_XSELL) & (_col(date_decision) > F.lit(C.XSELL_NEW_AFTER)),
              C.GROUP_XCL_STD_NEW)
        .when(ch == C.CHANNEL_XSELL, C.GROUP_XCL_STD_OLD)
        .when(ch == C.CHANNEL_XSELL_STUP, C.GROUP_XCL_STUP)
        .when(_col(code_product).startswith(C.ACL_CODE_PREFIX), C.GROUP_ACL)
        .when(ch == C.CHANNEL_WALKIN, C.GROUP_WCL)
        .when(_col(goods_category) == C.GOODS_MOTORBIKE, C.GROUP_TW)
        .otherwise(C.GROUP_CD)
    )


def days_between(end, start) -> Column:
    """Whole days from ``start`` to ``end`` (date minus date), as INT."""
    return F.datediff(_col(end), _col(start))


def age_bucket(end, start) -> Column:
    """Assignment-age bucket label of ``end - start`` days.

    Seven-day buckets ``0-6`` … ``56-62`` (bucket ``k`` is labelled
    ``7k-(7k+6)``), everything from 63 days on in the top bucket; negative or
    NULL ages get NULL.
    """
    d, width = days_between(end, start), C.AGE_BUCKET_DAYS
    label = F.when(d >= C.AGE_BUCKET_COUNT * width, C.AGE_BUCKET_TOP_LABEL)
    for lo in range(0, C.AGE_BUCKET_COUNT * width, width):
        label = label.when(d.between(lo, lo + width - 1), f"{lo}-{lo + width - 1}")
    return label


def week_start(d) -> Column:
    """Monday of the ISO week containing ``d``."""
    return F.trunc(_col(d), "WEEK")


def delivery_detail(pilot, text) -> Column:
    """No-letter pilots → 'Not sending'; letter pilots → the raw text; else NULL."""
    p = _col(pilot)
    return (F.when(p.isin(*C.NO_LETTER_PILOTS), C.NOT_SENDING)
            .when(p.isin(*C.LETTER_PILOTS), _col(text)))


def delivery_class(pilot, text) -> Column:
    """Delivery class: 'Not sending', 'Delivered', 'Un-deliverd' or the raw text."""
    p, t = _col(pilot), _col(text)
    sent = p.isin(*C.LETTER_PILOTS)
    return (F.when(p.isin(*C.NO_LETTER_PILOTS), C.NOT_SENDING)
            .when(sent & t.isin(*C.DELIVERED_TEXTS), C.DELIVERED)
            .when(sent & t.isin(*C.UNDELIVERED_TEXTS), C.UNDELIVERED)
            .otherwise(t))


def eligible_payment(cfg=C.DEFAULT) -> Column:
    """Payment rows that count as a repayment."""
    return (
        (F.col("date_payment_incoming") >= F.lit(cfg.payment_start))
        & (F.col("flag_waive_payment") == C.PAYMENT_WAIVE_FLAG)
        & (F.col("code_status") == C.PAYMENT_STATUS)
        & F.col("skp_incoming_payment_type").between(C.PAYMENT_TYPE_MIN, C.PAYMENT_TYPE_MAX)
        & (F.col("flag_payment_overpay") == C.PAYMENT_OVERPAY_FLAG)
    )


def half(c) -> Column:
    """Exactly half of a decimal amount (no float rounding)."""
    return F.lit(Decimal("0.5")) * _col(c)


def ratio(num, den, zero: str = "fail") -> Column:
    """``num / den`` in double precision (both sides cast before dividing).
    A zero ``den`` fails under ANSI mode, or gives NULL if ``zero`` is ``"null"``."""
    n, d = _col(num).cast("double"), _col(den).cast("double")
    return F.try_divide(n, d) if zero == "null" else n / d


def money(c) -> Column:
    """Money sums in one wide exact type."""
    return _col(c).cast("decimal(38,2)")
