"""Reports: daily recovery (report 1), repaid clients (report 2), diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.exprs import money
from ..operators.aggregates import threshold_agg
from ..operators.distinct import bitmap_counts, bitmap_pieces, rolled_up
from ..operators.joins import key_match
from ..operators.materialize import Store
from ..operators.ordering import numbered
from ..operators.quality import by_reason
from ..operators.windows import first_row_number, mask_repeats

SEGMENT = list(C.SEGMENT)
DAY = "days_after_gen"

REPORT1_COLUMNS = (*SEGMENT, DAY, "amt_payment", "due_amount", "cnt_client", "cnt_case")
THRESHOLDS = ("repaid", "half", "full")
SEGMENT_COUNTS = ["cnt_client", "cnt_case"]
#: Groups of the roll-up, from fine to coarse.
ROLLUP = {"segment": SEGMENT, "property_date": ["property", "extraction_date"], "property": ["property"]}
REPORT2_COLUMNS = (
    *SEGMENT, DAY, "adj_cnt_client", "cnt_client",
    *[f"cnt_client_{n}" for n in THRESHOLDS],
    *[f"adj_cnt_client_{n}" for n in THRESHOLDS],
    *[f"amt_{n}" for n in THRESHOLDS],
    *[f"adj_amt_{n}" for n in THRESHOLDS],
    "daily_provision_rate",
)


def segment_base(base: DataFrame, base_client: DataFrame | None = None) -> DataFrame:
    """Debt, distinct clients and distinct cases per segment.

    Two plain aggregates in two steps each (by segment and key, then by
    segment), where two distinct counts in one would expand every row.
    ``base_client`` is the first step of the clients if it is stored already:
    it has a row per segment and client."""
    if base_client is None:
        base_client = base.groupBy(*SEGMENT, "skp_client").agg(F.sum("due_amount").alias("due_amount"))
    clients = (base_client.groupBy(*SEGMENT).agg(money(F.sum("due_amount")).alias("due_amount"), F.count("skp_client").alias("cnt_client")))
    cases = (base.select(*SEGMENT, "skp_credit_case").distinct()
             .groupBy(*SEGMENT).agg(F.count("skp_credit_case").alias("cnt_case")))
    return clients.join(cases, key_match(clients, cases, SEGMENT, null_safe=True)).select(
        *[clients[c] for c in clients.columns], "cnt_case")


def segment_pieces(base: DataFrame) -> DataFrame:
    """Bitmaps of the clients and cases (by ``client_no``, ``case_no``) of each segment, with its debt."""
    return bitmap_pieces(base, SEGMENT, {"cnt_client": "client_no", "cnt_case": "case_no"}, {"due_amount": F.col("due_amount")})


def distinct_rollup(base: DataFrame) -> DataFrame:
    """Debt, distinct clients and cases per segment, per property and date,
    and per property (``level``), all from the bitmaps of one scan of ``base``."""
    pieces, out = segment_pieces(base), None
    for level, group in ROLLUP.items():
        pieces = rolled_up(pieces, group, ["due_amount"]) if out is not None else pieces
        counts = bitmap_counts(pieces, group, SEGMENT_COUNTS, ["due_amount"])
        rows = counts.select(F.lit(level).alias("level"), *(
            F.col(c) if c in group else F.lit(None).cast(base.schema[c].dataType).alias(c) for c in SEGMENT),
            money("due_amount").alias("due_amount"), *SEGMENT_COUNTS)
        out = rows if out is None else out.unionByName(rows)
    return out


def segment_payments(payment: DataFrame) -> DataFrame:
    """Payments per segment and day after generation.

    ``payment`` is monitor_payment or, equally, the un-aggregated payment
    pairs it sums (a sum of per-client sums is the sum)."""
    return (payment.groupBy(*SEGMENT, DAY)
            .agg(money(F.sum("amt_payment")).alias("amt_payment")))


def daily_recovery(base: DataFrame, payment: DataFrame, cfg: C.MonitorConfig = C.DEFAULT,
                   base_client: DataFrame | None = None) -> DataFrame:
    """Report 1: recovered amount per segment and day next to the segment's
    debt and client/case counts.

    Every segment is kept (left join); a segment whose keys contain NULL
    finds no payments under plain ``=`` (``cfg.null_safe_segments`` lets
    NULLs meet).  The debt and counts stay on the first row of the segment
    (earliest day, NULL day last) and are 0 on the others, so a pivot sum
    counts them once.  ``base_client`` is monitor_base_client if it is stored
    already; clients are then not gathered from ``base`` again.
    """
    b, p = segment_base(base, base_client), segment_payments(payment)
    joined = (b.join(p, key_match(b, p, SEGMENT, cfg.null_safe_segments), "left")
              .select(*[b[c] for c in b.columns], p[DAY], p["amt_payment"]))
    out = mask_repeats(joined, SEGMENT, DAY, ["due_amount", "cnt_client", "cnt_case"])
    return out.select(*REPORT1_COLUMNS)


def debt_paid(base_client: DataFrame, payment_cum: DataFrame) -> DataFrame:
    """Clients and amounts over each repayment threshold, per segment and day.

    Each client row meets the client's running totals on every payment day
    (joined on the client key only, across segments); non-payers form the
    NULL-day group with zero counts and NULL amounts.

    The segments of a client that paid on the same day hold the same running
    total, so equal totals are first reduced to one row with their number
    (``times``): a client with many segments meets days, not segments x days.
    """
    totals = (payment_cum.groupBy(*C.CLIENT_KEY, DAY, "amt_payment")
              .agg(F.count(F.lit(1)).alias("times")))
    a, b = base_client.alias("a"), totals.alias("b")
    joined = a.join(b, key_match(a, b, list(C.CLIENT_KEY)), "left").select(
        *[a[c] for c in SEGMENT], a["skp_client"], a["due_amount"],
        b[DAY], b["amt_payment"], b["times"])
    out = threshold_agg(joined, [*SEGMENT, DAY], "amt_payment", "due_amount", "skp_client", "times")
    return out.select(*SEGMENT, DAY, *[f"cnt_client_{n}" for n in THRESHOLDS],
                      *[money(f"amt_{n}").alias(f"amt_{n}") for n in THRESHOLDS])


def repaid_clients(base_client: DataFrame, payment_cum: DataFrame, rate: DataFrame,
                   cfg: C.MonitorConfig = C.DEFAULT) -> DataFrame:
    """Report 2: repaid clients per segment and day, raw and scaled by the
    daily provision rate of the segment's (property, date, pilot).

    Segments join ``debt_paid`` with plain ``=`` (NULL segments drop out)
    and the rate table inner (segments without a rate drop out).  The
    segment client count stays on the first row (NULL day last); the
    scaled count is repeated on every row.  Sorted by segment and day,
    NULLs last.  ``base_client`` has a row per segment and client, so its
    rows are the segment's distinct clients.
    """
    base = base_client.groupBy(*SEGMENT).agg(F.count("skp_client").alias("cnt_client"))
    paid = debt_paid(base_client, payment_cum)
    r = rate.select("property", "extraction_date", "pilot", "daily_provision_rate")
    j = (base.join(paid, key_match(base, paid, SEGMENT, cfg.null_safe_segments))
         .select(*[base[c] for c in base.columns],
                 *[paid[c] for c in paid.columns if c not in SEGMENT]))
    j = j.join(r, ["property", "extraction_date", "pilot"])
    k = F.col("daily_provision_rate")
    adj = {"adj_cnt_client": F.col("cnt_client") * k}
    adj.update({f"adj_cnt_client_{n}": F.col(f"cnt_client_{n}") * k for n in THRESHOLDS})
    adj.update({f"adj_amt_{n}": F.col(f"amt_{n}") * k for n in THRESHOLDS})
    j = j.withColumns(adj).withColumn("__rn", first_row_number(SEGMENT, DAY))
    j = j.withColumn("cnt_client", F.when(F.col("__rn") == 1, F.col("cnt_client")).otherwise(0))
    return in_report_order(j.select(*REPORT2_COLUMNS))


def in_report_order(report: DataFrame) -> DataFrame:
    """Sorted by segment and day, NULLs last (a report read back from files has no order)."""
    return report.orderBy(*[F.asc_nulls_last(c) for c in (*SEGMENT, DAY)])


def ranked(report: DataFrame, store: Store, name: str) -> DataFrame:
    """Report 2 with ``report_rank``, its rows' places in the promised order, as files without an order need it."""
    return numbered(report, [F.asc_nulls_last(c) for c in (*SEGMENT, DAY)], store, name, "report_rank")


def payment_losses(payment: DataFrame, store: Store) -> DataFrame:
    """Audit of report 1: what was paid, by property and by whether the report shows it.

    A segment finds its payments by plain ``=``, so those with a NULL in the
    segment are ``null_<first such column>`` instead of ``reported``."""
    return by_reason(payment, _null_segment().otherwise("reported"), ["property"], ["amt_payment"], store, "payment_losses")


def client_losses(base_client: DataFrame, rate: DataFrame, store: Store) -> DataFrame:
    """Audit of report 2: clients per segment (rows) and their debt, by property and by whether the report shows them.

    Segments with a NULL drop out of the join with their repayments
    (``null_<column>``), those without a daily rate of the join with it (``no_rate``)."""
    rated = rate.select("property", "extraction_date", "pilot", F.lit(True).alias("rated")).distinct()
    rows = base_client.join(rated, ["property", "extraction_date", "pilot"], "left")
    reason = _null_segment().when(F.col("rated").isNull(), "no_rate").otherwise("reported")
    return by_reason(rows, reason, ["property"], ["due_amount"], store, "client_losses")


def _null_segment() -> Column:
    out = F.when(F.lit(False), "")
    for c in SEGMENT:
        out = out.when(F.col(c).isNull(), f"null_{c}")
    return out


def provision_coverage(rate: DataFrame) -> DataFrame:
    """Rows of the daily rate table per extraction date and property."""
    return (rate.groupBy("extraction_date", "property").agg(F.count(F.lit(1)).alias("cnt_rows"))
            .orderBy("extraction_date"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
