"""Campaign input tables derived from the TPC-H-like driver tables.

Test-data mapping (invented, see FIXTURES.md): an order is a credit case, a
customer is a client, a line item is an incoming payment, a part is a
product.  Every order lands in exactly one of the three campaign arms
(``o_orderkey % 3``), so the arms together cover the whole ``orders`` table
and every derived table grows with the driver data.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import SCHEMAS
from .tables import Tables

_ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
_LINEITEM = ("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_quantity")

# Column rules of the test-data mapping, as Spark SQL expressions over
# ``orders`` (one parse per table instead of one call per operator).
ED = "(DATE'2019-11-01' + CAST(o_orderkey % 35 AS INT))"
DEC = "(DATE'2013-06-30' + CAST(365 * (FLOOR(o_orderkey / 3) % 6) AS INT))"
PIL = ("CASE o_custkey % 5 WHEN 0 THEN 'Cham1' WHEN 1 THEN 'Cham2' WHEN 2 THEN 'Chal1' "
       "WHEN 3 THEN 'Chal2' ELSE 'Hold' END")
ASG = f"({ED} - CAST(FLOOR(o_orderkey / 3) % 75 - 2 AS INT))"
DUE = "CAST(o_totalprice AS DECIMAL(18,2))"
CPD = ("CASE o_custkey % 4 WHEN 0 THEN '361-450' WHEN 1 THEN '451-540' WHEN 2 THEN '541-720' "
       "ELSE '721+' END")
LT = "CASE o_orderkey % 3 WHEN 0 THEN 13 WHEN 1 THEN 121 ELSE 221 END"
TXT = ("CASE o_orderkey % 11 WHEN 0 THEN 'Delivered' WHEN 1 THEN 'Delivered to client' "
       "WHEN 2 THEN 'Customer will pickup' WHEN 3 THEN '退件' WHEN 4 THEN 'Return to Post office' "
       "WHEN 5 THEN 'In transit' WHEN 6 THEN CAST(NULL AS STRING) ELSE 'Delivered to others' END")
PROD = "CAST(FLOOR(o_orderkey / 7) % n_parts AS BIGINT)"  # n_parts: rows of part, so every product is used

ARM_FILTER = "o_orderkey % 3 = {k}"
DISTINCT_ROWS = ("ppl2_chch_client_list_tmp", "ppl2_iexa_client_list_tmp")  # one row per client/day

SELECTS = {
    "prel_letter_infor_4": (ARM_FILTER.format(k=0), [
        "o_custkey AS skp_client", f"{PIL} AS pilot", f"{DEC} AS date_decision",
        f"{ED} AS extraction_date", "o_orderkey AS skp_credit_case", f"{ASG} AS date_assigned",
        f"{DUE} AS due_amount"]),
    "preli_360_lttr_hist": (ARM_FILTER.format(k=1), [
        "o_custkey AS skp_client", f"{PIL} AS group_name", f"{DEC} AS date_decision",
        f"{ED} AS date_generated", "o_orderkey AS skp_credit_case", f"{ASG} AS date_assignment",
        f"{DUE} AS due_amount", f"{CPD} AS cpd_range"]),
    "prel_letter_infor_iexa": (ARM_FILTER.format(k=2), [
        "o_custkey AS skp_client", f"{PIL} AS pilot", f"{DEC} AS date_decision",
        f"{ED} AS extraction_date", "o_orderkey AS skp_credit_case", f"{DUE} AS due_amount"]),
    "ppl2_chch_client_list_tmp": (ARM_FILTER.format(k=0), [
        f"{ED} AS selection_date", "o_custkey AS skp_client", f"{CPD} AS cpd_ranges"]),
    "ppl2_iexa_client_list_tmp": (ARM_FILTER.format(k=2), [
        f"{ED} AS selection_date", "o_custkey AS skp_client", f"{CPD} AS cpd_ranges"]),
    "dc_credit_case": (None, [
        "o_orderkey AS skp_credit_case", f"{DEC} AS date_decision", f"{PROD} AS skp_product",
        "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS skp_credit_type",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 1 ELSE 2 END AS skp_credit_acquisition_chnl",
        "o_orderkey % 4 AS skp_goods_type_exp"]),
    "dc_contract": (None, [
        "o_custkey AS skp_client", "o_orderkey AS skp_credit_case", f"{DEC} AS date_decision",
        f"{PROD} AS skp_product"]),
    "dpd_snapshot": (None, [
        "o_orderkey AS skp_credit_case", f"{ED} AS extraction_date",
        "1 + o_orderkey % 4 AS skp_dpd_tol_bucket"]),
}
RESULT_ROWS = [f"{ED} AS date_generated", "o_orderkey AS skp_credit_case",
               f"{LT} AS skp_coll_letter_type"]
PAYMENT_ROWS = [
    "o_custkey AS skp_client", "o_orderkey AS skp_credit_case",
    f"{ED} + CAST((o_orderkey + l_linenumber * 13) % 40 - 3 AS INT) AS date_payment_incoming",
    "CAST(l_extendedprice AS DECIMAL(18,2)) AS amt_payment",
    "CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS flag_waive_payment",
    "CASE WHEN l_linenumber = 7 THEN 'c' ELSE 'a' END AS code_status",
    "1 + l_linenumber % 3 AS skp_incoming_payment_type",
    "CASE WHEN l_quantity >= 49 THEN 'Y' ELSE 'N' END AS flag_payment_overpay",
]
PRODUCT_ROWS = [
    "p_partkey AS skp_product",
    "CASE p_partkey % 5 WHEN 1 THEN 1 WHEN 2 THEN 201 WHEN 3 THEN 7 WHEN 4 THEN 2 ELSE 9 END"
    " AS skp_product_channel",
    "CASE WHEN p_partkey % 5 = 3 THEN 'FCACL' ELSE 'STD' END || CAST(p_partkey AS STRING)"
    " AS code_product",
]
DIMENSION_ROWS = {
    "cl_credit_type": [(1, "SS"), (2, "SC"), (3, "CL")],
    "cl_credit_acquisition_chnl": [(1, "EXTREME"), (2, "NORMAL")],
    "dc_goods_type": [(0, "Motorbike"), (1, "Mobile"), (2, "Furniture"), (3, "Other")],
    "dc_dpd_tol_bucket": [(1, "B1"), (2, "B2"), (3, "B3"), (4, "B4")],
}
RATE_GROUPS = ["ESHOP", "MCL", "XCL_STD_NEW", "XCL_STD_OLD", "XCL_STUP", "ACL", "WCL", "TW", "CD"]
RATE_BUCKETS = ["B1", "B2", "B3", "B4"]


def _rates() -> list:
    """Rate = (2 * group number + 5 * bucket number) / 100; TW x B4 has none."""
    return [(g, b, Decimal(gi * 2 + bi * 5) / Decimal(100))
            for gi, g in enumerate(RATE_GROUPS, 1)
            for bi, b in enumerate(RATE_BUCKETS, 1)
            if not (g == "TW" and b == "B4")]


def derive(spark: SparkSession, driver: Callable[[str], DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """Zero-argument builders of the sixteen campaign tables (built on use).

    ``driver(name)`` returns the driver table ``orders``, ``lineitem`` or
    ``part``.
    """
    def orders() -> DataFrame:
        n_parts = driver("part").agg(F.count(F.lit(1))).scalar()
        return driver("orders").select(*_ORDERS, n_parts.alias("n_parts"))

    def from_orders(name: str) -> Callable[[], DataFrame]:
        cond, exprs = SELECTS[name]

        def build() -> DataFrame:
            o = orders()
            df = (o.where(cond) if cond else o).selectExpr(*exprs)
            return df.distinct() if name in DISTINCT_ROWS else df
        return build

    def results() -> DataFrame:
        o = orders()
        return (o.where("o_orderkey % 17 <> 0")
                .selectExpr(*RESULT_ROWS, f"{TXT} AS text_delivery_result")
                .unionByName(o.where("o_orderkey % 97 = 5")
                             .selectExpr(*RESULT_ROWS, "'Delivered' AS text_delivery_result")))

    def payments() -> DataFrame:
        li = driver("lineitem").select(*_LINEITEM)
        o = orders()
        return li.join(o, li.l_orderkey == o.o_orderkey).selectExpr(*PAYMENT_ROWS)

    def product() -> DataFrame:
        return driver("part").selectExpr(*PRODUCT_ROWS)

    def values(name: str, rows: list) -> Callable[[], DataFrame]:
        return lambda: spark.createDataFrame(rows, SCHEMAS[name])

    out: dict[str, Callable[[], DataFrame]] = {n: from_orders(n) for n in SELECTS}
    out.update({n: values(n, rows) for n, rows in DIMENSION_ROWS.items()})
    out.update({
        "f_letter_result_tt": results,
        "f_incoming_payment_tt": payments,
        "dc_product": product,
        "ft_coll_provision_rate": values("ft_coll_provision_rate", _rates()),
    })
    return out


def fixture_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Tables for a driver data directory such as ``/root/testdata/sf0.01``."""
    root = sf_dir.rstrip("/")
    opened: dict[str, DataFrame] = {}

    def driver(name: str) -> DataFrame:
        if name not in opened:
            opened[name] = spark.read.parquet(f"{root}/{name}.parquet")
        return opened[name]

    return Tables.from_frames(derive(spark, driver))
