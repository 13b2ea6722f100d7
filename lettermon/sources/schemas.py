"""Declared input schemas (only the columns the pipeline reads)."""

from __future__ import annotations

from pyspark.sql import types as T

LONG = T.LongType()
INT = T.IntegerType()
STR = T.StringType()
DATE = T.DateType()
MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(9, 6)


def _schema(*cols):
    return T.StructType([T.StructField(name, typ, True) for name, typ in cols])


SCHEMAS: dict[str, T.StructType] = {
    "prel_letter_infor_4": _schema(
        ("skp_client", LONG), ("pilot", STR), ("date_decision", DATE),
        ("extraction_date", DATE), ("skp_credit_case", LONG),
        ("date_assigned", DATE), ("due_amount", MONEY),
    ),
    "preli_360_lttr_hist": _schema(
        ("skp_client", LONG), ("group_name", STR), ("date_decision", DATE),
        ("date_generated", DATE), ("skp_credit_case", LONG),
        ("date_assignment", DATE), ("due_amount", MONEY), ("cpd_range", STR),
    ),
    "prel_letter_infor_iexa": _schema(
        ("skp_client", LONG), ("pilot", STR), ("date_decision", DATE),
        ("extraction_date", DATE), ("skp_credit_case", LONG),
        ("due_amount", MONEY),
    ),
    "ppl2_chch_client_list_tmp": _schema(
        ("selection_date", DATE), ("skp_client", LONG), ("cpd_ranges", STR),
    ),
    "ppl2_iexa_client_list_tmp": _schema(
        ("selection_date", DATE), ("skp_client", LONG), ("cpd_ranges", STR),
    ),
    "f_letter_result_tt": _schema(
        ("date_generated", DATE), ("skp_credit_case", LONG),
        ("skp_coll_letter_type", INT), ("text_delivery_result", STR),
    ),
    "f_incoming_payment_tt": _schema(
        ("skp_client", LONG), ("skp_credit_case", LONG),
        ("date_payment_incoming", DATE), ("amt_payment", MONEY),
        ("flag_waive_payment", STR), ("code_status", STR),
        ("skp_incoming_payment_type", INT), ("flag_payment_overpay", STR),
    ),
    "dc_credit_case": _schema(
        ("skp_credit_case", LONG), ("date_decision", DATE), ("skp_product", LONG),
        ("skp_credit_type", INT), ("skp_credit_acquisition_chnl", INT),
        ("skp_goods_type_exp", LONG),
    ),
    "dc_product": _schema(
        ("skp_product", LONG), ("skp_product_channel", INT), ("code_product", STR),
    ),
    "cl_credit_type": _schema(("skp_credit_type", INT), ("code_credit_type", STR)),
    "cl_credit_acquisition_chnl": _schema(
        ("skp_credit_acquisition_chnl", INT), ("code_credit_acquisition_chnl", STR),
    ),
    "dc_goods_type": _schema(("skp_goods_type", LONG), ("name_goods_category_eng", STR)),
    "dc_contract": _schema(
        ("skp_client", LONG), ("skp_credit_case", LONG), ("date_decision", DATE),
        ("skp_product", LONG),
    ),
    "dc_dpd_tol_bucket": _schema(
        ("skp_dpd_tol_bucket", INT), ("code_dpd_tol_subbucket", STR),
    ),
    "ft_coll_provision_rate": _schema(
        ("product_group", STR), ("flag_bucket", STR), ("provision_rate", RATE),
    ),
    "dpd_snapshot": _schema(
        ("skp_credit_case", LONG), ("extraction_date", DATE), ("skp_dpd_tol_bucket", INT),
    ),
}

# The day that a row of a table is of.
DATED: dict[str, str] = {
    "prel_letter_infor_4": "extraction_date",
    "preli_360_lttr_hist": "date_generated",
    "prel_letter_infor_iexa": "extraction_date",
    "ppl2_chch_client_list_tmp": "selection_date",
    "ppl2_iexa_client_list_tmp": "selection_date",
    "f_letter_result_tt": "date_generated",
    "f_incoming_payment_tt": "date_payment_incoming",
    "dpd_snapshot": "extraction_date",
}

# Tables that joins take to have one row per key: a second one would multiply money.
KEYS: dict[str, tuple[str, ...]] = {
    "dc_product": ("skp_product",),
    "cl_credit_type": ("skp_credit_type",),
    "cl_credit_acquisition_chnl": ("skp_credit_acquisition_chnl",),
    "dc_goods_type": ("skp_goods_type",),
    "dc_dpd_tol_bucket": ("skp_dpd_tol_bucket",),
    "ft_coll_provision_rate": ("product_group", "flag_bucket"),
    "ppl2_chch_client_list_tmp": ("selection_date", "skp_client"),
    "ppl2_iexa_client_list_tmp": ("selection_date", "skp_client"),
    "dpd_snapshot": ("skp_credit_case", "extraction_date"),
}

# Text columns where an empty string means "no value" in the source systems.
EMPTY_AS_NULL: dict[str, tuple[str, ...]] = {
    "prel_letter_infor_4": ("pilot",),
    "preli_360_lttr_hist": ("group_name", "cpd_range"),
    "prel_letter_infor_iexa": ("pilot",),
    "ppl2_chch_client_list_tmp": ("cpd_ranges",),
    "ppl2_iexa_client_list_tmp": ("cpd_ranges",),
    "f_letter_result_tt": ("text_delivery_result",),
}
