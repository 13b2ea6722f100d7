"""Campaign configuration: arms, pilot groups, delivery classes, options.

Everything the pipeline needs to know about the letter campaigns lives here,
so the plan builders stay free of literals.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Fixed values. These must equal the campaign definitions exactly (they are
# compared as case-sensitive text); the misspelt class label and the
# open-ended top age bucket label are kept on purpose.
# --------------------------------------------------------------------------
PROPERTY_360_PLUS = "360+"
PROPERTY_360_MINUS = "360-"
PROPERTY_IEXA = "IEXA"

START_360_PLUS = dt.date(2019, 10, 31)
START_360_MINUS = dt.date(2019, 11, 18)
START_IEXA = dt.date(2019, 11, 13)

LETTER_TYPE_360_PLUS = 13
LETTER_TYPE_360_MINUS = 121
LETTER_TYPE_IEXA = 221

NO_LETTER_PILOTS = ("Cham1", "Cham2")
LETTER_PILOTS = ("Chal1", "Chal2")
BASE_PILOT = "Chal1"

NOT_SENDING = "Not sending"
DELIVERED = "Delivered"
UNDELIVERED = "Un-deliverd"
DELIVERED_TEXTS = (
    "Customer request to delay posting",
    "Delivered",
    "Delivered to client",
    "Delivered to others",
    "Delivered to self pick-up site",
    "Customer will pickup",
)
UNDELIVERED_TEXTS = (
    "退件",
    "Delivery address and name is invalid",
    "Return to Post office",
    "Return to Post Office (assume)",
)

NO_AGE_BUCKET = "XNA"
AGE_BUCKET_DAYS = 7
AGE_BUCKET_COUNT = 9
AGE_BUCKET_TOP_LABEL = "63-70"

PAYMENT_START = dt.date(2019, 10, 31)
PAYMENT_HORIZON_DAYS = 30
PAYMENT_WAIVE_FLAG = "N"
PAYMENT_STATUS = "a"
PAYMENT_TYPE_MIN = 1
PAYMENT_TYPE_MAX = 2
PAYMENT_OVERPAY_FLAG = "N"

# Product group rules, first match wins (see functions.exprs.product_group).
ACQ_EXTREME = "EXTREME"
CREDIT_TYPE_SS = "SS"
CREDIT_TYPE_SC = "SC"
CHANNEL_XSELL = 1
CHANNEL_XSELL_STUP = 201
CHANNEL_WALKIN = 2
XSELL_NEW_AFTER = dt.date(2017, 12, 31)
ACL_CODE_PREFIX = "FCACL"
GOODS_MOTORBIKE = "Motorbike"
GROUP_ESHOP = "ESHOP"
GROUP_MCL = "MCL"
GROUP_XCL_STD_NEW = "XCL_STD_NEW"
GROUP_XCL_STD_OLD = "XCL_STD_OLD"
GROUP_XCL_STUP = "XCL_STUP"
GROUP_ACL = "ACL"
GROUP_WCL = "WCL"
GROUP_TW = "TW"
GROUP_CD = "CD"
# --------------------------------------------------------------------------

# Key sets used throughout (names of monitor_base columns).
CLIENT_KEY = ("property", "pilot", "extraction_date", "skp_client")
SEGMENT = (
    "property",
    "pilot",
    "extraction_date",
    "text_delivery_result",
    "text_delivery_result_more",
    "cpd_ranges",
    "days_exa_assignment_group",
)


@dataclass(frozen=True)
class Arm:
    """One letter campaign ("property") and where its cases come from.

    ``columns`` maps the arm's source column names onto the common names
    (pilot, extraction_date, date_assigned, cpd_ranges) so the three arms
    can be unioned by name.  ``client_list`` names the per-client CPD table
    joined on (extraction_date = selection_date, skp_client); ``None`` means
    the CPD range is a column of the case table itself.  ``age_buckets``
    False means the arm has no assignment date: it gets the ISO-week start
    of the extraction date and the constant bucket label.
    """

    property: str
    source: str
    start: dt.date
    letter_type: int
    columns: dict = field(default_factory=dict)
    client_list: str | None = None
    age_buckets: bool = True


ARMS = (
    Arm(
        property=PROPERTY_360_PLUS,
        source="prel_letter_infor_4",
        start=START_360_PLUS,
        letter_type=LETTER_TYPE_360_PLUS,
        client_list="ppl2_chch_client_list_tmp",
    ),
    Arm(
        property=PROPERTY_360_MINUS,
        source="preli_360_lttr_hist",
        start=START_360_MINUS,
        letter_type=LETTER_TYPE_360_MINUS,
        columns={
            "group_name": "pilot",
            "date_generated": "extraction_date",
            "date_assignment": "date_assigned",
            "cpd_range": "cpd_ranges",
        },
    ),
    Arm(
        property=PROPERTY_IEXA,
        source="prel_letter_infor_iexa",
        start=START_IEXA,
        letter_type=LETTER_TYPE_IEXA,
        client_list="ppl2_iexa_client_list_tmp",
        age_buckets=False,
    ),
)


@dataclass(frozen=True)
class MonitorConfig:
    """Knobs of one monitor run.

    product_join: how contracts meet the product-group table.
        "product"       join on skp_product only, as the campaign SQL does
                        (many-to-many: a case is counted once per
                        (decision date, group) pair of its product);
        "product_date"  also match date_decision;
        "case"          also match the case: one group per case.
    null_safe_segments: match NULL segment keys in the report joins
        (plain ``=`` drops them, as the campaign SQL does).
    zero_provision: what a pilot whose provision is zero does to its rate:
        "fail" stops the run (division by zero), "null" gives a NULL rate.
    """

    arms: tuple = ARMS
    base_pilot: str = BASE_PILOT
    horizon_days: int = PAYMENT_HORIZON_DAYS
    payment_start: dt.date = PAYMENT_START
    product_join: str = "product"
    null_safe_segments: bool = False
    zero_provision: str = "fail"


DEFAULT = MonitorConfig()
