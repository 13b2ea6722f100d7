"""Hand-made campaign tables for edge-case tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from lettermon.sources.schemas import SCHEMAS
from lettermon.sources.tables import Tables

D = dt.date
M = Decimal

DIMENSIONS = {
    "cl_credit_type": [(1, "SS"), (2, "SC"), (3, "CL")],
    "cl_credit_acquisition_chnl": [(1, "EXTREME"), (2, "NORMAL")],
    "dc_goods_type": [(0, "Motorbike"), (1, "Mobile")],
    "dc_dpd_tol_bucket": [(1, "B1"), (2, "B2")],
}


def tables(spark, **rows) -> Tables:
    """Tables with the given rows (tuples in schema order); others empty."""
    frames = {}
    for name, schema in SCHEMAS.items():
        data = rows.get(name, DIMENSIONS.get(name, []))
        frames[name] = spark.createDataFrame(data, schema)
    return Tables.from_frames(frames)


def payment(client, case, day, amt, waive="N", status="a", ptype=1, overpay="N"):
    return (client, case, day, M(str(amt)), waive, status, ptype, overpay)


def letter_result(day, case, ltype, text):
    return (day, case, ltype, text)


def case_360_plus(client, pilot, day, case, due, assigned=None, decision=D(2018, 1, 1)):
    """A row of prel_letter_infor_4."""
    return (client, pilot, decision, day, case, assigned or day, M(str(due)))


def as_dicts(df, order=None):
    rows = [r.asDict() for r in df.collect()]
    if order:
        rows.sort(key=lambda r: tuple((r[k] is None, r[k]) for k in order))
    return rows
