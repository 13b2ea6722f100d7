"""Edge cases of the whole monitor on hand-made tables (FIXTURES.md section 4)."""

from decimal import Decimal as M

import pytest

from lettermon.plans.pipeline import Monitor

from helpers import D, as_dicts, case_360_plus, letter_result, payment, tables

ED = D(2019, 11, 4)
SEG = ("property", "pilot", "extraction_date", "text_delivery_result",
       "text_delivery_result_more", "cpd_ranges", "days_exa_assignment_group")


@pytest.fixture(scope="module")
def monitor(spark):
    cases = [
        case_360_plus(1, "Chal1", ED, 11, "100.00", assigned=D(2019, 11, 1)),
        case_360_plus(2, "Chal1", ED, 21, "200.00", assigned=D(2019, 11, 1)),
        case_360_plus(3, "Hold", ED, 31, "50.00", assigned=D(2019, 11, 1)),
        case_360_plus(4, "Cham1", D(2019, 10, 30), 41, "70.00"),   # before the pilot start
        case_360_plus(4, "Cham1", D(2019, 10, 31), 51, "80.00"),   # on the pilot start
    ]
    cpd = [(ED, c, "361-450") for c in (1, 2, 3)] + [(D(2019, 10, 30), 4, "361-450"),
                                                      (D(2019, 10, 31), 4, "361-450")]
    results = [
        letter_result(ED, 11, 13, "Delivered"),
        letter_result(ED, 21, 13, "Delivered"), letter_result(ED, 21, 13, "Delivered"),  # duplicate
        letter_result(ED, 31, 13, "Delivered to client"),
        letter_result(D(2019, 10, 30), 41, 13, None),
        letter_result(D(2019, 10, 31), 51, 13, None),
        letter_result(ED, 11, 121, "Delivered"),  # other letter type: ignored
    ]
    pays = [
        payment(1, 11, D(2019, 11, 3), "5.00"),    # day -1: out
        payment(1, 11, ED, "30.00"),               # day 0
        payment(1, 11, D(2019, 11, 5), "99.00", waive="Y"),
        payment(1, 11, D(2019, 11, 5), "99.00", status="c"),
        payment(1, 11, D(2019, 11, 5), "99.00", ptype=3),
        payment(1, 11, D(2019, 11, 5), "99.00", overpay="Y"),
        payment(1, 11, D(2019, 11, 9), "30.00"),   # day 5
        payment(1, 11, D(2019, 12, 5), "7.00"),    # day 31: out
        payment(2, 21, D(2019, 11, 6), "200.00", ptype=2),  # day 2, base row doubled
        payment(3, 31, D(2019, 11, 5), "10.00"),   # NULL-segment client
    ]
    dec = D(2018, 1, 1)
    t = tables(
        spark,
        prel_letter_infor_4=cases,
        ppl2_chch_client_list_tmp=cpd,
        f_letter_result_tt=results,
        f_incoming_payment_tt=pays,
        dc_credit_case=[(c, dec, 1, 3, 2, 1) for c in (11, 21, 31, 41, 51)],
        dc_product=[(1, 9, "STD1")],
        dc_contract=[(cl, c, dec, 1) for cl, c in ((1, 11), (2, 21), (3, 31), (4, 41), (4, 51))],
        dpd_snapshot=[(11, ED, 1), (21, ED, 1), (31, ED, 1), (41, D(2019, 10, 30), 1),
                      (51, D(2019, 10, 31), 1)],
        ft_coll_provision_rate=[("CD", "B1", M("0.100000"))],
    )
    return Monitor(t)


def test_base_rows(monitor):
    rows = as_dicts(monitor.base(), ["skp_credit_case"])
    assert [r["skp_credit_case"] for r in rows] == [11, 21, 21, 31, 51]
    hold = rows[3]
    assert hold["text_delivery_result_more"] is None
    assert hold["text_delivery_result"] == "Delivered to client"
    cham = rows[4]
    assert (cham["text_delivery_result"], cham["text_delivery_result_more"]) == ("Not sending",) * 2
    assert rows[0]["days_exa_assignment_group"] == "0-6"


def test_payment_window_and_flags(monitor):
    rows = as_dicts(monitor.payment(), ["skp_client", "days_after_gen"])
    assert [(r["skp_client"], r["days_after_gen"], r["amt_payment"]) for r in rows] == [
        (1, 0, M("30.00")), (1, 5, M("30.00")), (2, 2, M("400.00")), (3, 1, M("10.00"))]


def test_running_total(monitor):
    rows = as_dicts(monitor.payment_cum(), ["skp_client", "days_after_gen"])
    assert [(r["skp_client"], r["days_after_gen"], r["amt_payment"]) for r in rows] == [
        (1, 0, M("30.00")), (1, 5, M("60.00")), (2, 2, M("400.00")), (3, 1, M("10.00"))]


def test_daily_rate(monitor):
    got = {(r["extraction_date"], r["pilot"]): r["daily_provision_rate"]
           for r in as_dicts(monitor.daily_provision_rate())}
    assert got == {(ED, "Chal1"): 1.0, (ED, "Hold"): 6.0}  # 2019-10-31 has no Chal1: no rows


def test_report1(monitor):
    rows = as_dicts(monitor.daily_recovery(), ["pilot", "days_after_gen"])
    chal = [r for r in rows if r["pilot"] == "Chal1"]
    assert [(r["days_after_gen"], r["amt_payment"], r["due_amount"], r["cnt_client"], r["cnt_case"])
            for r in chal] == [(0, M("30.00"), M("500.00"), 2, 2), (2, M("400.00"), 0, 0, 0),
                               (5, M("30.00"), 0, 0, 0)]
    hold = [r for r in rows if r["pilot"] == "Hold"]
    assert [(r["days_after_gen"], r["amt_payment"], r["due_amount"]) for r in hold] == [
        (None, None, M("50.00"))]  # NULL segment key: payments never meet it
    cham = [r for r in rows if r["pilot"] == "Cham1"]
    assert [(r["extraction_date"], r["days_after_gen"], r["due_amount"]) for r in cham] == [
        (D(2019, 10, 31), None, M("80.00"))]
    # masking keeps the debt total
    assert sum(r["due_amount"] for r in rows) == M("630.00")


def test_report2(monitor):
    rows = as_dicts(monitor.repaid_clients())
    assert [r["pilot"] for r in rows] == ["Chal1"] * 3  # Hold: NULL segment; Cham1: no rate
    got = [(r["days_after_gen"], r["cnt_client"], r["cnt_client_repaid"], r["cnt_client_half"],
            r["cnt_client_full"], r["amt_repaid"], r["amt_half"], r["amt_full"]) for r in rows]
    assert got == [
        (0, 2, 1, 0, 0, M("30.00"), None, None),
        (2, 0, 1, 1, 1, M("400.00"), M("400.00"), M("400.00")),
        (5, 0, 1, 1, 0, M("60.00"), M("60.00"), None),
    ]
    assert all(r["adj_cnt_client"] == 2.0 and r["daily_provision_rate"] == 1.0 for r in rows)


def test_null_safe_option(spark, monitor):
    from dataclasses import replace
    m = Monitor(monitor.t, replace(monitor.cfg, null_safe_segments=True))
    hold = [r for r in as_dicts(m.daily_recovery()) if r["pilot"] == "Hold"]
    assert [(r["days_after_gen"], r["amt_payment"]) for r in hold] == [(1, M("10.00"))]


def test_cross_segment_counts(spark):
    """One client in two segments, both paying 10 on day 3."""
    cases = [case_360_plus(1, "Chal1", ED, 11, "100.00", assigned=D(2019, 11, 1)),
             case_360_plus(1, "Chal1", ED, 12, "100.00", assigned=D(2019, 10, 20))]
    t = tables(
        spark,
        prel_letter_infor_4=cases,
        ppl2_chch_client_list_tmp=[(ED, 1, "361-450")],
        f_letter_result_tt=[letter_result(ED, 11, 13, "Delivered"),
                            letter_result(ED, 12, 13, "Delivered")],
        f_incoming_payment_tt=[payment(1, 11, D(2019, 11, 7), "10.00"),
                               payment(1, 12, D(2019, 11, 7), "10.00")],
        dc_credit_case=[(c, D(2018, 1, 1), 1, 3, 2, 1) for c in (11, 12)],
        dc_product=[(1, 9, "STD1")],
        dc_contract=[(1, c, D(2018, 1, 1), 1) for c in (11, 12)],
        dpd_snapshot=[(11, ED, 1), (12, ED, 1)],
        ft_coll_provision_rate=[("CD", "B1", M("0.100000"))],
    )
    m = Monitor(t)
    cum = as_dicts(m.payment_cum(), ["days_exa_assignment_group"])
    assert [r["amt_payment"] for r in cum] == [M("20.00"), M("20.00")]
    rep = as_dicts(m.repaid_clients(), ["days_exa_assignment_group"])
    assert [(r["days_exa_assignment_group"], r["cnt_client_repaid"]) for r in rep] == [
        ("0-6", 2), ("14-20", 2)]


def test_missing_rate_drops_provision_rows(spark):
    """A (group, bucket) pair without a provision rate drops out of provision."""
    dec = D(2018, 1, 1)
    t = tables(
        spark,
        prel_letter_infor_4=[case_360_plus(1, "Chal1", ED, 11, "100.00"),
                             case_360_plus(2, "Chal1", ED, 12, "300.00")],
        dc_credit_case=[(c, dec, 1, 3, 2, 1) for c in (11, 12)],
        dc_product=[(1, 9, "STD1")],
        dc_contract=[(1, 11, dec, 1), (2, 12, dec, 1)],
        dpd_snapshot=[(11, ED, 1), (12, ED, 2)],          # case 12 sits in bucket B2
        ft_coll_provision_rate=[("CD", "B1", M("0.100000"))],  # no CD x B2 rate
    )
    m = Monitor(t)
    prov = as_dicts(m.provision())
    assert [(r["code_dpd_tol_subbucket"], r["amt_receivable"], r["amt_provision"], r["cnt_case"])
            for r in prov] == [("B1", M("100.00"), M("10.00000000"), 1)]
    assert as_dicts(m.daily_provision_rate())[0]["daily_provision_rate"] == 1.0


def test_product_join_options_on_mismatched_products(spark):
    """A contract that holds another product than its credit case: no option but "product" may pair them."""
    from dataclasses import replace
    dec, later = D(2018, 1, 1), D(2019, 1, 1)
    t = tables(
        spark,
        prel_letter_infor_4=[case_360_plus(1, "Chal1", ED, 11, "100.00"), case_360_plus(2, "Chal1", ED, 12, "300.00"),
                             case_360_plus(3, "Chal1", ED, 13, "7.00", decision=later)],
        dc_credit_case=[(11, dec, 1, 3, 2, 1), (12, dec, 1, 3, 2, 1), (13, later, 2, 3, 2, 1)],
        dc_product=[(1, 9, "STD1"), (2, 2, "STD2")],
        dc_contract=[(1, 11, dec, 1), (2, 12, dec, 2), (3, 13, later, 2)],  # case 12's contract has product 2
    )
    got = {}
    for mode in ("product", "product_date", "case"):
        rows = as_dicts(Monitor(t, replace(Monitor(t).cfg, product_join=mode)).client_products(), ["skp_credit_case"])
        got[mode] = [(r["skp_credit_case"], r["product_group"]) for r in rows]
    assert got == {"product": [(11, "CD"), (12, "WCL"), (13, "WCL")], "product_date": [(11, "CD"), (13, "WCL")],
                   "case": [(11, "CD"), (13, "WCL")]}


def test_pilot_without_provision(spark):
    from dataclasses import replace

    from pyspark.errors import ArithmeticException
    dec = D(2018, 1, 1)
    t = tables(
        spark,
        prel_letter_infor_4=[case_360_plus(1, "Chal1", ED, 11, "100.00"), case_360_plus(2, "Cham1", ED, 12, "0.00")],
        dc_credit_case=[(c, dec, 1, 3, 2, 1) for c in (11, 12)], dc_product=[(1, 9, "STD1")],
        dc_contract=[(1, 11, dec, 1), (2, 12, dec, 1)], dpd_snapshot=[(11, ED, 1), (12, ED, 1)],
        ft_coll_provision_rate=[("CD", "B1", M("0.100000"))])
    safe = Monitor(t, replace(Monitor(t).cfg, zero_provision="null")).daily_provision_rate()
    assert {r["pilot"]: r["daily_provision_rate"] for r in safe.collect()} == {"Chal1": 1.0, "Cham1": None}
    with pytest.raises(ArithmeticException):
        Monitor(t).daily_provision_rate().collect()
