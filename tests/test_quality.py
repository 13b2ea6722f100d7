"""Declared keys and what joins lose: planted duplicates are found, sums add up."""

import datetime as dt
import os

import duckdb
import pytest
from helpers import D, DIMENSIONS, M, case_360_plus, letter_result, payment, tables
from pyspark.sql import functions as F

import __spark_entry__ as E
from lettermon.operators.materialize import Store
from lettermon.operators.quality import DuplicateKeys, NotConserved, by_reason, checked, key_report, keyed
from lettermon.plans.pipeline import Monitor
from lettermon.sources.schemas import KEYS, SCHEMAS

SF = "/root/testdata/sf0.01"


def dim(spark):
    rows = [(1, "a"), (2, "b"), (2, "b"), (2, "c"), (None, "n"), (3, None)]
    return spark.createDataFrame(rows, "k int, v string")


def test_key_report(spark):
    assert tuple(key_report(dim(spark), "t", ["k"]).first()) == ("t", 6, 3, 2, 1)
    assert tuple(key_report(dim(spark).limit(0), "t", ["k"]).first()) == ("t", 0, 0, 0, 0)


def test_keyed_splits_every_row_once(spark):
    kept, offenders = keyed(dim(spark), ["k"])
    assert sorted(map(tuple, kept.collect())) == [(1, "a"), (2, "b"), (3, None)]
    assert sorted(map(tuple, offenders.collect()), key=str) == [(2, "b", 1), (2, "c", 1), (None, "n", 1)]


def test_checked_policies(spark):
    whole = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert checked(whole, "t", ["k"], "fail", Store(spark)).count() == 2
    with pytest.raises(DuplicateKeys, match="6 rows, 4 keys"):
        checked(dim(spark), "t", ["k"], "fail", Store(spark))
    store = Store(spark)
    assert checked(dim(spark), "t", ["k"], "quarantine", store).count() == 3
    assert store.get("offenders_t").agg(F.sum("__rows")).first()[0] == 3
    with pytest.raises(ValueError, match="policy"):
        checked(whole, "t", ["k"], "ignore", store)


def _campaign(spark, **more):
    day, decision = D(2019, 11, 5), D(2018, 1, 1)
    rows = dict(
        prel_letter_infor_4=[case_360_plus(1, "Chal1", day, 10, "100.00"), case_360_plus(2, "Cham1", day, 20, "50.00")],
        dc_credit_case=[(10, decision, 5, 1, 2, 1), (20, decision, 5, 1, 2, 1)],
        dc_contract=[(1, 10, decision, 5), (2, 20, decision, 5)], dc_product=[(5, 2, "X")],
        dpd_snapshot=[(10, day, 1), (20, day, 1)], ft_coll_provision_rate=[("WCL", "B1", M("0.5"))], **DIMENSIONS)
    return tables(spark, **{**rows, **more})


@pytest.mark.parametrize("name, row", [
    ("dc_product", (5, 2, "Z")), ("ft_coll_provision_rate", ("WCL", "B1", M("0.7"))),
    ("dc_dpd_tol_bucket", (1, "B1")), ("dpd_snapshot", (10, D(2019, 11, 5), 1))])
def test_a_planted_duplicate_multiplies_money_unless_checked(spark, name, row):
    def amount(t):
        return Monitor(t).provision().agg(F.sum("amt_provision")).first()[0]
    right = amount(_campaign(spark))
    clean = [tuple(r) for r in _campaign(spark)[name].collect()]
    planted = _campaign(spark, **{name: [*clean, row]})
    if name != "dc_product":  # the product groups are made distinct anyway
        assert amount(planted) > right
    with pytest.raises(DuplicateKeys, match=name):
        amount(planted.with_checked_keys("fail", Store(spark)))
    store = Store(spark)
    assert amount(planted.with_checked_keys("quarantine", store)) == right
    assert store.get(f"offenders_{name}").count() == 1


def test_keys_name_columns_of_their_tables():
    assert all(set(keys) <= set(SCHEMAS[name].names) for name, keys in KEYS.items())


def test_by_reason_conserves(spark):
    rows = spark.createDataFrame([("p", None, M("1.00")), ("p", 1, M("2.00")), (None, 1, M("3.00"))], "g string, k int, amt decimal(9,2)")
    got = by_reason(rows, F.when(F.col("k").isNull(), "null_k").otherwise("reported"), ["g"], ["amt"], Store(spark), "audit")
    assert sorted(map(tuple, got.collect()), key=str) == [("p", "null_k", 1, M("1.00")), ("p", "reported", 1, M("2.00")), (None, "reported", 1, M("3.00"))]
    assert by_reason(rows.limit(0), F.lit("reported"), ["g"], ["amt"], Store(spark), "audit").collect() == []


def test_rows_that_change_under_the_audit_are_noticed(spark):
    class Lossy(Store):
        def put(self, name, df, partition_by=None):
            return super().put(name, df, partition_by).where("reason = 'reported'")
    rows = spark.createDataFrame([(1, M("1.00")), (None, M("2.00"))], "k int, amt decimal(9,2)")
    with pytest.raises(NotConserved, match="cnt_rows 2 before, 1 after"):
        by_reason(rows, F.when(F.col("k").isNull(), "null_k").otherwise("reported"), [], ["amt"], Lossy(spark), "audit")


def test_reasons_of_lost_cases_and_payments(spark):
    day, old = D(2019, 11, 5), D(2019, 1, 1)
    t = tables(
        spark,
        prel_letter_infor_4=[case_360_plus(1, "Chal1", day, 10, "100.00"), case_360_plus(2, "Chal1", day, 20, "50.00"),
                             case_360_plus(3, "Chal1", day, 30, "7.00"), case_360_plus(4, "Hold", day, 40, "9.00"),
                             case_360_plus(5, "Chal1", D(2019, 10, 1), 50, "1.00")],
        ppl2_chch_client_list_tmp=[(day, 1, "361-450"), (day, 3, "361-450"), (day, 4, "361-450")],
        f_letter_result_tt=[letter_result(day, 10, 13, "Delivered"), letter_result(day, 20, 13, "Delivered"),
                            letter_result(day, 30, 121, "Delivered"), letter_result(day, 40, 13, "Delivered")],
        f_incoming_payment_tt=[payment(1, 10, day + dt.timedelta(days=2), "5.00"), payment(4, 40, day + dt.timedelta(days=2), "6.00"),
                               payment(1, 10, old, "70.00")])
    m = Monitor(t, store=Store(spark))
    cases = {r.reason: (r.cnt_rows, r.due_amount) for r in m.case_losses().collect()}
    assert cases == {"reported": (2, M("109.00")), "no_cpd_range": (1, M("50.00")), "no_letter_result": (1, M("7.00"))}
    paid = {r.reason: (r.cnt_rows, r.amt_payment) for r in m.payment_losses().collect()}
    assert paid == {"reported": (1, M("5.00")), "null_text_delivery_result_more": (1, M("6.00"))}
    clients = {r.reason: (r.cnt_rows, r.due_amount) for r in m.client_losses().collect()}
    assert clients == {"no_rate": (1, M("100.00")), "null_text_delivery_result_more": (1, M("9.00"))}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")
def test_losses_of_the_reports_at_sf001(spark):
    """Report 1 shows 470,506,411.04 of 617,955,805.21 paid; audit and report agree to the cent."""
    audit = E.queries()["d08_payment_losses"](spark, SF).collect()
    shown = sum(r.amt_payment for r in audit if r.reason == "reported")
    assert (shown, sum(r.amt_payment for r in audit)) == (M("470506411.04"), M("617955805.21"))
    report = E.queries()["q10_daily_recovery"](spark, SF)
    assert report.agg(F.sum("amt_payment")).first()[0] == shown
    con = duckdb.connect()
    for v in ("orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{SF}/{v}.parquet')")
    assert con.sql(f"SELECT sum(amt_payment) FROM ({E.oracle_sql()['q08_monitor_payment']})").fetchall()[0][0] == sum(r.amt_payment for r in audit)
