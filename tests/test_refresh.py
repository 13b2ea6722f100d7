"""A refresh equals a full rebuild; a failed run leaves the tables of the run before."""

import datetime as dt
import os

import pytest
from helpers import D, case_360_plus, letter_result, payment, tables
from pyspark.sql import functions as F

from lettermon.config import DEFAULT
from lettermon.operators.materialize import Store
from lettermon.operators.publish import Versions
from lettermon.plans import monitor as M
from lettermon.plans import reports as R
from lettermon.plans.pipeline import SINKS, Monitor, run
from lettermon.plans.refresh import DATED_SINKS, between, open_since, refresh
from lettermon.sources.fixtures import fixture_tables

SF = "/root/testdata/sf0.001"
REPORTS = ("daily_recovery", "repaid_clients")
need_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@need_data
@pytest.mark.parametrize("day", [D(2019, 12, 20)])
def test_refresh_equals_rebuild(spark, day):
    t, out = fixture_tables(spark, SF), Store(spark).root
    first = run(between(t, last=day), out, partition_sinks=True)
    before = first["daily_recovery"].count()
    reports = refresh(t, out, day)
    whole = Monitor(t, store=Store(spark))
    for name in SINKS:
        assert same(whole.shared(name), spark.read.parquet(f"{out}/{name}")), name
    assert same(whole.daily_recovery(), reports["daily_recovery"]) and same(whole.repaid_clients(), reports["repaid_clients"])
    assert reports["daily_recovery"].count() > before  # there was something to add


@need_data
def test_closed_dates_are_not_written_again(spark):
    t, out, day = fixture_tables(spark, SF), Store(spark).root, D(2019, 12, 20)
    run(between(t, last=day), out, partition_sinks=True)
    folder = out.removeprefix("file:")

    def files():
        return {n: {p: sorted(os.listdir(f"{folder}/{n}/{p}")) for p in os.listdir(f"{folder}/{n}") if "=" in p} for n in DATED_SINKS}
    old = files()
    refresh(t, out, day)
    since = open_since(day).isoformat()
    for name, dates in files().items():
        for date, parts in dates.items():
            assert (parts == old[name].get(date)) == (date.split("=")[1] < since), (name, date)


def _small(spark, late):
    """Cases of two days; ``late``: also a payment and a letter result that came late, and a case that was withdrawn."""
    a, b = D(2019, 11, 5), D(2019, 11, 20)
    cases = [case_360_plus(1, "Chal1", a, 10, "100.00"), case_360_plus(2, "Chal1", b, 20, "50.00")]
    gone = case_360_plus(3, "Chal1", D(2019, 11, 21), 30, "7.00")
    results = [letter_result(a, 10, 13, "Delivered"), letter_result(D(2019, 11, 21), 30, 13, "Delivered")]
    paid = [payment(1, 10, a + dt.timedelta(days=1), "5.00")]
    if late:
        results.append(letter_result(b, 20, 13, "Delivered"))
        paid += [payment(1, 10, a + dt.timedelta(days=30), "20.00"), payment(2, 20, b + dt.timedelta(days=3), "30.00")]
    return tables(spark, prel_letter_infor_4=cases if late else [*cases, gone], f_letter_result_tt=results, f_incoming_payment_tt=paid,
                  ppl2_chch_client_list_tmp=[(a, 1, "x"), (b, 2, "x"), (D(2019, 11, 21), 3, "x")])


def test_late_rows_and_a_day_that_lost_its_rows(spark):
    out = Store(spark).root
    run(_small(spark, False), out, partition_sinks=True)
    assert spark.read.parquet(f"{out}/monitor_base").count() == 2
    # known up to 5 December, rows up to two days late: dates from 3 November on are open
    refresh(_small(spark, True), out, D(2019, 12, 5), late_days=2)
    whole = Monitor(_small(spark, True), store=Store(spark))
    for name in DATED_SINKS:
        assert same(whole.shared(name), spark.read.parquet(f"{out}/{name}")), name
    assert {r.skp_credit_case for r in spark.read.parquet(f"{out}/monitor_base").collect()} == {10, 20}


def test_open_dates():
    assert open_since(D(2019, 12, 31)) == D(2019, 12, 1)
    assert open_since(D(2019, 12, 31), late_days=5) == D(2019, 11, 26)
    assert DEFAULT.horizon_days == 30


def test_a_failure_while_building_leaves_the_tables(spark, monkeypatch):
    out = Store(spark).root
    run(_small(spark, False), out, partition_sinks=True)
    old = spark.read.parquet(f"{out}/monitor_payment").collect()
    monkeypatch.setattr(Monitor, "payment_cum", lambda self: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        refresh(_small(spark, True), out, D(2019, 12, 5), late_days=2)
    assert spark.read.parquet(f"{out}/monitor_payment").collect() == old


def test_versions_appear_at_once(spark, monkeypatch):
    out = Store(spark).root
    versions = Versions(spark, out)
    assert versions.current() is None and versions.expired() == []
    with pytest.raises(FileNotFoundError):
        versions.read("monitor_base")
    run(_small(spark, False), out, versioned=True)
    first = versions.current()
    kept = {n: versions.read(n).collect() for n in (*SINKS, *REPORTS)}
    assert len(kept["monitor_base"]) == 2

    def fails(self):
        raise RuntimeError("killed in K04")
    with monkeypatch.context() as patch:
        patch.setattr(Monitor, "payment", fails)
        with pytest.raises(RuntimeError, match="K04"):
            run(_small(spark, True), out, versioned=True)
    assert versions.current() == first
    assert {n: versions.read(n).collect() for n in kept} == kept
    reports = run(_small(spark, True), out, versioned=True)
    assert versions.current() != first and versions.history()[1:] == [first]
    assert reports["daily_recovery"].count() > 0
    assert {r.skp_credit_case for r in versions.read("monitor_base").collect()} == {10, 20}
    # a reader that holds the version before still has it
    assert versions.read("monitor_base", first).collect() == kept["monitor_base"]
    assert versions.expired(1) == [versions.path(first)]


@need_data
def test_report_files_carry_the_order(spark):
    """K07: the CSV files, read in the order of their names, are the sorted report."""
    out = Store(spark).root
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "100")
    try:
        reports = run(fixture_tables(spark, SF), out, report_format="csv")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    folder = f"{out}/repaid_clients".removeprefix("file:")
    lines = []
    for name in sorted(f for f in os.listdir(folder) if f.endswith(".csv")):
        with open(f"{folder}/{name}", encoding="utf-8") as f:
            lines += f.read().splitlines()[1:]
    assert len(lines) == 980 and len([f for f in os.listdir(folder) if f.endswith(".csv")]) > 1

    def key(row):
        return tuple((x == "\\N", int(x) if i == 7 and x != "\\N" else x) for i, x in enumerate(row.split(",")[:8]))
    assert [key(x) for x in lines] == sorted(map(key, lines))
    assert reports["repaid_clients"].count() == 980


def test_report_1_takes_its_clients_from_the_stored_client_table(spark):
    cases = [(10, 1, "Cham1"), (10, 2, "Cham1"), (11, 3, "Cham1"), (None, 4, "Cham1"), (None, 5, "Cham1"), (12, 6, None), (12, 6, None), (12, None, "Hold")]
    base = spark.createDataFrame(
        [("p", pilot, D(2019, 12, 1), client, case, f"{case or 7}.25", "r", "m", None, "a") for client, case, pilot in cases],
        "property string, pilot string, extraction_date date, skp_client long, skp_credit_case long, due string, "
        "text_delivery_result string, text_delivery_result_more string, cpd_ranges string, days_exa_assignment_group string")
    base = base.select("*", F.col("due").cast("decimal(18,2)").alias("due_amount")).drop("due")
    stored = M.monitor_base_client(base)
    whole, short = R.segment_base(base), R.segment_base(base, stored)
    assert whole.schema == short.schema and same(whole, short)
    # the clients are read where they are stored
    assert R.segment_base(base, stored.limit(0)).count() == 0
