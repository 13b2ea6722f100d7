"""Joins on the case over tables in buckets of it: no exchange, same rows."""

import os

import pytest

from lettermon.operators.materialize import Store
from lettermon.plans.pipeline import Monitor
from lettermon.sources.bucketed import BUCKETED, BucketedStore, with_buckets
from lettermon.sources.fixtures import fixture_tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")


@pytest.fixture()
def joins_by_shuffle(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.requireAllClusterKeysForCoPartition": "true"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def below_joins(df, scanned):
    """For each join over a scan of ``scanned``: the exchanges between the two."""
    found = []

    def walk(node, above):
        name = node.nodeName()
        if "Scan" in name and scanned in node.toString():
            found.append([x for x in above if "Exchange" in x])
        path = [] if "Join" in name else [*above, name]
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), path)
    walk(df._jdf.queryExecution().executedPlan(), [])
    return found


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_no_exchange_below_the_joins(spark, joins_by_shuffle):
    t = fixture_tables(spark, SF)
    plain = Monitor(t, store=Store(spark))
    want_base, want_payment = plain.base(), plain.payment()
    assert below_joins(want_payment, "monitor_base") != [[]]  # it takes an exchange without buckets
    store = BucketedStore(spark, 8)
    m = Monitor(with_buckets(t, store), store=store)
    base = m.base()
    assert below_joins(base, "f_letter_result_tt") == [[]]
    assert same(base, want_base)
    payment = m.payment()
    assert below_joins(payment, "f_incoming_payment_tt") == [[]] and below_joins(payment, "monitor_base") == [[]]
    assert same(payment, want_payment)


def test_tables_are_in_buckets_and_read_back(spark):
    t, store = fixture_tables(spark, SF), BucketedStore(spark, 4)
    for name in BUCKETED:
        df = t[name] if name in t.names() else Monitor(t).base()
        back = store.put(name, df)
        assert same(back, df)
        detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {store.table(name)}").collect()}
        assert detail["Num Buckets"] == "4" and "skp_credit_case" in detail["Bucket Columns"]
        assert store.root in detail["Location"]
    other = store.put("other", spark.range(3))
    assert other.count() == 3
    again = store.put("monitor_base", Monitor(t).base().limit(5))  # overwrites
    assert again.count() == 5
