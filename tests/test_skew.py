"""A product on a third of the contracts is spread over many tasks; results stay the same."""

import datetime as dt
import re
from dataclasses import replace

import pytest
from helpers import D, DIMENSIONS, M, tables
from pyspark.sql import functions as F

from lettermon.config import DEFAULT
from lettermon.operators.skew import SHARE, heavy_keys, spread_join
from lettermon.plans import provision as P
from lettermon.plans.pipeline import Monitor

N = 6000


@pytest.fixture()
def shuffled(spark):
    """Joins by shuffle, in as many partitions as asked for."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "24"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def big(spark):
    return spark.range(N).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500 + 10).alias("k"), F.col("id").alias("row"))


def most_rows(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_heavy_keys_are_exact_and_few(spark):
    got = {r.k: r["__salts"] for r in heavy_keys(big(spark), ["k"]).collect()}
    assert got == {7: 34}  # 2,000 of 6,000 rows; a part has at most 1 percent
    assert heavy_keys(big(spark), ["k"], 0.5).collect() == []
    assert heavy_keys(big(spark).limit(0), ["k"]).collect() == []
    every = spark.range(1000).select((F.col("id") % 5).alias("k"))
    assert len(heavy_keys(every, ["k"], 0.1).collect()) <= 1 / 0.1
    assert heavy_keys(spark.createDataFrame([(None,)] * 9 + [(1,)], "k int"), ["k"]).collect()[0].k == 1


def test_no_task_gets_a_heavy_key_alone(spark, shuffled):
    small = spark.range(600).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = big(spark).join(small, "k")
    spread = spread_join(big(spark), small, ["k"], heavy_keys(big(spark), ["k"]), ["row"])
    assert spread.columns == plain.columns
    assert most_rows(plain) >= N / 3
    assert most_rows(spread) <= N / 6
    assert spread.exceptAll(plain).count() == 0 and plain.exceptAll(spread).count() == 0


def test_many_to_many_rows_of_a_heavy_key(spark):
    small = spark.createDataFrame([(7, "x"), (7, "y"), (7, "y"), (11, "z"), (None, "n")], "k long, v string")
    rows = big(spark)
    spread = spread_join(rows, small, ["k"], heavy_keys(rows, ["k"]), ["row"])
    assert spread.where("k = 7").count() == 3 * N / 3
    assert spread.exceptAll(rows.join(small, "k")).count() == 0


def _hot_tables(spark):
    """1,500 contracts, a third of them of product 5."""
    n, day, decision = 1500, D(2019, 11, 5), D(2018, 1, 1)
    product = lambda i: 5 if i % 3 == 0 else 100 + i % 400
    return tables(
        spark,
        prel_letter_infor_4=[(i % 700, "Chal1", decision + dt.timedelta(days=i % 4), day, i, day, M("10.00")) for i in range(n)],
        dc_credit_case=[(i, decision + dt.timedelta(days=i % 4), product(i), 1 + i % 3, 2, i % 2) for i in range(n)],
        dc_contract=[(i % 700, i, decision + dt.timedelta(days=i % 4), product(i)) for i in range(n)],
        dc_product=[(5, 1, "X")] + [(100 + k, 2, "Y") for k in range(400)],
        dpd_snapshot=[(i, day, 1) for i in range(n)],
        ft_coll_provision_rate=[(g, "B1", M("0.5")) for g in ("XCL_STD_NEW", "WCL")], **DIMENSIONS)


def test_a_hot_product_in_q03(spark, shuffled):
    t = _hot_tables(spark)
    cl = P.clients(t)
    rows = P.client_products(cl, t)
    plain = (P._contracts(cl, t).join(P.product_groups(cl, t).select("skp_product", F.col("goods_type").alias("product_group")), "skp_product")
             .select(*P.RESULT_COLUMNS))
    assert most_rows(plain) >= plain.count() / 3
    assert most_rows(rows) <= rows.count() / 8
    assert rows.exceptAll(plain).count() == 0 and plain.exceptAll(rows).count() == 0


def test_a_hot_product_in_a_session_with_tables_in_buckets(spark, shuffled):
    """A store in buckets lets a join be dealt by some of its keys; the parts of a heavy product stay apart."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        t = _hot_tables(spark)
        rows = P.client_products(P.clients(t), t)
        assert most_rows(rows) <= rows.count() / 8
    finally:
        spark.conf.set(key, old)


def test_a_hot_product_in_q04(spark):
    got = Monitor(_hot_tables(spark)).provision().collect()
    assert {(r.product_group, r.cnt_case, r.cnt_client) for r in got} == {("XCL_STD_NEW", 500, 500), ("WCL", 1000, 700)}


@pytest.mark.parametrize("product_join", ["product", "case"])
def test_no_case_is_dealt_out_by_the_codes_of_a_short_list(spark, shuffled, product_join):
    """A shuffle by a code would put all cases into as many tasks as there are codes."""
    cfg = replace(DEFAULT, product_join=product_join)
    t = tables(spark)
    cl = P.clients(t, cfg)
    for df in (P.product_groups(cl, t, cfg, keep_case=product_join == "case"), P.provision_totals(cl, t, cfg), P.provision(cl, t, cfg)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        by = re.findall(r"hashpartitioning\((\w+)#", plan)
        assert by and not {"skp_credit_type", "skp_credit_acquisition_chnl", "skp_goods_type_exp", "skp_dpd_tol_bucket",
                           "product_group", "code_dpd_tol_subbucket"} & set(by)


def test_totals_make_no_row_per_case_and_bucket(spark, shuffled):
    cfg = replace(DEFAULT, product_join="case")
    t = tables(spark)
    plan = P.provision_totals(P.clients(t, cfg), t, cfg)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(skp_credit_case#" in plan
    assert not re.search(r"hashpartitioning\(skp_credit_case#[^)]*code_dpd_tol_subbucket", plan)
