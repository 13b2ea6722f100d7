"""Distinct counts as bitmaps: exact over any keys, mergeable, without expanding rows."""

import random

from pyspark.sql import functions as F

from lettermon.operators.distinct import BITS, bitmap_counts, bitmap_pieces, dense_numbers, rolled_up
from lettermon.operators.materialize import Store
from lettermon.operators.ordering import numbered
from lettermon.plans.pipeline import Monitor
from lettermon.sources.fixtures import fixture_tables

SF = "/root/testdata/sf0.001"


def frame(spark, seed=5, n=3000):
    rng = random.Random(seed)
    keys = [None, 0, 1, -1, 32767, 32768, 32769, -32768, -32769, 1 << 40, -(1 << 40), *range(50, 400)]
    rows = [(rng.choice("abc"), rng.choice([1, 2, None]), rng.choice(keys), rng.choice(keys), rng.randint(0, 9)) for _ in range(n)]
    return spark.createDataFrame(rows, "g string, d int, case long, client long, amt int"), rows


def test_counts_of_any_long_keys(spark):
    df, rows = frame(spark)
    pieces = bitmap_pieces(df, ["g", "d"], {"cases": "case", "clients": "client"}, {"amt": F.col("amt")})
    got = {(r.g, r.d): (r.cases, r.clients, r.amt) for r in bitmap_counts(pieces, ["g", "d"], ["cases", "clients"], ["amt"]).collect()}
    want = {}
    for g in {(r[0], r[1]) for r in rows}:
        own = [r for r in rows if (r[0], r[1]) == g]
        want[g] = (len({r[2] for r in own if r[2] is not None}), len({r[3] for r in own if r[3] is not None}), sum(r[4] for r in own))
    assert got == want


def test_roll_up_needs_no_second_scan(spark):
    df, rows = frame(spark)
    pieces = bitmap_pieces(df, ["g", "d"], {"cases": "case"}, {"amt": F.col("amt")})
    got = {r.g: (r.cases, r.amt) for r in bitmap_counts(rolled_up(pieces, ["g"], ["amt"]), ["g"], ["cases"], ["amt"]).collect()}
    assert got == {g: (len({r[2] for r in rows if r[0] == g and r[2] is not None}), sum(r[4] for r in rows if r[0] == g)) for g in "abc"}


def test_keys_spread_over_many_bitmaps_take_no_room_and_no_sort(spark):
    """A piece per row, as of clients that recur on many dates: it is a long, not a page of bits to sort (F6)."""
    rows = [(g, k) for g in range(6) for k in range(g, 3_000_000, 30_011)] + [(g, k) for g in range(6) for k in (63, 64, 65, -1, -64, -65)]
    df = spark.createDataFrame([(f"p{g % 2}", g, k) for g, k in rows], "p string, g long, k long")
    pieces = bitmap_pieces(df, ["p", "g"], {"n": "k"}, {"amt": F.lit(1).cast("decimal(18,2)")})
    assert pieces.schema[BITS].dataType.simpleString() == "bigint"
    fine, coarse = bitmap_counts(pieces, ["p", "g"], ["n"], ["amt"]), bitmap_counts(rolled_up(pieces, ["p"], ["amt"]), ["p"], ["n"], ["amt"])
    assert {r.g: r.n for r in fine.collect()} == {g: len({k for h, k in rows if h == g}) for g in range(6)}
    assert {r.p: (r.n, r.amt) for r in coarse.collect()} == {
        f"p{p}": (len({k for g, k in rows if g % 2 == p}), len([g for g, _ in rows if g % 2 == p])) for p in (0, 1)}
    assert not any("SortAggregate" in _plan(x) for x in (fine, coarse))


def test_group_without_any_key_counts_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 7)], "g string, k long")
    got = {r.g: r.n for r in bitmap_counts(bitmap_pieces(df, ["g"], {"n": "k"}), ["g"], ["n"]).collect()}
    assert got == {"a": 0, "b": 1}
    assert bitmap_counts(bitmap_pieces(df.limit(0), ["g"], {"n": "k"}), ["g"], ["n"]).collect() == []


def test_numbers_are_dense_and_follow_the_order(spark):
    df = spark.createDataFrame([(k, d) for k in range(500) for d in (k * 7 % 40, k * 11 % 40)] + [(None, 0)], "k long, d int")
    got = {r.k: r.no for r in dense_numbers(df, "k", ["d"], Store(spark), "numbers", "no").collect()}
    order = sorted(range(500), key=lambda k: (min(k * 7 % 40, k * 11 % 40), k))
    assert got == {k: i for i, k in enumerate(order, 1)}


def test_numbered_ties_and_empty(spark):
    df = spark.createDataFrame([(i % 3,) for i in range(100)], "v int").repartition(5)
    ranks = numbered(df, [F.col("v")], Store(spark), "ranks").orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == list(range(1, 101))
    assert [r["v"] for r in ranks] == sorted(r["v"] for r in ranks)
    assert numbered(df.limit(0), [F.col("v")], Store(spark), "none").collect() == []


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_plan_expands_rows(spark):
    m = Monitor(fixture_tables(spark, SF), store=Store(spark))
    for df in (m.provision(), m.base_client(), m.daily_recovery(), m.distinct_rollup()):
        df.collect()
        assert "Expand" not in _plan(df)


def test_numbers_and_keys_give_the_same_counts(spark):
    t = fixture_tables(spark, SF)
    by_number, by_key = Monitor(t, store=Store(spark)).provision(), Monitor(t).provision()
    assert by_number.exceptAll(by_key).count() == 0 and by_key.exceptAll(by_number).count() == 0
