import datetime as dt
from decimal import Decimal as M

import pytest
from pyspark.errors import ArithmeticException


from lettermon.operators.aggregates import ratio_to_base, threshold_agg
from lettermon.operators.intervals import within_horizon
from lettermon.operators.joins import key_match
from lettermon.operators.windows import mask_repeats, running_total

D = dt.date


def test_within_horizon_bounds(spark):
    anchors = spark.createDataFrame([(1, D(2019, 11, 10))], "k long, d date")
    events = spark.createDataFrame(
        [(1, D(2019, 11, 9)), (1, D(2019, 11, 10)), (1, D(2019, 12, 10)), (1, D(2019, 12, 11)),
         (2, D(2019, 11, 10))], "k long, e date")
    got = sorted(r.e for r in within_horizon(anchors, events, ["k"], "d", "e", 30).collect())
    assert got == [D(2019, 11, 10), D(2019, 12, 10)]  # day 0 and day 30 in, -1 and 31 out


def test_running_total_counts_peers(spark):
    # one client, two segments, both pay 10 on day 3 -> both rows 20
    df = spark.createDataFrame(
        [("c", "s1", 3, M("10.00")), ("c", "s2", 3, M("10.00")), ("c", "s1", 5, M("1.00"))],
        "client string, seg string, day int, amt decimal(18,2)")
    got = {(r.seg, r.day): r.amt for r in running_total(df, ["client"], "day", "amt").collect()}
    assert got == {("s1", 3): M("20.00"), ("s2", 3): M("20.00"), ("s1", 5): M("21.00")}


def test_mask_repeats_null_order_last(spark):
    df = spark.createDataFrame(
        [("a", None, 7), ("a", 5, 7), ("a", 9, 7), ("b", None, 3)], "seg string, day int, v int")
    got = {(r.seg, r.day): r.v for r in mask_repeats(df, ["seg"], "day", ["v"]).collect()}
    assert got == {("a", 5): 7, ("a", 9): 0, ("a", None): 0, ("b", None): 3}


def test_threshold_agg_levels_and_empty_groups(spark):
    df = spark.createDataFrame(
        [("g", 1, M("49.99"), M("100.00")), ("g", 2, M("50.00"), M("100.00")),
         ("g", 3, M("100.00"), M("100.00")), ("h", 4, None, M("100.00"))],
        "g string, client long, paid decimal(18,2), due decimal(18,2)")
    got = {r.g: r for r in threshold_agg(df, ["g"], "paid", "due", "client").collect()}
    g = got["g"]
    assert (g.cnt_client_repaid, g.cnt_client_half, g.cnt_client_full) == (3, 2, 1)
    assert (g.amt_repaid, g.amt_half, g.amt_full) == (M("199.99"), M("150.00"), M("100.00"))
    h = got["h"]  # non-payer group: counts 0, amounts NULL
    assert (h.cnt_client_repaid, h.cnt_client_half, h.cnt_client_full) == (0, 0, 0)
    assert (h.amt_repaid, h.amt_half, h.amt_full) == (None, None, None)


def test_ratio_to_base(spark):
    df = spark.createDataFrame(
        [("p", 1, "Chal1", M("2.0")), ("p", 1, "Cham1", M("4.0")), ("p", 2, "Cham1", M("1.0")),
         (None, 1, "Chal1", M("1.0"))],
        "prop string, d int, pilot string, v decimal(10,2)")
    got = {(r.prop, r.d, r.pilot): r.rate
           for r in ratio_to_base(df, ["prop", "d"], "pilot", "Chal1", "v", "rate").collect()}
    assert got == {("p", 1, "Chal1"): 1.0, ("p", 1, "Cham1"): 0.5}  # no base on day 2; NULL key out


def test_threshold_agg_of_repeated_rows(spark):
    """A row that stands for three counts and sums like three rows."""
    once = [("g", 1, M("50.00"), M("100.00"), 3), ("g", None, M("100.00"), M("100.00"), 2), ("h", 4, None, M("1.00"), None)]
    cols = "g string, client long, paid decimal(18,2), due decimal(18,2)"
    packed = spark.createDataFrame(once, cols + ", times long")
    spread = spark.createDataFrame([r[:4] for r in once for _ in range(r[4] or 1)], cols)
    a = threshold_agg(packed, ["g"], "paid", "due", "client", "times").collect()
    b = threshold_agg(spread, ["g"], "paid", "due", "client").collect()
    assert sorted(a) == sorted(b)


def test_zero_denominator_fails_or_gives_null(spark):
    df = spark.createDataFrame([("p", "Chal1", M("2.0")), ("p", "Cham1", M("0.0"))], "prop string, pilot string, v decimal(10,2)")
    rate = {r.pilot: r.rate for r in ratio_to_base(df, ["prop"], "pilot", "Chal1", "v", "rate", "null").collect()}
    assert rate == {"Chal1": 1.0, "Cham1": None}
    with pytest.raises(ArithmeticException):
        ratio_to_base(df, ["prop"], "pilot", "Chal1", "v", "rate").collect()


def test_plain_and_null_safe_keys(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([("x", 10), (None, 20)], "k string, b int")
    plain = {(r.a, r.b) for r in a.join(b, key_match(a, b, ["k"]), "left").collect()}
    safe = {(r.a, r.b) for r in a.join(b, key_match(a, b, ["k"], null_safe=True), "left").collect()}
    assert plain == {(1, 10), (2, None)}
    assert safe == {(1, 10), (2, 20)}
