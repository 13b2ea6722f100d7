import datetime as dt

from pyspark.sql import functions as F

from lettermon.functions import exprs as X

D = dt.date


def test_age_buckets(spark):
    base = D(2019, 12, 1)
    ages = [-1, 0, 6, 7, 62, 63, 500, None]
    rows = [(base, None if a is None else base - dt.timedelta(days=a)) for a in ages]
    df = spark.createDataFrame(rows, "e date, a date")
    got = [r[0] for r in df.select(X.age_bucket("e", "a")).collect()]
    assert got == [None, "0-6", "0-6", "7-13", "56-62", "63-70", "63-70", None]


def test_iso_week_start(spark):
    df = spark.createDataFrame([(D(2019, 11, 17),), (D(2019, 11, 18),), (D(2019, 11, 20),)], "d date")
    got = [r[0] for r in df.select(X.week_start("d")).collect()]
    assert got == [D(2019, 11, 11), D(2019, 11, 18), D(2019, 11, 18)]


def test_delivery_detail_and_class(spark):
    rows = [
        ("Cham1", "Delivered"), ("Cham2", None), ("Chal1", "Delivered to client"),
        ("Chal2", "退件"), ("Chal1", "Return to Post office"), ("Chal1", "Return to Post Office"),
        ("Hold", "Delivered to client"), ("Chal1", None), (None, "Delivered"),
    ]
    df = spark.createDataFrame(rows, "p string, t string")
    got = [(r[0], r[1]) for r in df.select(X.delivery_detail("p", "t"), X.delivery_class("p", "t")).collect()]
    assert got == [
        ("Not sending", "Not sending"), ("Not sending", "Not sending"),
        ("Delivered to client", "Delivered"), ("退件", "Un-deliverd"),
        ("Return to Post office", "Un-deliverd"), ("Return to Post Office", "Return to Post Office"),
        (None, "Delivered to client"), (None, None), (None, "Delivered"),
    ]


def test_product_group_first_match(spark):
    rows = [
        # acq, credit type, channel, decision, code, goods
        ("EXTREME", "SS", 1, D(2019, 1, 1), "STD1", "Motorbike"),     # ESHOP beats channel 1
        ("EXTREME", "SC", 2, D(2019, 1, 1), "STD1", "Mobile"),        # MCL
        ("NORMAL", "CL", 1, D(2017, 12, 31), "STD1", "Mobile"),       # old: on the cut date
        ("NORMAL", "CL", 1, D(2018, 1, 1), "STD1", "Mobile"),         # new: after it
        ("NORMAL", "CL", 201, D(2018, 1, 1), "FCACL9", "Mobile"),     # XCL_STUP before ACL
        ("NORMAL", "CL", 2, D(2018, 1, 1), "FCACL9", "Mobile"),       # ACL before WCL
        ("NORMAL", "CL", 2, D(2018, 1, 1), "STD9", "Motorbike"),      # WCL before TW
        ("NORMAL", "CL", 9, D(2018, 1, 1), "STD9", "Motorbike"),      # TW
        ("NORMAL", "CL", 9, D(2018, 1, 1), "STD9", "Mobile"),         # CD
    ]
    df = spark.createDataFrame(rows, "a string, c string, ch int, d date, code string, g string")
    got = [r[0] for r in df.select(X.product_group("a", "c", "ch", "d", "code", "g")).collect()]
    assert got == ["ESHOP", "MCL", "XCL_STD_OLD", "XCL_STD_NEW", "XCL_STUP", "ACL", "WCL", "TW", "CD"]


def test_half_is_exact(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(Decimal("100.01"),)], "d decimal(18,2)")
    assert df.select(X.half("d")).first()[0] == Decimal("50.005")


def test_ratio_casts_before_dividing(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(Decimal("1.00000000"), Decimal("3.00000000"))],
                               "a decimal(38,8), b decimal(38,8)")
    assert df.select(X.ratio("a", "b")).first()[0] == 1.0 / 3.0
    assert df.select((F.col("a") / F.col("b"))).first()[0] != 1.0 / 3.0  # why the cast matters
