import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from lettermon.llm.hilbert import curve_index, hilbert_shards, shard_documents, text_ranks, write_shards
from lettermon.llm.scratch import numbered


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(spark, dims, bits):
    cells = spark.createDataFrame(list(product(range(1 << bits), repeat=dims)), ", ".join(f"c{d} int" for d in range(dims)))
    rows = sorted((r[-1], r[:-1]) for r in cells.select("*", curve_index([F.col(f"c{d}") for d in range(dims)], bits)).collect())
    assert [r[0] for r in rows] == list(range(1 << bits * dims))
    assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for (_, x), (_, y) in zip(rows, rows[1:]))


def test_numbers_are_gapless_under_a_hot_key(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id").repartition(7)
    got = [(r["k"], r["id"], r["place"]) for r in numbered(df, ["k", "id"], "place").collect()]
    assert [p for _, _, p in sorted(got)] == list(range(5000))


def test_odd_documents(docs, no_docs):
    got = shard_documents(docs, shards=5).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    counts = [sum(r["shard"] == s for r in got) for s in range(5)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    for s in range(5):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    placed = sorted((r["shard"], r["slot"], r["curve"]) for r in got)
    assert [c for *_, c in placed] == sorted(c for *_, c in placed)  # runs along the curve
    assert shard_documents(no_docs).collect() == []
    few = shard_documents(docs.limit(3), shards=8).collect()
    assert len(few) == 3 and all(r["slot"] == 0 for r in few)


def test_shards_are_compact_and_written_as_files(spark, tmp_path):
    df = spark.range(4096).select("id", (F.col("id") % 64).alias("x"), F.floor(F.col("id") / 64).alias("y"))
    shards = hilbert_shards(df, {"x": F.col("x"), "y": F.col("y")}, [F.col("id")], shards=16)
    assert shards.columns == ["id", "x", "y", "curve", "shard", "slot"]
    area = [(r["a"] * r["b"]) for r in shards.groupBy("shard").agg(
        (F.max("x") - F.min("x") + 1).alias("a"), (F.max("y") - F.min("y") + 1).alias("b")).collect()]
    assert max(area) <= 2 * 4096 / 16  # a sort by one dimension alone gives the same, but 64 long
    write_shards(df, shards, str(tmp_path / "out"), "id")
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 4096 and back.select("shard").distinct().count() == 16


def test_whole_names_decide(spark):
    """Sources and languages that share their first bytes still get cells of their own."""
    def shards(source, lang="{:02}"):
        rows = [(i, "t" * 5, lang.format(i % 3), source.format(i * 7 % 16)) for i in range(320)]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        return {r["doc_id"]: (r["curve"], r["shard"], r["slot"]) for r in shard_documents(df, shards=16).collect()}
    short = shards("{:02}")
    assert len({c for c, *_ in short.values()}) == 48
    assert shards("https://www.example.org/{:02}", "language-{:02}") == short


def test_ranks_are_in_the_order_of_bytes(spark):
    names = [None, "", "source_01", "source_02", "source_0", "é", "中", "A", "source_02"]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    got = text_ranks(df.withColumn("r", F.col("s")), "r").collect()
    order = sorted({n for n in names if n is not None}, key=str.encode)
    assert sorted((str(s), r) for s, r in got) == sorted((str(n), None if n is None else order.index(n)) for n in names)


def test_clashing_names_make_way(spark):
    df = spark.range(20).select(F.col("id"), F.lit("u").alias("curve"), F.lit("v").alias("Shard"), F.lit("w").alias("slot"))
    got = hilbert_shards(df, {"id": F.col("id")}, [F.col("id")], shards=3)
    assert got.columns == ["id", "curve", "shard", "slot"]
    assert sorted(r["shard"] for r in got.collect()) == [0] * 7 + [1] * 7 + [2] * 6
