import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from lettermon.llm.exact import exact_groups, exact_survivors

BLANK = re.compile("[\x20\x09-\x0d]")


def brute(rows):
    """Per text: the ids in the order in which they would stay."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[BLANK.sub("", text or "")].append((-len(text or ""), doc_id is None, doc_id if doc_id is not None else 0))
    return {p: sorted(g) for p, g in groups.items()}


def check(docs, got):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    got = got.collect()
    assert len(got) == len(rows)
    assert sum(r["kept"] for r in got) == len(want)
    keep = {p: None if g[0][1] else g[0][2] for p, g in want.items()}
    expected = sorted((str(i), str(keep[BLANK.sub("", t or "")]), len(want[BLANK.sub("", t or "")])) for i, t in rows)
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"]) for r in got) == expected
    return got, want


def test_groups_of_odd_documents(docs):
    got, want = check(docs, exact_groups(docs))
    assert {r["digest"] for r in got} == {hashlib.sha256(p.encode()).hexdigest() for p in want}


def test_digests_that_stand_for_several_texts(docs):
    """The full-byte check splits groups that a weak digest puts together."""
    got, _ = check(docs, exact_groups(docs, digest=lambda c: F.pmod(F.crc32(c.cast("binary")), F.lit(3)).cast("string")))
    assert len({r["digest"] for r in got}) <= 3


def test_survivors_keep_columns_and_order_of_preference(docs):
    out = exact_survivors(docs)
    assert out.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert out.count() == len(brute(rows))
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert 104 in ids and 3 not in ids and 103 not in ids  # most code points
    assert ids.count(1) == 1 and ids.count(None) == 1      # repeated rows
    assert 102 in ids and 100 not in ids and 101 not in ids  # blank texts are one group, the longest stays


def test_frame_without_files_and_empty_table(spark, docs, no_docs):
    mem = spark.createDataFrame([(2, "a b"), (1, "ab"), (3, None)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_groups(mem).collect())
    assert got == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True)]
    assert exact_groups(no_docs).collect() == []
    assert exact_survivors(no_docs).collect() == []


def test_member_filter_has_every_value_and_few_others(spark):
    from lettermon.llm.exact import member_filter
    values = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"))
    others = spark.range(100_000, 120_000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"))
    has = member_filter(values, "v")
    assert values.where(has(F.col("v"))).count() == 1000
    assert others.where(has(F.col("v"))).count() < 20_000 * 0.12
    assert others.where(member_filter(values.limit(0), "v")(F.col("v"))).count() == 0


def test_a_full_filter_changes_nothing(spark, docs, monkeypatch):
    from lettermon.llm import exact as module
    want = sorted(map(str, exact_groups(docs).drop("__file", "__row").collect()))
    monkeypatch.setattr(module, "LEAST_BITS", 6)
    monkeypatch.setattr(module, "MOST_BITS", 6)
    assert sorted(map(str, exact_groups(docs).drop("__file", "__row").collect())) == want
