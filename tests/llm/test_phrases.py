import os
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from lettermon.llm import phrases as P


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute_counts(rows, least, longest=4):
    f, n = Counter(), Counter()
    for text, lang in rows:
        for ws in pieces(text):
            name = "und" if lang is None else lang
            n[name] += len(ws)
            for k in range(1, longest + 1):
                f.update((name, tuple(ws[i:i + k])) for i in range(len(ws) - k + 1))
    return {g: a for g, a in f.items() if a >= least}, n


def brute(rows, least=30, top=2000, cover=80):
    f, n = brute_counts(rows, least)
    best = {}
    for (lang, ws), a in f.items():
        if len(ws) < 2:
            continue
        cuts = []
        for k in range(1, len(ws)):
            left, right = f[lang, ws[:k]], f[lang, ws[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        best[lang, ws] = (a, min(cuts))
    gone = {(lang, ws[i:i + k]) for (lang, ws), a in f.items() for k in range(2, len(ws)) for i in range(len(ws) - k + 1)
            if 100 * a >= cover * f[lang, ws[i:i + k]]}
    out = []
    for lang in {x for x, _ in best}:
        rows_ = [(-c[0], -a, " ".join(ws).encode(), a, c[2], c[3]) for (x, ws), (a, c) in best.items() if x == lang and (x, ws) not in gone]
        out += [(lang, r, w.decode(), a, left, right, n[lang], -s) for r, (s, _, w, a, left, right) in enumerate(sorted(rows_)[:top], 1)]
    return sorted(out)


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocab = ["a", "bé", "c'", "DD", "e-e", "f", "ß", "日本", "x\x00y", "(q)"]
    stock = ["a bé c'", "DD e-e f ß", "日本 日本 日本", "(q) a\tbé  c' DD"]
    rows = []
    for i in range(n):
        words = [rng.choice(stock) if rng.random() < 0.3 else rng.choice(vocab[:rng.randint(2, 10)]) for _ in range(rng.randint(0, 30))]
        rows.append(("".join(w + rng.choice([" ", " ", " ", "\t ", ". ", "\n", "!"]) for w in words), rng.choice(["en", "de", None, "und", ""])))
    return rows + [(None, "en"), ("", None), (" \t", "de"), (".,;", "en"), ("a bé c' " * 400, "fr")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string").repartition(4)


@pytest.mark.parametrize("seed, least", [(1, 10), (2, 30), (3, 3)])
def test_collocations_against_brute_force(spark, seed, least):
    rows = corpus(seed)
    got = sorted(map(tuple, P.collocations(frame(spark, rows), least=least, top=15).collect()))
    assert got == brute(rows, least, 15) and got


@pytest.mark.parametrize("kept", ["none", "half", "some", "all"])
@pytest.mark.parametrize("seed", [4])
def test_any_proposal_gives_the_same_counts(spark, kept, seed, monkeypatch):
    """Whatever the sample misses, one expansion pass brings it back."""
    rows = corpus(seed)
    df = frame(spark, rows)
    keys = P.materialise(P.sampled(df, 10, 4, 1.0), "keys")
    proposals = {"none": keys.limit(0), "half": keys.where("shiftright(key, 20) % 2 = 0"),
                 "some": keys.where("shiftright(key, 20) % 5 = 0"), "all": keys}[kept]
    passes = []

    def counted(*args, **options):
        passes.append(1)
        return original(*args, **options)
    original = P.counted
    monkeypatch.setattr(P, "counted", counted)
    found = [(r["lang"], tuple(r["phrase"].split(" ")) if r["words"] else (), r["n"])
             for r in P.frequent(df, least=10, proposals=proposals).collect()]
    assert len(passes) == (1 if kept == "all" else 2) and len(set(found)) == len(found)
    f, n = brute_counts(rows, 10)
    assert set(found) == {(lang, ws, a) for (lang, ws), a in f.items()} | {(lang, (), a) for lang, a in n.items()}


def test_a_full_bitmap_counts_more_but_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(P, "LEAST_BITS", 16)
    monkeypatch.setattr(P, "MOST_BITS", 16)
    rows = corpus(5)
    full = P.Bitmap(16)
    full.packed[:] = 255
    monkeypatch.setattr(P, "bitmap_of", lambda phrases: full)
    got = {(r["lang"], r["phrase"], r["n"]) for r in P.frequent(frame(spark, rows), least=10).where("words > 0").collect()}
    assert got == {(lang, " ".join(ws), a) for (lang, ws), a in brute_counts(rows, 10)[0].items()}


def test_bitmap_has_what_was_put_in(spark):
    keys = [0, 1, -1, 1 << 62, -(1 << 63), (1 << 63) - 1, *(random.Random(1).getrandbits(63) for _ in range(5000))]
    bitmap = P.bitmap_of(spark.createDataFrame([(k,) for k in keys], "key long"))
    import numpy as np
    assert bitmap.has(np.array(keys, np.int64).view(np.uint64)).all()
    others = np.array([random.Random(2).getrandbits(64) for _ in range(20_000)], np.uint64)
    assert bitmap.has(others).mean() < 0.02
    assert not P.bitmap_of(spark.createDataFrame([], "key long")).has(others).any()


@pytest.mark.parametrize("parts", [2, 3])
def test_parts_split_what_a_task_adds_up(spark, parts):
    """Each part is a share of the hashes, and together they are all."""
    import pyarrow as pa
    rows = corpus(6)
    words = P.words_of(pa.array([t for t, _ in rows], pa.string()).cast(pa.large_binary()), P.KINDS)
    every = P.Bitmap(16)
    every.packed[:] = 255

    def met(part):
        batches = P.PhraseCounter(every, part=part).count(pa.array([x for _, x in rows], pa.string()), words)
        return Counter(x for b in batches for x in zip(*(c.to_pylist() for c in b.columns)))
    whole, split = met((0, 1)), [met((k, parts)) for k in range(parts)]
    assert sum(split, Counter()) == whole and len(whole) > 200
    assert max(len({key for key, _ in x}) for x in split) < 1.5 * len({key for key, _ in whole}) / parts
    df = frame(spark, rows)
    whole, split = (sorted(r["key"] for r in P.often(df, every, 5, parts=k).collect()) for k in (1, parts))
    assert split == whole and len(set(whole)) == len(whole) > 0


def test_long_texts_in_parts_lose_nothing(spark, monkeypatch):
    rows = [("one two three four. " * 500 + "five six", "en"), ("no break at all " * 300, "en")]
    want = P.frequent(frame(spark, rows), least=2).collect()
    monkeypatch.setattr(P, "BLOCK", 100)
    parts = list(P._long_texts_cut([rows[0][0].encode(), rows[1][0].encode()], 100))
    assert b"".join(parts).decode() == rows[0][0] + rows[1][0] and len(parts) > 50
    assert {tuple(r) for r in want} == {tuple(r) for r in P.frequent(frame(spark, rows), least=2).collect()}


def test_products_beyond_64_bits(spark):
    big = 1 << 60
    found = spark.createDataFrame([("x", "a", 1, 4 * big), ("x", "b", 1, big + 7), ("x", "a b", 2, big + 3)],
                                  "lang string, phrase string, words int, n long")
    row = P.scored(found).first()
    assert row["score"] == 2_000_000 * (big + 3) // (4 * big + big + 7)


def test_odd_documents(spark, docs, no_docs):
    rows = [(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()]
    named = docs.withColumn("phrase", F.lit(1)).withColumn("words", F.lit("x")).withColumn("key", F.lit("y"))
    assert sorted(map(tuple, P.collocations(named).collect())) == brute(rows)
    assert P.collocations(no_docs).collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver data not present")
def test_query_equals_its_sql(spark):
    from lettermon.llm.oracles import ORACLE_SQL
    from lettermon.llm.queries import op13_phrases
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    got = op13_phrases(spark, "/root/testdata/sf0.001")
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL['op13_phrases']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and want
