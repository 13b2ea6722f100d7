import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lettermon.llm import toxicity as X

WORDS = "the house and of a river under some trees where people walk along every day with their dogs then rest".split()
INSULTS = ["idiot", "scumbag", "moronic", "worthless"]


def sentence(rng, n, share=0.0):
    return " ".join(rng.choice(INSULTS) if rng.random() < share else rng.choice(WORDS) + rng.choice(["", "", "ly", "er"]) for _ in range(n))


def rows(seed=1, n=400):
    rng = random.Random(seed)
    return [(i, sentence(rng, rng.randint(20, 120), 0.08 if i % 4 == 0 else 0), int(i % 4 == 0)) for i in range(n)]


def brute_ratio(toxic, ordinary, order, shared, d=X.DISCOUNT):
    """Log ratio of an n-gram's last character, by the recursion of interpolated Kneser-Ney."""
    def counts(texts):
        return Counter(t[i:i + order] for t in texts for i in range(len(t) - order + 1))
    level = {"toxic": counts(toxic), "ordinary": counts(ordinary)}
    level["both"] = level["toxic"] + level["ordinary"]
    levels = {order: level}
    for size in range(order - 1, 0, -1):
        levels[size] = {c: Counter(g[1:] for g in levels[size + 1][c]) for c in level}
    totals = {(s, c): defaultdict(lambda: [0, 0]) for s in levels for c in level}
    for s, by_class in levels.items():
        for c, grams in by_class.items():
            for g, n in grams.items():
                totals[s, c][g[:-1]][0] += n
                totals[s, c][g[:-1]][1] += 1

    def chance(c, g):
        kind = c if len(g) > shared else "both"
        n, (total, types) = levels[len(g)][kind][g], totals[len(g), kind].get(g[:-1], (0, 0))
        below = chance(c, g[1:]) if len(g) > 1 else 1 / totals[1, "both"][""][1]
        return (max(n - d, 0) + d * types * below) / total if total else below
    return lambda g: math.log(chance("toxic", g) / chance("ordinary", g))


@pytest.mark.parametrize("order, shared", [(3, 1), (4, 2), (5, 2)])
def test_ratios_against_the_recursion(spark, order, shared):
    rng = random.Random(order)
    data = [(sentence(rng, 30, 0.2 if i % 3 == 0 else 0), i % 3 == 0, False) for i in range(30)]
    grams = X.gram_counts(spark.createDataFrame(data, "text string, toxic boolean, fit boolean"), order)
    seen, unseen = X.log_ratios(grams.withColumn("model", F.lit(0)), order, shared)
    ratio = brute_ratio([X.plain(t) for t, x, _ in data if x], [X.plain(t) for t, x, _ in data if not x], order, shared)
    found = {r["gram"]: r["ratio"] for r in seen.collect()}
    assert {len(g) for g in found} == set(range(shared + 1, order + 1))
    assert all(abs(v - ratio(g)) < 1e-9 for g, v in found.items())
    model = X.ToxicityModel(X.ratio_tables(seen, 18)[0], X.ratio_tables(unseen, 16)[0], order, shared)
    # n-grams that no row has: the tables go back to shorter ones as the recursion does
    text = X.plain("the idler and scummy dogs whereupon thelyer")
    steps = model.ratios(np.array([[ord(c) for c in text[i:i + order]] for i in range(len(text) - order + 1)]))
    want = [ratio(text[i:i + order]) if all(c in set("".join(found)) for c in text[i:i + order]) else None for i in range(len(steps))]
    assert all(w is None or abs(s * X.STEP - w) < 0.01 for s, w in zip(steps.tolist(), want)) and any(w is not None for w in want)


def test_ngrams_that_share_a_bucket_all_stay(spark):
    ratios = [(0, a + b + c, 1 + k, k / 100 - 2) for k, (a, b, c) in enumerate((a, b, c) for a in "abcdefg" for b in "hij\u00e9" for c in "klmnopqr")]
    frame = spark.createDataFrame(ratios, "model int, gram string, n long, ratio double")
    for bits in (1, 4, 16):
        table = X.ratio_tables(frame, bits)[0]
        steps, known = table.get(X._hashed(np.array([[ord(c) for c in r[1]] for r in ratios])))
        assert known.all() and np.abs(steps * X.STEP - [r[3] for r in ratios]).max() <= X.STEP


def test_counts_of_both_sets(spark):
    data = [("aaab", True, True), ("aaab", True, False), ("aaa", False, False), (None, True, False), ("", False, True)]
    got = {r["gram"]: tuple(r)[1:] for r in X.gram_counts(spark.createDataFrame(data, "text string, toxic boolean, fit boolean"), 3).collect()}
    assert got == {" aa": (2, 1, 1, 1), "aaa": (2, 1, 1, 1), "aab": (2, 0, 1, 0), "ab ": (2, 0, 1, 0), "aa ": (0, 1, 0, 1)}


def test_long_texts_in_parts_have_the_same_features(spark, monkeypatch):
    rng = random.Random(5)
    tables = [X.RatioTable.empty(12), X.RatioTable.empty(10)]
    for t in tables:
        t.steps[:] = [rng.randint(-3000, 3000) for _ in t.steps]
        t.tags[:] = [rng.randint(1, 128) for _ in t.tags]
    model = X.ToxicityModel(*tables)
    texts = [sentence(rng, n) for n in (0, 1, 2, 5, 40, 200, 700, 3)] + [None, "", "!!", "é" * 500, "x" * 3]
    want = model.features(texts)
    for block in (1 << 20, 1000, 333, 64):
        monkeypatch.setattr(X, "BLOCK", block)
        assert (model.features(texts) == want).all()
        assert (np.concatenate([model.features([t]) for t in texts]) == want).all()
    assert (want[-5:-2] == 0).all()


@pytest.mark.parametrize("kind", ["long", "int", "string"])
def test_texts_without_a_label_are_not_moved(spark, kind):
    docs = spark.range(20_000).selectExpr(f"CAST(IF(id = 7, NULL, id) AS {kind}) AS id", "'x' AS text").unionAll(
        spark.range(3).selectExpr(f"CAST(id AS {kind})", "'again'"))
    marks = spark.range(0, 30_000, 10).selectExpr(f"CAST(id AS {kind}) AS id", "id % 3 = 0 AS toxic")
    left = X.maybe_marked(docs, marks)
    assert left.columns == docs.columns and left.where("id IS NULL").isEmpty()
    assert sorted(left.join(marks, "id").collect()) == sorted(docs.join(marks, "id").collect())
    assert 2001 <= left.count() < 2001 + 2000
    assert X.maybe_marked(docs, marks.limit(0)).isEmpty()
    assert X.maybe_marked(docs, marks.select(marks["id"].cast("double").alias("id"), "toxic")).count() == 20_003


def test_held_out_rows_are_told_apart(spark):
    data = rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, x) for i, _, x in data], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in X.toxicity(docs, labels).collect()}
    import zlib
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in data)
    tested = [(got[i], x) for i, _, x in data if got[i]["held_out"]]
    assert sum(r["predicted"] == x for r, x in tested) >= 0.97 * len(tested) and {x for _, x in tested} == {0, 1}
    # labels of held-out rows do not count
    turned = spark.createDataFrame([(i, 1, 1 - x if got[i]["held_out"] else x) for i, _, x in data], "doc_id long, quality int, toxic int")
    again = {r["doc_id"]: r["score"] for r in X.toxicity(docs, turned).collect()}
    assert again == {i: r["score"] for i, r in got.items()}


def test_one_insult_in_a_long_text_counts(spark):
    data = rows(2)
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    model = X.learn(docs, spark.createDataFrame([(i, x) for i, _, x in data], "doc_id long, toxic int"))
    rng = random.Random(9)
    clean = sentence(rng, 3000)
    scores = model.scores([clean, clean[:9000] + " you worthless idiot " + clean[9000:], "worthless idiot", ""])
    assert scores[0] < 0.5 < scores[1] and scores[2] > 0.5 and 0 <= scores[3] < 0.5


def test_odd_documents(spark, docs, no_docs):
    labels = spark.createDataFrame([(i, 1, i % 2, "x") for i in range(12)] + [(3, 1, 1, "x"), (4, 1, None, "x"), (None, 1, 1, "x"), (999, 1, 1, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    got = X.toxicity(docs, labels).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in docs.select("doc_id").collect())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    by_id = defaultdict(set)
    for r in got:
        by_id[r["doc_id"]].add(r["score"])
    assert len(by_id[103]) == 1 and by_id[100] == by_id[101] == by_id[102]
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    assert X.toxicity(no_docs, labels).collect() == []


@pytest.mark.parametrize("marks, score", [([], 0.0), ([0, 0, 0], 0.0), ([1, 1], 1.0)])
def test_without_both_classes_the_share_is_the_score(spark, docs, marks, score):
    labels = spark.createDataFrame([(i, x) for i, x in enumerate(marks, 1)], "doc_id long, toxic int")
    assert {round(r["score"], 6) for r in X.toxicity(docs, labels).collect()} == {score}


@pytest.mark.parametrize("block", [1 << 20, 300, 50, 7])
def test_parts_hold_every_ngram_once(monkeypatch, block):
    monkeypatch.setattr(X, "BLOCK", block)
    monkeypatch.setattr(X, "DENSE", 1 << 24 if block > 100 else 50)
    rng = random.Random(block)
    texts = ["".join(rng.choice("abcdé ÄZ12.-ß日_İ") for _ in range(n)) for n in (0, 1, 2, 3, 40, 500, 999, 3, 700, 300, 301)]
    texts += [None, "  ", "x" * 3000, "-" * 1000 + "ab" + "." * 900, " .ab" * 700]
    for order in (2, 5):
        want, got = Counter(), Counter()
        for i, t in enumerate(texts):
            p = X.plain(t)
            want.update((i % 4, p[j:j + order]) for j in range(len(p) - order + 1))
        for codes, at, owner, again in X._pieces(texts, order, order - 1):
            kinds, chars, n = X._counted(codes, at, owner % 4, order)
            assert not again.any() or again[0] == 0  # an overlap of less than an n-gram repeats none
            for k, c, m in zip(kinds, chars, n):
                got[int(k), "".join(map(chr, c))] += int(m)
        assert got == want
