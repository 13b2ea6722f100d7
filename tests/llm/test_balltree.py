import math
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from lettermon.llm.balltree import BallTree, Vectors, ranked_search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    """``(item number, rank, doc_id, score)`` by the formula, for ``(id, text)`` rows."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for k, (_, text) in enumerate(items):
        hits = []
        for i, bag in bags:
            n = sum(bag.values())
            m = 100 - 75 + (75 * n * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * bag[w]) // (1000 * bag[w] + 8 * m))
                        for w in terms(text) if w in bag)
            if score > 0:
                hits.append((-score, i is None, i or 0, i))
        out += [(k, r, h[3], -h[0]) for r, h in enumerate(sorted(hits)[:top], 1)]
    return out


def vectors(rows):
    sizes = [len(r) for r in rows]
    return Vectors(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
                   np.array([c for r in rows for c in sorted(r)], np.int64), np.array([r[c] for r in rows for c in sorted(r)], np.int64))


def random_rows(rng, n, width, most):
    kinds = [{c: rng.randint(1, most) for c in rng.sample(range(width), rng.randint(1, 12))} for _ in range(max(n // 3, 1))]
    return [dict(rng.choice(kinds)) if rng.random() < 0.5 else
            {c: rng.randint(1, most) for c in rng.sample(range(width), rng.randint(1, 12))} for _ in range(n)]


@pytest.mark.parametrize("n, most", [(1, 9), (40, 5), (300, 1_000_000), (1000, 3)])
def test_tree_against_all_documents(n, most):
    rng = random.Random(n)
    rows, width = random_rows(rng, n, 60, most), 60
    tree = BallTree(vectors(rows), width, leaf=8)
    assert sorted(tree.order.tolist()) == list(range(n))
    ids = np.array([rng.randint(0, n) for _ in range(n)])
    for _ in range(30):
        query = {c: rng.randint(-50, 30_000) for c in rng.sample(range(width), rng.randint(1, 20))}
        cols, weights = np.array(list(query)), np.array(list(query.values()))
        scores = [sum(query.get(c, 0) * v for c, v in r.items()) for r in rows]
        bounds = tree.bounds(cols, weights)
        for k, (a, b) in enumerate(zip(tree.first, tree.last)):  # no document above the bound of any of its nodes
            assert max(scores[i] for i in tree.order[a:b]) <= bounds[k]
        hits = []
        tree.search(cols, weights, ids, hits)
        want = sorted(((s, -int(i)) for s, i in zip(scores, ids) if s > 0), reverse=True)[:10]
        assert sorted(hits, reverse=True) == want


def test_search_goes_on_with_the_hits_of_other_trees():
    rng = random.Random(2)
    parts = [random_rows(rng, 200, 40, 1000) for _ in range(4)]
    cols, weights = np.array([1, 5, 9]), np.array([7, 100, 3])
    hits, every, read = [], [], []
    for k, rows in enumerate(parts):
        ids = np.arange(200) + 200 * k
        read.append(BallTree(vectors(rows), 40, leaf=4).search(cols, weights, ids, hits))
        every += [(sum(dict(zip(cols, weights)).get(c, 0) * v for c, v in r.items()), -int(i)) for r, i in zip(rows, ids)]
    assert sorted(hits, reverse=True) == sorted((x for x in every if x[0] > 0), reverse=True)[:10]


def test_far_subtrees_are_not_read():
    rows = [{c: 1000 + i for c in range(g * 5, g * 5 + 5)} for g in range(8) for i in range(64)]
    tree = BallTree(vectors(rows), 40, leaf=8)
    read = tree.search(np.arange(5), np.full(5, 10), np.arange(len(rows)), [])
    assert 2 <= read <= 10 < len(rows) / 8


def items_of(docs):
    texts = [t for _, t in docs]
    return [(1, texts[3]), (2, texts[5][:60] + " unknownword"), (3, "the the the THE der"), (4, None), (5, "!!"), (None, texts[7]),
            (1, texts[4]), (6, "é" * 10), (7, "0123 456 x"), (8, texts[9] * 3)]


@pytest.mark.parametrize("options", [{}, {"tree": 4, "leaf": 2}, {"block_words": 30, "tree": 7}])
def test_odd_documents(spark, docs, no_docs, options):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    items = items_of(rows)
    frame = spark.createDataFrame([(*i, "a", 1) for i in [*items, items[0]]], "item_id long, text string, score string, item long")
    got = ranked_search(docs, frame, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    found = [(str(r["item_id"]), r["rank"], str(r["doc_id"]), r["score"]) for r in got.collect()]
    assert sorted(found) == sorted((str(items[k][0]), r, str(i), s) for k, r, i, s in brute(rows, items))
    assert ranked_search(no_docs, frame, **options).collect() == []
    assert ranked_search(docs, frame.limit(0), **options).collect() == []


def test_ids_of_items_keep_their_type_and_top_its_number(spark):
    docs = spark.createDataFrame([(i, f"alpha {'beta ' * (i % 3)}w{i}") for i in range(30)], "doc_id long, text string")
    items = spark.createDataFrame([("it1", "beta alpha")], "item_id string, text string")
    got = [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in ranked_search(docs, items, top=25).collect()]
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [("it1", "beta alpha")], 25)
    assert sorted(got) == [("it1", r, i, s) for _, r, i, s in want] and len(got) == 25


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver data not present")
def test_query_equals_its_sql(spark):
    from lettermon.llm.oracles import ORACLE_SQL
    from lettermon.llm.queries import op11_ranked_search
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    got = op11_ranked_search(spark, "/root/testdata/sf0.001")
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL['op11_ranked_search']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 50
