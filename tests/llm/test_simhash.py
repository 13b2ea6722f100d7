import random
import re
from collections import Counter

import xxhash

from lettermon.llm.components import components
from lettermon.llm.simhash import cell_offsets, fingerprint, links, segment_edges, simhash_groups, simhash_survivors


def plain_fingerprint(text, n=3):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    ones = Counter(b for g in grams for h in [xxhash.xxh64(g.encode(), seed=42).intdigest()] for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_is_the_plain_one(spark):
    rng = random.Random(2)
    for _ in range(150):
        text = "".join(rng.choice("aB é\x0b\x0c\n\t 中\u00a0\x1f") for _ in range(rng.randint(0, 300)))
        assert fingerprint(text.encode()) == signed(plain_fingerprint(text))
    assert fingerprint(None) == fingerprint(b" \t") == 0
    big = " ".join(str(i % 977) for i in range(150_000))
    assert fingerprint(big.encode()) == signed(plain_fingerprint(big))
    from pyspark.sql import functions as F
    h = spark.sql("select 'a b c' s").select(F.xxhash64("s")).first()[0]
    assert fingerprint(b"a b c") == h  # one shingle: its hash, the one that Spark has too


def test_fingerprint_does_not_depend_on_blocks():
    rng = random.Random(3)
    for _ in range(150):
        text = "".join(rng.choice("aB é\n") for _ in range(rng.randint(0, 40)))
        for shingle in (1, 3, 5):
            want = signed(plain_fingerprint(text, shingle))
            assert {fingerprint(text.encode(), shingle, block) for block in (1, 4, 9, 1000)} == {want}


def test_offsets_cover_the_ball_from_one_side():
    from itertools import product
    segments, reach = 4, 2
    edges = segment_edges(segments)
    base = 16 + 2 * reach + 1
    assert edges == [0, 16, 32, 48, 64]
    ball = {sum(d * base ** i for i, d in enumerate(v)) for v in product(range(-2, 3), repeat=4) if sum(map(abs, v)) <= reach}
    half = set(cell_offsets(segments, reach))
    assert half | {-x for x in half} == ball and len(half) == (len(ball) + 1) // 2


def test_links_against_all_pairs(spark):
    rng = random.Random(4)
    values = {rng.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1, 1, 3, 7}
    for v in list(values)[:40]:
        for _ in range(3):
            values.add(v ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 3))) & ((1 << 64) - 1))
    values = sorted(signed(v) for v in values)
    want = {(min(a, b), max(a, b)) for a in values for b in values if a < b
            and bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 2}
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    for segments in (8, 10, 16):
        got = [(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in links(df, "fp", 2, segments).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 299), (299, 300), (298, 299)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 160))
    assert got[298] == got[299] == got[300] == 298
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_groups(rows):
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    left, out = set(range(len(fps))), [None] * len(fps)
    while left:
        group, todo = set(), [min(left)]
        while todo:
            k = todo.pop()
            if k in group:
                continue
            group.add(k)
            todo += [j for j in left if j not in group and bin(fps[j][1] ^ fps[k][1]).count("1") <= 2]
        ids = [fps[k][0] for k in group if fps[k][0] is not None]
        for k in group:
            out[k] = min(ids, default=None)
        left -= group
    return [(str(i), f"{f:016x}", str(c)) for (i, f), c in zip(fps, out)]


def test_groups_of_odd_documents(docs, no_docs):
    from lettermon.llm.queries import hex64
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = simhash_groups(docs).select("doc_id", hex64("fp").alias("f"), "component_id").collect()
    assert sorted((str(r["doc_id"]), r["f"], str(r["component_id"])) for r in got) == sorted(brute_groups(rows))
    kept = simhash_survivors(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({(f, c) if c == "None" else c for _, f, c in brute_groups(rows)})
    assert simhash_groups(no_docs).collect() == [] and simhash_survivors(no_docs).collect() == []


def test_tables_against_brute_force(spark):
    from lettermon.llm.queries import op7_simhash, table
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    got = sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in op7_simhash(spark, sf).collect())
    assert got == sorted(brute_groups(rows))
