import os
import re

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from lettermon.llm import oracles, queries
from lettermon.llm.bpe import load_tokenizer
from lettermon.llm.queries import table, tokenizer_path

from .test_decontaminate import brute as items_in
from .test_exact import brute as exact
from .test_simhash import brute_groups

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")


def expected(docs, items):
    """Ids that stay and their token counts, by brute force."""
    docs = [(i, t) for i, t in docs if t and any(map(str.isalpha, t))]
    keep = {(n, none, i) for n, none, i in (g[0] for g in exact(docs).values())}
    docs = [(i, t) for i, t in docs if (-len(t), False, i) in keep]
    docs = [d for d, (i, _, c) in zip(docs, brute_groups(docs)) if i == c]
    docs = [(i, t) for i, t in docs if not items_in(items, t)]
    tok = load_tokenizer(tokenizer_path())
    return sorted((i, len(tok.encode(t, add_special_tokens=False).ids)) for i, t in docs)


def test_pipeline_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    got = corpus_pipeline.run(spark, SF).collect()
    want = expected(docs, items)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got) == want and 0 < len(want) < len(docs)


def test_stages_on_odd_documents(spark, docs, no_docs):
    for frame in (docs, no_docs):
        at = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, at, SF)
            assert out.columns == frame.columns, name
            assert out.count() <= at.count()
            at = out
        assert corpus_pipeline.STAGES[-1][1](spark, at, SF).count() == at.count()
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs, SF).collect()}
    assert kept.isdisjoint({100, 101, 102, 105}) and 106 in kept


def test_registered():
    names = list(E.queries())
    for n in range(1, 11):
        assert sum(re.match(rf"op{n}_", q) is not None for q in names) == 1
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(oracles.ORACLE_SQL))
def test_sql_parity(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    rel = con.sql(oracles.ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert sorted(rel.columns) == cols
    at = {c: k for k, c in enumerate(rel.columns)}
    want = sorted((tuple(r[at[c]] for c in cols) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == want
