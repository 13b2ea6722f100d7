import hashlib
import random

import pytest

from lettermon.llm.bpe import TREE_OVER, TreeEncoder, decode_batch, decoded, encode_round_trip, load_tokenizer, token_ids
from lettermon.llm.queries import tokenizer_path

PARTS = ["a", "b", "the", "<|endoftext|>", "<|start", "oftext|>", "'", "'s", "'ll", "!!!", "é", "e\u0301", "\u0301", "ß", "\u0130",
         "中文", "한", "\u1112\u1161\u11ab", "1", "23", " ", "  ", "\n", "\t", "\u00a0", "\u2028", "\x0b", "\x0c", "\x85", "\x00",
         "\U0001f600", "\U0001f468\u200d\U0001f469", "Ω", "ς", "Σ", "ing", "tion", "x" * 30, "'" * 5, "नि", "ि"]


@pytest.fixture(scope="module")
def tok():
    return load_tokenizer(tokenizer_path())


def texts(seed, n, longest):
    rng = random.Random(seed)
    for _ in range(n):
        parts = PARTS if rng.random() < 0.6 else ["a", "b", "th", "in", "é", "ou"]
        yield "".join(rng.choice(parts) for _ in range(rng.randint(0, longest)))


def test_tree_and_words_are_the_library(tok):
    for text in texts(1, 400, 300):
        want = tok.encode(text, add_special_tokens=False).ids
        for leaf in (4, 17, 60, 10**9):
            for window in (1, 8):
                assert TreeEncoder(tok, leaf, window, memory=20).encode_batch([text])[0] == want


def test_long_unsplit_text(tok):
    rng = random.Random(3)
    for text in ("".join(rng.choice("thinerouabcdé") for _ in range(60_000)), "a" * 50_000, "\u0301" * 3_000, "!'s" * 9_000):
        assert TreeEncoder(tok, 4096).encode_batch([text])[0] == tok.encode(text, add_special_tokens=False).ids


def test_decoding_is_the_library(tok):
    batch = [tok.encode(t, add_special_tokens=False).ids for t in texts(5, 60, 200)] + [[]]
    assert decode_batch(tok, batch) == tok.decode_batch(batch, skip_special_tokens=False)


def test_other_tokenizers_decode_with_their_decoder(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    df = spark.createDataFrame([(1, "Ünï code 'tis <|endoftext|>\n x"), (2, None)], "doc_id long, text string")
    ids = df.select("doc_id", token_ids(df["text"], path, leaf=6, over=6).alias("ids"))
    got = {r["doc_id"]: (r["ids"], r["back"]) for r in ids.withColumn("back", decoded(ids["ids"], path)).collect()}
    want = load_tokenizer(path).encode("Ünï code 'tis <|endoftext|>\n x", add_special_tokens=False).ids
    assert got == {1: (want, "Ünï code 'tis <|endoftext|>\n x"), 2: ([], "")}


def test_tokenizers_that_keep_spaces():
    tok = load_tokenizer(tokenizer_path("byte_bpe_50k.json"))
    assert not TreeEncoder(tok).by_word
    for text in texts(9, 100, 200):
        want = tok.encode(text, add_special_tokens=False).ids
        for leaf in (30, 10**9):
            assert TreeEncoder(tok, leaf).encode_batch([text])[0] == want


def test_odd_documents(docs, no_docs, tok):
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    def row(i, t):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        return str(i), len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))
    want = sorted(row(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    for sizes in ({}, {"leaf": 1000, "over": 1000}):
        got = encode_round_trip(docs, tokenizer_path(), **sizes).collect()
        assert sorted((str(r[0]), r[1], r[2], r[3]) for r in got) == want
    assert encode_round_trip(no_docs, tokenizer_path()).collect() == []


def test_texts_from_32768_characters_on_are_trees(monkeypatch):
    encoder = TreeEncoder(load_tokenizer(tokenizer_path()), over=TREE_OVER)
    trees, tree = [], encoder._tree
    monkeypatch.setattr(encoder, "_tree", lambda text: trees.append(len(text)) or tree(text))
    texts = [("Some words, über 12 of them.\n" * 2000)[:n] for n in (30_000, 40_000)]
    assert encoder.encode_batch(texts) == [encoder.tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert trees == [40_000]
