import functools
import random
import re

from lettermon.llm.licence_texts import wordings
from lettermon.llm.licenses import PHRASES, LicenseScanner, SuffixAutomaton, license_scan, words_of
from lettermon.llm.words import word_blocks

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute(text):
    words = WORD.findall(ascii_lower(text or ""))
    places = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})))


def test_words_match_the_pattern():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("aZ09 .-_`{~é中\x00\x7f\n\u00a0\u0130K") for _ in range(rng.randint(0, 60)))
        want = [w.encode() for w in WORD.findall(ascii_lower(text))]
        for size in (1, 5, 1000):
            assert [w for b in word_blocks(text.encode(), size) for w in b] == want


def test_automaton_knows_exactly_the_runs():
    rng = random.Random(5)
    for _ in range(60):
        texts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 9))] for _ in range(rng.randint(1, 4))]
        auto = SuffixAutomaton(texts)
        runs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        for length in range(1, 5):
            for _ in range(30):
                run = tuple(rng.choice([b"a", b"b", b"c"]) for _ in range(length))
                state = 0
                for w in run:
                    state = auto.next[state].get(w)
                    if state is None:
                        break
                assert (state is not None) == (run in runs)
                if state is not None:
                    ends = {(k, i + length) for k, t in enumerate(texts) for i in range(len(t) - length + 1)
                            if tuple(t[i:i + length]) == run}
                    assert ends == set(auto.ends[state])


def test_places_against_brute_force():
    rng = random.Random(7)
    scanner = LicenseScanner()
    vocab = "mit license apache general public the of License, MIT Public x Lizenz under version 2 0 gnu\n".split(" ")
    for _ in range(800):
        text = rng.choice([" ", "-", "\n"]).join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))
        row = scanner.row(text.encode())
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == brute(text)
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1


def test_chained_notice_with_changes():
    scanner = LicenseScanner()
    notice = ("xx Permission is hereby granted, free of charge, to any person who is obtaining a copy of this software and "
              "associated documentation files (the \"Software\"), to deal in the Software without any restriction, including "
              "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
              "copies of the Software, and to permit persons to whom the Software is furnished to do so yy")
    row = scanner.row(notice.encode())
    assert row["labels"] == "mit" and row["base_labels"] == "" and 0.8 <= row["score"] <= 1
    assert row["spans"][0]["start"] == 1 and row["spans"][0]["end"] == row["n_words"] - 1
    half = " ".join(notice.split()[:20])
    assert scanner.row(half.encode())["labels"] == ""


def test_notice_across_blocks():
    text = ("filler " * 200_000 + "Licensed under CC BY-NC 4.0. " + "filler " * 10).encode()
    row = LicenseScanner().row(text)
    assert row["labels"] == "cc-by-nc" and row["spans"][0]["start"] == 200_000
    assert words_of("CC BY-NC 4.0.") == [b"cc", b"by", b"nc", b"4", b"0"]


def test_odd_documents(spark, docs, no_docs):
    got = license_scan(docs)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    texts = {(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()}
    want = sorted((i, *brute(t)[:2]) for i, t in texts if i is not None)
    seen = sorted({(r["doc_id"], r["n_words"], r["n_base"]) for r in got.collect() if r["doc_id"] is not None})
    assert seen == want and got.count() == docs.count()
    assert license_scan(no_docs).collect() == []


def brute_spans(scanner, text):
    """Spans by trying every diagonal of every template and every chain of its runs."""
    words = words_of(text)
    marked = [w in scanner.marks for w in words]
    spans = set()
    for t, (own, _) in enumerate(scanner.templates):
        runs = []
        for d in range(-len(own) + 1, len(words)):
            k = max(d, 0)
            while k < len(words) and k - d < len(own):
                start = k
                while k < len(words) and k - d < len(own) and words[k] == own[k - d]:
                    k += 1
                if k - start >= scanner.min_run:
                    runs.append((start, k, k - d))
                k = max(k, start + 1)
        runs.sort(key=lambda r: r[1])
        need = sum(w in scanner.marks for w in own)

        def covered(a, b, own=own):
            return sum(w in scanner.marks for w in own[a:b])

        @functools.cache
        def best(i, runs=tuple(runs), t=t):
            start, end, at = runs[i]
            options = [(covered(at - (end - start), at), end - start, start)]
            for j, (a, b, c) in enumerate(runs):
                lap = max(b - start, c - (at - (end - start)), 0)
                if b < end and lap < end - start and start - b <= scanner.max_gap and at - (end - start) - c <= scanner.max_gap \
                        and not any(marked[b:start + lap]):
                    m, n, first = best(j)
                    options.append((m + covered(at - (end - start) + lap, at), n + end - start - lap, first))
            return max(options, key=lambda o: o[:2])
        for i, (_, end, _) in enumerate(runs):
            marks, n, first = best(i)
            if marks == need and n >= scanner.min_cover * len(own):
                spans.add((end, t, n))
    return spans


def test_spans_against_brute_force_chaining():
    rng = random.Random(13)
    vocab = "a b c d mit gnu the of software".split()
    for _ in range(150):
        notices = {f"l{k}": (" ".join(rng.choice(vocab) for _ in range(rng.randint(3, 14))),) for k in range(4)}
        scanner = LicenseScanner(notices=notices, max_gap=rng.randint(0, 4), min_cover=rng.choice([0.6, 0.8]))
        found = []
        scanner._apart = lambda spans: found.append(spans) or spans
        parts = [rng.choice(list(notices.values()))[0] if rng.random() < 0.5 else rng.choice([*vocab, "x"]) for _ in range(8)]
        words = " ".join(parts).split()
        text = " ".join(w for w in words if rng.random() > 0.1)
        scanner.scan(text.encode())
        assert {(e, t, n) for _, e, t, n in found[0]} == brute_spans(scanner, text), (notices, text)


def test_overlapping_spans_keep_the_best():
    rng = random.Random(1)
    for _ in range(200):
        spans = [(a := rng.randint(0, 40), a + rng.randint(1, 15), rng.randint(0, 5), rng.randint(1, 9)) for _ in range(12)]
        kept = LicenseScanner._apart(spans)
        assert all(x[1] <= y[0] for x, y in zip(kept, kept[1:]))
        for s in spans:  # one that went overlaps one that covers as much or more
            assert s in kept or any(k[0] < s[1] and s[0] < k[1] and k[3] >= s[3] for k in kept)


def test_every_wording_finds_itself_and_no_other_licence():
    scanner = LicenseScanner()
    base = {"apache license": "apache", "mit license": "mit", "general public license": "gpl"}
    for label, texts in wordings().items():
        for wording in texts:
            for text in (wording, f"// Copyright 2020 by us.\n * {wording}\n * end of it"):
                row = scanner.row(text.encode())
                also = {x for p, x in base.items() if p in " ".join(w.decode() for w in words_of(text))}
                assert set(row["labels"].split(",")) == {label} | also, (label, text)
                assert row["spans"] and all(s["label"] == label for s in row["spans"])


def test_every_pair_of_wordings():
    """Two wordings after each other give both licences, and no third."""
    scanner = LicenseScanner()
    every = [(label, w) for label, ws in wordings().items() for w in ws]
    for x, a in every:
        for y, b in every[::3]:
            spans = scanner.row(f"{a}\nfiller words stand in between them\n{b}".encode())["spans"]
            assert {s["label"] for s in spans} == {x, y}, (a[:60], b[:60])


def test_names_that_differ_in_one_word():
    scanner = LicenseScanner()
    for text, labels in (
            ("Licensed under CC BY-ND 4.0.", "cc-by-nd"), ("Licensed under CC BY-NC-SA 4.0", "cc-by-nc-sa"),
            ("Licensed under CC BY-NC-ND 4.0", "cc-by-nc-nd"), ("Licensed under CC BY 4.0", "cc-by"),
            ("This is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "cc-by-nc-sa"),
            ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 "
             "which is available at https://www.eclipse.org/legal/epl-2.0/", "epl"),
            ("Distributed under the Boost Software License, Version 1.0. (See accompanying file)", "boost"),
            ("Licensed under the EUPL, Version 1.2", "eupl"), ("# SPDX-License-Identifier: EPL-2.0", "epl"),
            ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl"), ("SPDX-License-Identifier: CC-BY-NC-SA-4.0", "cc-by-nc-sa"),
            ("licensed under the GNU Affero General Public License", "agpl,gpl"),  # the phrase's own label stays
            ("Licensed under CC BY-XX 4.0.", "cc-by"), ("Licensed under terms of our own", "")):
        assert scanner.row(text.encode())["labels"] == labels, text
