"""Licence scan: matching statistics of a generalised suffix automaton.

The automaton holds every run of words of every template.  Reading a text
word by word it knows, at each place, the longest run ending there that
some template contains (the matching statistic), and by its suffix links the longest one
of every single template.  Runs that cannot grow in their template are
anchors; anchors that follow each other in a text as in a template are
chained.  A chain is a span if it covers enough of its template and all of
the words that tell the template's licence from others, and skips none of
such words in the text.  Of spans that overlap the one that covers most stays.

A phrase stands at a place exactly if it is a suffix of the run matched
there, which the automaton's suffix links tell, so phrases are counted in
the same pass, all places included.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import slices
from .licence_texts import MARKS, wordings
from .words import word_blocks

# Phrases whose places are counted.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}


def words_of(text: str) -> list[bytes]:
    return [w for block in word_blocks(text.encode()) for w in block]


class SuffixAutomaton:
    """All runs of words of several texts: a state stands for runs that end at the same places."""

    def __init__(self, texts: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        self._ends = ends
        for t, words in enumerate(texts):
            last = 0
            for i, word in enumerate(words):
                last = self._extend(last, word)
                ends[last].add((t, i + 1))
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            ends[self.link[s]] |= ends[s]
        #: places where the runs of a state end: (text, words before the end)
        self.ends = [sorted(e) if s else [] for s, e in enumerate(ends)]

    def _new(self, length: int, link: int, moves: dict[bytes, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self._ends.append(set())
        return len(self.length) - 1

    def _split(self, at: int, word: bytes, to: int) -> int:
        """The state of the runs ``at`` + ``word`` when ``to`` also holds longer ones."""
        part = self._new(self.length[at] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = part
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = part
            at = self.link[at]
        return part

    def _extend(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:  # another text has this run already
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        state, at = self._new(self.length[last] + 1, 0, {}), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            to = self.next[at][word]
            self.link[state] = to if self.length[to] == self.length[at] + 1 else self._split(at, word, to)
        return state


@dataclass
class Scan:
    """What a scan finds in one text."""
    n_words: int = 0
    places: list[tuple[int, int]] = field(default_factory=list)  # (first word, phrase)
    spans: list[tuple[int, int, int, int]] = field(default_factory=list)  # (first word, end, template, words covered)


@dataclass
class Chain:
    """Anchors of a template that follow each other; ``marks``: marks of the template that they cover."""
    first: int
    end: int
    template_end: int
    marks: int
    words: int


class LicenseScanner:
    """Scans texts for ``phrases`` and ``notices`` (label to wordings).

    ``min_run``: words of the shortest anchor; ``max_gap``: words that may
    stand between two anchors of a chain, in the text and in the template;
    ``min_cover``: share of a template that a span covers; ``marks``: words
    that name a licence.
    """

    def __init__(self, phrases: dict[str, str] = PHRASES, notices: dict[str, tuple[str, ...]] | None = None,
                 min_run: int = 2, max_gap: int = 4, min_cover: float = 0.8, marks: frozenset[str] = MARKS):
        self.min_run, self.max_gap, self.min_cover = min_run, max_gap, min_cover
        self.phrases = [(words_of(p), label) for p, label in phrases.items()]
        self.templates = [(words_of(w), label) for label, ws in (wordings() if notices is None else notices).items() for w in ws]
        self.longest = max((len(w) for w, _ in self.templates), default=0)
        self.marks = frozenset(m.encode() for m in marks)
        #: marks among the first words of a template, by how many
        self.marks_before = [[0, *accumulate(w in self.marks for w in words)] for words, _ in self.templates]
        self.auto = SuffixAutomaton([w for w, _ in self.templates] + [w for w, _ in self.phrases])
        n = len(self.templates)
        self.ends = [[(t, e) for t, e in ends if t < n] for ends in self.auto.ends]
        own: dict[int, list[int]] = {}
        for p, (words, _) in enumerate(self.phrases):
            own.setdefault(self._walk(words), []).append(p)
        #: phrases that are suffixes of the longest run of a state
        self.suffixes: list[list[int]] = [[] for _ in self.auto.length]
        for s in sorted(range(1, len(self.auto.length)), key=self.auto.length.__getitem__):
            self.suffixes[s] = own.get(s, []) + self.suffixes[self.auto.link[s]]
        self.vocabulary = frozenset(w for words, _ in self.templates + self.phrases for w in words) | self.marks

    def _walk(self, words: list[bytes]) -> int:
        state = 0
        for w in words:
            state = self.auto.next[state][w]
        return state

    def scan(self, text: bytes | None) -> Scan:
        out, known = Scan(), self.vocabulary
        nexts, link, length, suffixes = self.auto.next, self.auto.link, self.auto.length, self.suffixes
        chains: dict[int, list[Chain]] = {}
        marked: list[int] = []  # places of marks
        region: list[tuple[int, int, int]] = []  # places in a row where a run of some template ends: (end, state, run)
        state = run = 0
        seen = -2  # place of the last known word
        for block in word_blocks(text):
            first = out.n_words
            for i, word in enumerate(block, first):
                if word not in known:
                    continue
                if word in self.marks:
                    marked.append(i)
                if i != seen + 1:  # an unknown word ended the run
                    state = run = 0
                seen = i
                to = nexts[state].get(word)
                while to is None and state:
                    state = link[state]
                    run = length[state]
                    to = nexts[state].get(word)
                if to is None:
                    continue
                state, run = to, run + 1
                if run >= self.min_run:
                    if region and region[-1][0] != i:
                        self._anchors(out, chains, marked, region)
                        region = []
                    region.append((i + 1, state, run))
                if suffixes[state]:
                    for p in suffixes[state]:
                        if (n := len(self.phrases[p][0])) <= run:
                            out.places.append((i + 1 - n, p))
            out.n_words += len(block)
        self._anchors(out, chains, marked, region)
        out.spans = self._apart(out.spans)
        return out

    def _runs(self, state: int, run: int) -> dict[tuple[int, int], int]:
        """The longest runs that end here, by template and place in it."""
        found: dict[tuple[int, int], int] = {}
        while state and run >= self.min_run:
            for at in self.ends[state]:
                found.setdefault(at, run)
            state = self.auto.link[state]
            run = self.auto.length[state]
        return found

    def _anchors(self, out: Scan, chains: dict[int, list[Chain]], marked: list[int], region: list[tuple[int, int, int]]) -> None:
        """Chain the runs of a region that cannot grow in their template."""
        here = self._runs(*region[0][1:]) if region else {}
        for k, (end, _, _) in enumerate(region):
            after = self._runs(*region[k + 1][1:]) if k + 1 < len(region) else {}
            for (t, template_end), run in here.items():
                if (t, template_end + 1) not in after:
                    self._anchor(out, chains, marked, t, end, template_end, run)
            here = after

    def _anchor(self, out: Scan, chains: dict[int, list[Chain]], marked: list[int], t: int, end: int, template_end: int,
                run: int) -> None:
        start, before = end - run, self.marks_before[t]
        mine = chains.setdefault(t, [])
        if mine and mine[0].end + self.max_gap + self.longest < end:
            mine[:] = [c for c in mine if c.end + self.max_gap + self.longest >= end]
        best = Chain(start, end, template_end, before[template_end] - before[template_end - run], run)
        for c in mine:
            lap = max(c.end - start, c.template_end - (template_end - run), 0)
            if lap >= run or start - c.end > self.max_gap or template_end - run - c.template_end > self.max_gap:
                continue
            # the first lap words of the run are the chain's already; a mark in between names another licence
            skipped = bisect_left(marked, start + lap) - bisect_left(marked, c.end)
            marks = c.marks + before[template_end] - before[template_end - run + lap]
            if skipped <= 0 and (marks, c.words + run - lap) > (best.marks, best.words):
                best = Chain(c.first, end, template_end, marks, c.words + run - lap)
        mine.append(best)
        if best.marks == before[-1] and best.words >= self.min_cover * len(self.templates[t][0]):
            out.spans.append((best.first, best.end, t, best.words))

    @staticmethod
    def _apart(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Of spans that overlap the one that covers most words, then the shortest, then the first."""
        kept: list[tuple[int, int, int, int]] = []
        starts: list[int] = []
        for span in sorted(set(spans), key=lambda s: (-s[3], s[1] - s[0], s[0], s[2])):
            k = bisect_left(starts, span[0])
            if (k == 0 or kept[k - 1][1] <= span[0]) and (k == len(kept) or kept[k][0] >= span[1]):
                kept.insert(k, span)
                starts.insert(k, span[0])
        return kept

    def row(self, text: bytes | None) -> dict:
        found = self.scan(text)
        base = {self.phrases[p][1] for _, p in found.places}
        cover = [(self.templates[t][1], a, b, n / len(self.templates[t][0])) for a, b, t, n in found.spans]
        starts = [at for at, _ in found.places]
        return {
            "n_words": found.n_words, "n_base": len(starts),
            "first_word": min(starts, default=None), "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | {c[0] for c in cover})),
            "score": 1.0 if base else max((min(c[3], 1.0) for c in cover), default=0.0),
            "spans": [{"label": c[0], "start": c[1], "end": c[2], "cover": c[3]} for c in cover],
        }


SCAN_TYPE = ("struct<n_words: bigint, n_base: bigint, first_word: bigint, last_word: bigint, base_labels: string, "
             "labels: string, score: double, spans: array<struct<label: string, start: bigint, `end`: bigint, "
             "cover: double>>>")
_ARROW = pa.struct([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                  ("cover", pa.float64())]))),
])


def scan_column(text: Column, scanner: LicenseScanner | None = None) -> Column:
    """The scan of a text column as a struct (see ``license_scan``)."""
    scanner = scanner or LicenseScanner()

    @F.arrow_udf(SCAN_TYPE)
    def scan(texts: pa.Array) -> pa.Array:
        return pa.array([scanner.row(t) for some in slices(texts.cast(pa.large_binary())) for t in some], _ARROW)
    return scan(text.cast("string"))


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 scanner: LicenseScanner | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_base`` (all
    places of phrases), ``first_word`` and ``last_word`` (their smallest and
    largest start; null without any), ``base_labels``, ``labels`` (phrases
    and covered templates; sorted, comma-joined, empty without any),
    ``score`` (1 with a phrase, else the largest covered share of a
    template, 0 without a span) and ``spans``.

    Null and empty texts have no words and no labels.  Null or repeated ids
    keep their rows; an empty table gives none.  Of spans that overlap the
    one that covers most words stays, of those that tie the shortest, then
    the first.  Whole texts are read, in blocks of bounded size; the
    automaton is a fixed value that travels with the task.  Other columns
    are not looked at.
    """
    return (docs.select(F.col(doc_id).alias("doc_id"), scan_column(F.col(text), scanner).alias("scan"))
            .select("doc_id", "scan.*"))
