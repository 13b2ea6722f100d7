"""Main text of web pages: the maximum-scoring run of words and tags.

A page is read as a sequence of words and tags.  Words score positive and
tags negative, by weights learned from labelled pages (those whose markup
names the article); one linear scan finds the contiguous run with the
largest sum.  Elements that are never part of an article (menus, forms,
adverts, comments, ...) are taken out wherever they stand.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import slices

# Element names of HTML by their part in a page, and words that class, id and role use.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre
    section summary table tbody td tfoot th thead tr ul""".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp
    small span strike strong sub sup time tt u var wbr""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUT = frozenset("""aside button canvas datalist dialog fieldset footer form iframe input legend menu nav noscript
    object option select svg template""".split())
OUT_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
    consent cookie cookies copyright disqus footer masthead menu modal nav navbar navigation newsletter notice notices
    pagination popup promo promoted related replies reply respond share sharing sidebar social sponsor sponsored
    subscribe toolbar widget alert alertdialog complementary contentinfo search""".split())
HEADER_WORDS = frozenset("banner header masthead".split())
#: Parts that may stand beside those words in a name of the same meaning (``ad-slot``, ``site_footer``); with any other
#: part (``has-sidebar``, ``social-science``) a name tells of a layout or a topic.
BESIDE_WORDS = frozenset("""area bar block bottom box btn button buttons container content form global group inner left
    link links list main outer page panel post posts primary right secondary section signup site slot top unit wrap
    wrapper""".split())
RAW = ("script", "style", "title", "textarea", "xmp", "noembed", "noframes")
ARTICLE = ("article", "main")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Parts of an article whose id is mostly made of their own title, and the ids that name readers' comments all the same.
TITLED = HEADINGS | {"p", "section"}
COMMENT_IDS = frozenset("comment comments disqus replies respond".split())
# The rules of HTML for end tags that are left out: what no end is looked for beyond, ...
_TABLE = frozenset("caption table tbody td tfoot th thead tr".split())
_SCOPE = frozenset("caption object table td template th".split())
_SPECIAL = BLOCKS | frozenset("button iframe object select template".split())
_LIST = _SPECIAL - {"address", "div", "p"}
# ... which open elements a start tag ends, up to which other element, ...
_ENDS = {
    "li": ({"li"}, _LIST), "dt": ({"dt", "dd"}, _LIST), "dd": ({"dt", "dd"}, _LIST),
    "td": ({"td", "th"}, {"tr", "table", "template"}), "th": ({"td", "th"}, {"tr", "table", "template"}),
    "tr": ({"caption", "td", "th", "tr"}, {"table", "template"}),
    **{x: (_TABLE - {"table"}, {"table", "template"}) for x in ("tbody", "tfoot", "thead")},
    "option": ({"option"}, _SPECIAL), "optgroup": ({"option", "optgroup"}, _SPECIAL),
    "button": ({"button"}, _SCOPE), "a": ({"a"}, _SPECIAL), **{x: (HEADINGS, _SPECIAL - HEADINGS) for x in HEADINGS},
}
# ... and up to which element an end tag looks for its start (others: a block up to _SCOPE, the rest up to _SPECIAL).
_END_UP_TO = {
    **{x: frozenset() for x in ARTICLE}, **{x: frozenset(("table", "template")) for x in _TABLE},
    "li": _SCOPE | {"dir", "menu", "ol", "ul"}, "dt": _SCOPE | {"dl"}, "dd": _SCOPE | {"dl"},
}
#: Elements that are followed at once; of deeper ones only how many of a name are open is kept.
DEPTH = 512

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>]).*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<[a-z/!?][^>]*+(?:>|\Z)", re.S | re.I)
_ATTR = re.compile(r"""([^\s"'/=>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|"[^"]*"|'[^']*'""")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_PART = re.compile(r"[a-z]+", re.I)


def _attributes(attrs: str) -> dict[str, str]:
    """Attributes by lower-case name; of repeated ones the first counts."""
    found: dict[str, str] = {}
    for m in _ATTR.finditer(attrs):
        if m[1]:
            found.setdefault(m[1].lower(), (m[2] or "").strip("\"'").lower())
    return found


def _outside(names: list[str], words: frozenset[str]) -> bool:
    """Whether a name as a whole says that its element is no part of an
    article: it is one of ``words``, or made of those and what may stand beside them."""
    for name in names:
        parts = _PART.findall(name)
        if any(p in words for p in parts) and all(p in words or p in BESIDE_WORDS for p in parts):
            return True
    return False


def _left_out(name: str, attrs: str, in_article: bool, by_name: bool = True) -> bool:
    """Whether an element is no part of any article; ``by_name``: whether class, id and role count."""
    if name in ("html", "head", "body", *ARTICLE):
        return False
    if name in OUT:
        return True
    if name == "header":
        return not in_article  # an article's own header holds its title
    given = _attributes(attrs) if attrs.strip(" /") else {}
    if "hidden" in given or given.get("aria-hidden") == "true" or _NO_DISPLAY.search(given.get("style", "")):
        return True
    if not by_name or not given:
        return False
    titled = in_article and name in TITLED
    if titled and name == "section" and given.get("id") in COMMENT_IDS:
        return True
    names = [w for a in ("class", "id", "role") if a != "id" or not titled for w in given.get(a, "").split()]
    if _outside(names, HEADER_WORDS):
        return not in_article
    return _outside(names, OUT_WORDS)


class _Open:
    """The open elements of a page, outermost first, and which of them, if
    any, is left out (``out``, else -1).  Elements end as in HTML: by their
    end tag, or, without one, by a sibling or with an element around them."""

    def __init__(self):
        self.names: list[str] = []
        self.starts: list[int] = []
        self.counts: Counter = Counter()
        self.deeper: Counter = Counter()  # of elements open beyond DEPTH
        self.around = self.deeper  # of those around the one that is left out
        self.out = -1
        self.endless: set[int] = set()  # where elements start that ended without a tag of their own

    def cut(self, k: int, own: int = 0) -> None:
        """Close element ``k`` and all in it (``own``: 1 if by its own end tag)."""
        self.endless.update(self.starts[k + own:])
        for name in self.names[k:]:
            self.counts[name] -= 1
        del self.names[k:], self.starts[k:]
        if self.out >= k:
            self.out, self.deeper = -1, self.around
        if len(self.names) < DEPTH:
            self.deeper = Counter()

    def find(self, wanted, stop, outermost: bool = False) -> int:
        found = -1
        if any(self.counts[w] for w in wanted):
            for k in range(len(self.names) - 1, -1, -1):
                if self.names[k] in wanted:
                    found = k
                    if not outermost:
                        break
                elif self.names[k] in stop:
                    break
        return found

    def _paragraph(self) -> None:
        if self.counts["p"] and (k := self.find(("p",), _SCOPE | {"button"})) >= 0:
            self.cut(k)  # a block ends an open paragraph

    def before(self, name: str) -> None:
        """Close what a start tag ends."""
        if name in BLOCKS:
            self._paragraph()
        if name in _ENDS and (k := self.find(*_ENDS[name], outermost=True)) >= 0:
            self.cut(k)

    def push(self, name: str, start: int, out: bool = False) -> None:
        """Open an element, left out if ``out``.  Beyond ``DEPTH`` only one that is left out is followed."""
        if len(self.names) >= DEPTH and not out:
            self.deeper[name] += 1
            return
        if out:
            self.out, self.around, self.deeper = len(self.names), self.deeper, Counter()
        self.names.append(name)
        self.starts.append(start)
        self.counts[name] += 1

    def end(self, name: str) -> bool:
        """Close what an end tag ends; whether there was any."""
        if self.deeper[name]:
            self.deeper[name] -= 1
            return True
        if name in BLOCKS and name != "p":
            self._paragraph()
        wanted = HEADINGS if name in HEADINGS else (name,)
        k = self.find(wanted, _END_UP_TO.get(name, _SCOPE if name in BLOCKS or name in OUT else _SPECIAL))
        if k < 0 <= self.out and self.names[self.out] in wanted and not any(x in wanted for x in self.names[self.out + 1:]):
            k = self.out
        if k >= 0:
            self.cut(k, 1)
        return k >= 0


def _opens(name: str, attrs: str) -> bool:
    return name not in VOID and name not in ("html", "head", "body") and not attrs.rstrip().endswith("/")


def _endless(markup: str) -> set[int]:
    """Where the elements of a page start that have no end tag."""
    open_ = _Open()
    for m in _TOKEN.finditer(markup):
        name = (m["name"] or "").lower()
        if name and m["end"]:
            open_.end(name)
        elif name:
            open_.before(name)
            if _opens(name, m["attrs"]):
                open_.push(name, m.start())
    open_.cut(0)
    return open_.endless


class Page:
    """A page as tokens: ``(feature, words, block, in article, left out)``;
    tags have no words, words carry the block they belong to."""

    def __init__(self, markup: str | None):
        if not self._read(markup):
            # every article is in an element whose class, id or role would take it out: a wrapper, so names outside do not count
            self._read(markup, by_name=False)

    def _read(self, markup: str | None, by_name: bool = True) -> bool:
        """Read the page; whether it has an article that is not left out, or none at all."""
        self.tokens: list[tuple[str, int, int, bool, bool]] = []
        self.blocks: list[list[str]] = [[]]
        self.labelled = hidden = False
        open_, endless, runs_on = _Open(), None, {}
        article = links = heads = items = 0
        at, markup = 0, markup or ""
        for m in _TOKEN.finditer(markup):
            self._words(markup[at:m.start()], links, heads, items, article, open_.out >= 0)
            at = m.end()
            name = (m["name"] or "").lower()
            if not name:
                continue
            end, attrs = bool(m["end"]), m["attrs"]
            if name in BLOCKS:
                if self.blocks[-1]:
                    self.blocks.append([])
                if not end:
                    links = 0
            elif name == "br":
                self.blocks[-1].append(" ")
            if end:
                if not open_.end(name) and name in ARTICLE and article and open_.out >= 0:
                    open_.cut(open_.out)
            else:
                open_.before(name)
                if open_.out >= 0 and name in ARTICLE:
                    hidden = True
                    # an article inside stays out, unless it is only inside because an end tag is missing
                    out = open_.starts[open_.out]
                    if out not in runs_on:
                        endless = _endless(markup) if endless is None else endless
                        runs_on[out] = any(s in endless for n, s in zip(open_.names, open_.starts[:open_.out + 1])
                                           if n == open_.names[open_.out])
                    if runs_on[out]:
                        open_.cut(open_.out)
                        links = heads = items = 0
                opens = _opens(name, attrs)
                if open_.out < 0 and _left_out(name, attrs, article > 0, by_name or article > 0):
                    if opens:
                        open_.push(name, m.start(), out=True)
                    self.tokens.append((_feature(name), 0, -1, article > 0, True))
                    continue
                if opens:
                    open_.push(name, m.start())
            out = open_.out >= 0
            step = -1 if end else 1
            if name in ARTICLE and not out:
                article = max(0, article + step)
                self.labelled = True
            elif name == "a":
                links = max(0, links + step)
            elif name in ("h1", "h2", "h3", "h4", "h5", "h6"):
                heads = max(0, heads + step)
            elif name == "li":
                items = max(0, items + step)
            elif name in ("ul", "ol") and end:
                items = 0
            if name not in ARTICLE:
                self.tokens.append((_feature(name), 0, -1, article > 0, out))
        self._words(markup[at:], links, heads, items, article, open_.out >= 0)
        return self.labelled or not hidden

    def _words(self, text: str, links: int, heads: int, items: int, article: int, out: bool) -> None:
        if not text:
            return
        text = _html.unescape(text)
        if n := len(text.split()):
            kind = "word in link" if links else "word in heading" if heads else "word in item" if items else "word"
            self.tokens.append((kind, n, len(self.blocks) - 1, article > 0, out))
        if not out:
            self.blocks[-1].append(text)

    def features(self) -> Iterator[tuple[str, int, bool]]:
        """Each feature that the scan will score, with its count and whether it is part of the article."""
        for kind, n, _, article, out in self.tokens:
            if not out:
                yield kind, n or 1, article

    def text(self, weights: dict[str, float]) -> str:
        """The blocks of the best run, joined by line ends."""
        best = total = 0.0
        first = None
        run: tuple[int, int] | None = None
        for i, (kind, n, _, _, out) in enumerate(self.tokens):
            if out:
                continue
            total += n * weights.get(kind, WORD) if n else weights.get(kind, TAG)
            if total <= 0:
                total, first = 0.0, None
                continue
            if first is None:
                first = i
            if total > best:
                best, run = total, (first, i)
        if run is None:
            return ""
        inside = sorted({b for _, n, b, _, out in self.tokens[run[0]:run[1] + 1] if n and not out})
        joined = (" ".join("".join(self.blocks[b]).split()) for b in inside)
        return "\n".join(t for t in joined if t)


def _feature(name: str) -> str:
    return f"tag {name}" if name in BLOCKS or name in INLINE or name in OUT else "tag other"


#: Weights where no labelled page tells, and the least and most a word gains and a tag costs.
WORD, TAG = 1.0, -1.0
LEAST_WORD, LEAST_TAG, MOST = 0.05, -0.05, 6.0


def learn_weights(pages: DataFrame, html: str = "html") -> dict[str, float]:
    """Log odds of each feature to be part of the article, from all pages
    whose markup names it.  Words keep a positive and tags a negative sign.
    The features are fixed names of HTML, so a few hundred counts at most
    come back."""
    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for page in (Page(p) for some in slices(batch.column(0)) for p in some):
                if page.labelled:
                    for kind, n, inside in page.features():
                        seen[kind, inside] += n
        rows = [(k, inside, n) for (k, inside), n in sorted(seen.items())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.bool_()),
             pa.array([r[2] for r in rows], pa.int64())], ["kind", "inside", "n"])
    counts = (pages.select(F.col(html).cast("string")).mapInArrow(count, "kind string, inside boolean, n long")
              .groupBy("kind").agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"),
                                   F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("outside")))
    return {r["kind"]: weight(r["kind"], r["inside"], r["outside"]) for r in counts.collect()}


def weight(kind: str, inside: int, outside: int) -> float:
    """Log odds of a feature, with the sign and the bounds of its kind."""
    w = math.log((inside + 0.5) / (outside + 0.5))
    if kind.startswith("tag"):
        return max(min(w, LEAST_TAG), -MOST)
    return min(max(w, LEAST_WORD), MOST)


def main_text(html: Column, weights: dict[str, float]) -> Column:
    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([Page(p).text(weights) for some in slices(pages) for p in some], pa.string())
    return extract(html.cast("string"))


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                      weights: dict[str, float] | None = None) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``url``, ``text``, ``n_chars``.

    Character references are decoded, white space inside a block becomes one
    space, blocks are trimmed and joined by one line end.  An article is
    never left out for its own class, id or role, nor for those of wrappers
    if all articles of the page are in such.  A null or empty page and one
    without words have the empty text; of equally good runs the first and
    shortest counts; very long pages are read whole, in linear time.  Null or
    repeated ids keep their rows; an empty table gives none.  Other columns
    are not looked at.  Without ``weights`` they are learned from ``pages``.
    """
    weights = learn_weights(pages, html) if weights is None else weights
    return (pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"),
                         main_text(F.col(html), weights).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
