import os

import pytest

from lettermon.llm.html import LEAST_TAG, LEAST_WORD, Page, extract_main_text, learn_weights, weight

WEIGHTS = {"word": 3.0, "word in link": 0.05, "word in heading": 3.0, "word in item": 1.0, "tag p": -0.05, "tag h1": -0.05,
           "tag b": -0.05, "tag br": -0.05, "tag a": -1.0, "tag li": -0.05, "tag ul": -0.5, "tag div": -4.0, "tag html": -4.0}

FLAT = {k: -0.05 if k.startswith("tag") else v for k, v in WEIGHTS.items()} | {"tag table": -0.05, "tag tr": -0.05, "tag td": -0.05,
                                                                               "tag aside": -0.05, "tag h2": -0.05}


def text(markup, weights=WEIGHTS):
    return Page(markup).text(weights)


def test_article_of_a_full_page():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
      <nav><ul><li><a href="/a">Menu</a></li></ul></nav><header><p>Site header words</p></header><!-- ad <p>x</p> -->
      <div class="ad">Buy this now</div><aside><p>Side words here</p></aside>
      <article><header><h1>The &amp; title</h1></header><p>First   block\n with <b>bold</b>text.<br>After</p>
      <form><p>Your mail</p><input name=q></form><div class="cookie-notice"><p>We use cookies</p></div>
      <p>Second &lt;block&gt; &#233;&nbsp;x</p><ul><li>one item</li><li>two items</li></ul>
      <section id="comments"><div><p>Reader says hello there</p></div></section><footer>By me</footer></article>
      <div class="sidebar widget">More</div><footer>&copy; all of us</footer></body></html>"""
    assert text(page) == ("The & title\nFirst block with boldtext. After\nSecond <block> é x\none item\ntwo items")


def test_broken_markup():
    assert text(None) == text("") == text("<p>") == text("<script>never closed") == ""
    assert text("<article><p>cut off &amp") == "cut off &"
    assert text("<p>cut in a tag <a hre") == "cut in a tag"
    assert text("<p>1 < 2 and 3 > 2") == "1 < 2 and 3 > 2"
    assert text("<p class='notice'>gone<p>kept words") == "kept words"
    assert text('<p title="a > b">in</p>') == "in"
    assert text("no markup at all") == "no markup at all"
    assert text("<!-- never closed <p>x</p>") == ""
    assert len(text("<p>" + "long words " * 50_000)) == 11 * 50_000 - 1
    assert text("<" * 20_000) == "<" * 20_000


@pytest.mark.parametrize("before", [
    '<ul><li class="social">a<li>b</ul>', '<ul><li>b<li class="social">a</ul>', '<ul><li class="social"><div>a</ul>',
    '<dl><dt class="ad">a<dd>b</dl>', '<dl><dt>b<dd class="ad"><b>a</dl>', '<table><tr class="promo"><td>a<tr><td>b</table>',
    '<table><tr><td class="sidebar">a<td>b</table>', '<table><tbody><tr><td>b<td class="sidebar"><p>a</table>',
    '<div class="sidebar">a', '<div><div class="sidebar">a', '<nav><ul><li>a', '<div><nav>a</div>', '<aside><p>a',
    '<form><input><p>a', '<p class="notice">a', '<select><option>a</select>', '<div><a class="share" href=x>a</div>'])
def test_missing_end_tags_keep_the_article(before):
    weights = WEIGHTS | {"word in item": 0.0, "word in link": 0.0, "tag table": -9.0, "tag dl": -9.0, "tag ul": -9.0, "tag main": -9.0}
    for name in ("article", "main"):
        page = f"{before}<{name}><p>Text of the article</p></{name}><div>x</div>"
        assert text(page, weights) == "Text of the article", page
        assert text(f"<body class='page banner'><div id=page>{page}</div></body>", weights) == "Text of the article", page


def test_left_out_elements_end_inside_an_article():
    assert text("<article><p>one</p><ul><li class=share>a<li>two</ul><p>three</p></article>", FLAT) == "one\ntwo\nthree"
    assert text("<article><p>one</p><table><tr><td class=ad>a<td>two</table><p>three</p></article>", FLAT) == "one\ntwo\nthree"
    assert text("<article><p>one</p><aside>a</article><p>two</p>", FLAT) == "one\ntwo"
    assert text("<article><p>one</p><div class=ad>a<div>b</div>c</div><p>two</p></article>", FLAT) == "one\ntwo"


def test_articles_in_closed_left_out_elements_stay_out():
    cards = "<article><p>card</p></article>" * 2
    for box in (f"<aside>{cards}</aside>", f"<div class=related><div>{cards}</div></div>", f'<section id="comments">{cards}</section>'):
        assert text(f"<article><p>Text</p></article>{box}") == text(f"{box}<article><p>Text</p></article>") == "Text"


def test_ids_of_titles_do_not_decide_in_an_article():
    for start, end in (('<h2 id="related-work">', "</h2>"), ('<h2 id="search">', "</h2>"), ("<section id='social-context'><p>", "</section>"),
                       ("<p id=comment-on-x>", "</p>")):
        assert text(f"<article><p>one</p>{start}two{end}<p>three</p></article>") == "one\ntwo\nthree"
    assert text("<article><p>one</p><h2 class=related>two</h2><div id=related-posts>x</div><p>three</p></article>", FLAT) == "one\nthree"


def test_long_broken_pages_take_linear_time():
    for piece in ("<b>", "<div>", "<li class=ad>", "<div class=ad><article>", "</a>", "<a><table></a>"):
        assert text(piece * 30_000) == ""


def test_best_run_is_contiguous_and_maximal():
    junk = "<div>x</div>" * 5
    assert text(f"{junk}<p>the main text of it</p><p>goes on here</p>{junk}") == "the main text of it\ngoes on here"


def test_weights_have_their_signs(spark):
    pages = spark.createDataFrame([(1, "u", "<nav><a>m</a></nav><article><p>" + "w " * 50 + "</p></article><div>x</div>"),
                                   (2, None, None), (None, "u", "<div>y</div>")], "page_id long, url string, html string")
    w = learn_weights(pages)
    assert all(v <= LEAST_TAG if k.startswith("tag") else v >= LEAST_WORD for k, v in w.items())
    assert w["tag div"] < w["tag p"] and w["word"] > 1 and "word in link" not in w  # menus are taken out before
    assert weight("word", 0, 9) == LEAST_WORD and weight("tag li", 9, 0) == LEAST_TAG


def test_rows_and_empty_table(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    pages = spark.createDataFrame([(1, "u", "<p>é a</p>", "x", "x"), (1, "u", "<p>é a</p>", "x", "x"),
                                   (None, None, None, None, None)], schema)
    got = extract_main_text(pages).collect()
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in got) == [("1", "é a", 3), ("1", "é a", 3), ("None", "", 0)]
    assert extract_main_text(pages.limit(0)).collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver data not present")
def test_pages_of_the_tables(spark):
    """Every page names its article: the text is the article's, block by block."""
    import html as H
    import re

    from lettermon.llm.queries import op4_html_extraction, table

    got = {r["page_id"]: r["text"] for r in op4_html_extraction(spark, "/root/testdata/sf0.001").collect()}
    for r in table(spark, "/root/testdata/sf0.001", "pages").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
        parts = re.sub(r"<[^>]*(>|$)", " ", re.sub(r"</?(?:p|h1)>", "\x01", inner)).split("\x01")
        assert got[r["page_id"]] == "\n".join(t for t in (" ".join(H.unescape(p).split()) for p in parts) if t)


@pytest.mark.parametrize("start, end", [
    ('<article class="post has-sidebar">', "</article>"), ('<article class="post comments-open">', "</article>"),
    ('<article class="hentry social">', "</article>"), ('<article id="comments" class="sidebar" role="complementary">', "</article>"),
    ('<div class="layout-sidebar-right"><article>', "</article></div>"), ('<div class="post has-comments"><article>', "</article></div>"),
    ('<main class="no-sidebar"><div class="sidebar-layout">', "</div></main>"),
    # wrappers by whose name every article would go
    ('<div class="sidebar"><article>', "</article></div>"), ('<div id="banner"><div class="widget promo"><main>', "</main></div></div>")])
def test_layout_names_keep_the_article(start, end):
    for page in (f"{start}<p>Text of it</p>{end}", f"<nav>menu</nav>{start}<h1>Head</h1><p>Text of it</p>{end}<footer>x</footer>"):
        assert text(page, FLAT).endswith("Text of it"), page


def test_topics_and_texts_in_attributes_do_not_take_parts_out():
    parts = ['<p class="social-science">', '<h2 class="search-heading">', '<section class="product-widget"><p>',
             '<div id="search-results-explained"><p>', '<p title="the hidden truth">', "<p title='x hidden y' data-x=hidden>",
             '<p style="color:red" alt="display:none">', '<div class="has-ad footer-less"><p>']
    page = "".join(f"{p}words {i}</p></h2></section></div>" for i, p in enumerate(parts))
    assert text(f"<article>{page}</article>", FLAT | {"tag section": -0.05, "tag div": -0.05}) == "\n".join(
        f"words {i}" for i in range(len(parts)))


def test_names_that_take_parts_out():
    for p in ('<div class="ad-slot">', '<div class="x sidebar">', '<div id=site_footer>', '<ul class="social-links"><li>', "<div hidden>",
              '<div class="cookie-banner">', '<p style="display: none">', '<div aria-hidden="true">', '<div role="navigation">',
              '<div class="related-posts">', '<div class="comments-list">', "<div class='newsletter_signup'>"):
        assert text(f"<article><p>one</p>{p}gone</li></ul></div></p><p>two</p></article>", FLAT) == "one\ntwo", p


def test_elements_beyond_the_depth_are_counted():
    deep = "<div>" * 600 + "in" + "</div>" * 600
    assert text(f"<div class='sidebar'>{deep}rest of the sidebar</div><article><p>Text</p></article>") == "Text"
    assert text(f"<article><p>one</p><div class=ad>{deep}ad</div><p>two</p></article>", FLAT) == "one\ntwo"
    flat = FLAT | {"tag div": 0.0}
    assert text(f"<article>{'<div>' * 700}<p>one</p><div class=ad>gone<div>x</div></div><p>two</p>{'</div>' * 700}</article>", flat) == "one\ntwo"
    assert text(f"{'<section>' * 600}{'</section>' * 600}<div class=sidebar>gone</div><article><p>Text</p></article>") == "Text"


def test_run_against_all_runs():
    """The best run of random pages has the largest sum of all contiguous runs, and is the first and shortest of those."""
    import random

    from lettermon.llm.html import TAG, WORD

    rng = random.Random(3)
    pieces = ["<p>", "</p>", "<div>", "</div>", "<a>", "</a>", "<li>", "w ", "w w w ", "<b>x</b>", "<div class=ad>out</div>", "<br>"]
    for _ in range(300):
        markup = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        weights = {k: rng.choice([0.5, 1.0, 2.0]) * (-1 if k.startswith("tag") else 1) for k in WEIGHTS}
        page = Page(markup)
        gains = [0.0 if out else (n * weights.get(kind, WORD) if n else weights.get(kind, TAG)) for kind, n, _, _, out in page.tokens]
        runs = [(sum(gains[i:j]), -j, -i) for i in range(len(gains)) for j in range(i + 1, len(gains) + 1)]
        best = max(runs, default=(0.0, 0, 0))
        if best[0] <= 0:
            assert page.text(weights) == ""
            continue
        wanted = [(i, j) for total, j, i in ((t, -j, -i) for t, j, i in runs) if total == best[0]]
        texts = set()
        for i, j in wanted:
            inside = sorted({b for _, n, b, _, out in page.tokens[i:j] if n and not out})
            texts.add("\n".join(t for t in (" ".join("".join(page.blocks[b]).split()) for b in inside) if t))
        assert page.text(weights) in texts, markup
