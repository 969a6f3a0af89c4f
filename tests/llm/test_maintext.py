import pytest
import itertools
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from pitlane.llm import maintext as M

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:1}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1><p>Welcome to the site of sites.</p></header>
<nav><ul><li><a href="/a">Home</a></li><li><a href=/b>About us</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies. They are good cookies, the best of all cookies.</p></div>
<!-- ad 1 --><div class="ad">Buy now.</div>
<article><header><h1>The title</h1></header><p>First  paragraph &amp; more,\n with text.<p><b>Second &copy one.<br>Goes on</b></p>
<p>Ok.</p><form><label>Mail</label><input><button>Send</button></form>
<div class="comments"><p>I liked this article very much indeed, thanks.</p></div><p>Last one.</p></article>
<aside><p>Related stories that you may like to read.</p></aside><footer>&copy; 2020 &middot; All rights.</footer></body></html>"""


def test_article_without_the_rest():
    assert M.extract(PAGE) == "The title\nFirst paragraph & more, with text.\nSecond © one. Goes on\nOk.\nLast one."


def test_page_without_semantic_elements():
    long = "A sentence that goes on for quite some words, as prose does, and then it ends. " * 4
    links = "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(8))
    page = f"<body><ul>{links}</ul><div><p>{long}</p><p>Yes.</p><p>{long}</p></div><ul>{links}</ul></body>"
    assert M.extract(page) == f"{long.strip()}\nYes.\n{long.strip()}"


def test_cues_in_attributes():
    text = "<p>Words of the article, some of them.</p>"
    for side in ('<div hidden>', '<div style="display: none">', '<div aria-hidden="true">', "<div class='page-sidebar'>",
                 '<section id="reader-comments">', '<div role=navigation>', '<div class="masthead">', "<aside>"):
        assert M.extract(f"{side}<p>Other words that do not belong, though there are many.</p></div></section></aside>"
                         f"<div class='post-content'>{text}</div>") == "Words of the article, some of them."
    for main in ('<article data-class="sidebar">', '<div class="entry"><div class="header">', '<main aria-hidden="false">',
                 '<article><a href="/hidden/menu.html" title="nav">'):
        assert M.extract(f"<nav><p>Menu</p></nav>{main}{text}") == "Words of the article, some of them."


def test_awkward_pages():
    for page in ("", "   ", "<", "<p", "<a href='x", "<!-- never closed <p>x</p>", "<script>x", "&", "</p></div>", "<p></p>" * 50):
        M.extract(page)
    assert M.extract("<article><p>a  b &lt;c&gt;</p>") == "a b <c>"
    deep = "<div>" * 3000 + "<article><p>Deep text of some words.</p>"
    assert M.extract(deep) == "Deep text of some words."
    nested = "<article>" + "<div>Some words here, at this depth." * 5000
    assert M.extract(nested).count("\n") == 4999
    many = "<article>" + "<p>One paragraph of text.</p>" * 5000
    assert M.extract(many).count("\n") == 4999


def plain_cut(source, sink, edges):
    best = None
    for side in itertools.product([False, True], repeat=len(source)):
        cost = sum(sink[i] if s else source[i] for i, s in enumerate(side)) + sum(c for a, b, c in edges if side[a] != side[b])
        best = min(best, cost) if best is not None else cost
    return best


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**9))
def test_min_cut_is_minimal(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 8)
    source, sink = ([rng.randint(0, 12) for _ in range(n)] for _ in range(2))
    edges = [(a, b, rng.randint(0, 8)) for a in range(n) for b in range(a) if rng.random() < 0.5]
    side = M.min_cut(source, sink, edges)
    cost = sum(sink[i] if s else source[i] for i, s in enumerate(side)) + sum(c for a, b, c in edges if side[a] != side[b])
    assert cost == plain_cut(source, sink, edges)


def test_smoothness_pulls_a_doubtful_block():
    tree = M.Tree([0, 0, 1, 1, 1], [0, 1, 2, 2, 2])
    text = "A long and certain sentence of the article, with words."
    first, doubt, last = (M.Block(text, 2, False, True, False, "p", 0), M.Block("maybe", 3, False, False, False, "span", 0),
                          M.Block(text, 4, False, True, False, "p", 0))
    assert M.min_cut(*M.page_graph([doubt], tree)) == [False]
    assert M.min_cut(*M.page_graph([first, doubt, last], tree, smooth=2.0)) == [True, True, True]


def test_nearness_is_the_common_share_of_the_path():
    tree = M.Tree([0, 0, 1, 2, 1], [0, 1, 2, 3, 2])
    assert tree.nearness(3, 3) == 1 and tree.nearness(3, 4) == 2 / 4 and tree.nearness(0, 3) == 1 / 4


def test_frame(spark):
    rows = [(1, "u", PAGE, "c"), (2, None, None, "c"), (None, "u", "", "c"), (1, "u", PAGE, "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string")
    got = M.with_main_text(df, name="main").collect()
    assert [len(r.main) > 0 for r in got] == [True, False, False, True]
    assert M.with_main_text(df.limit(0), name="main").count() == 0


def test_states_and_wrappers_do_not_make_a_page_boilerplate():
    text = "Words of the article, some of them, and then some more of them as prose has."
    article = f"<article><p>{text}</p></article>"
    for page in (f"<body class='single has-sidebar'>{article}", f"<html class='has-navbar-fixed-top'><body class='social'>{article}",
                 f"<div id='content' class='no-comments'><p>{text}</p></div>", f"<form id='aspnet'><div><p>{text}</p></div></form>",
                 f"<form><nav><p>Menu</p></nav>{article}</form>", f"<div class='sidebar'><p>Aside.</p>{article}</div>",
                 f"<article class='post tags-news share'><p>{text}</p></article>",
                 f"<article><section id='discussion'><p>{text}</p></section></article>"):
        assert M.extract(page) == text or page.startswith("<div class='sidebar'>") and text in M.extract(page), page
    assert M.extract(f"<article><h2 id='related-work'>Related work</h2><p>{text}</p></article>") == f"Related work\n{text}"
    comment = "<div id='comments'><article class='comment'><p>I liked it, thanks.</p></article></div>"
    assert M.extract(f"<main><p>{text}</p>{comment}</main>") == text


def test_dropped_elements_end_where_they_end():
    for page in ('<p>one</p><svg class="i"/><p>two</p><p>three</p>', "<p>one</p><math/><p>two</p><p>three</p>",
                 "<p>one</p><svg><path d='M0'/><text>x</text><p>two</p><p>three</p>", "<p>one<svg><text>x</p><p>two</p><p>three</p>",
                 "<p>one</p><select><option>x<p>two</p><p>three</p>", "<p>one</p><object data='x'><p>two</p><p>three</p>",
                 "<p>one</p><iframe src='x'><p>two</p><p>three</p>", "<p>one</p><iframe><p>x</p></iframe><p>two</p><p>three</p>",
                 "<p>one<select><optgroup><option>x<option>y</select></p><p>two</p><div><svg><g><title>x</title>y</div><p>three</p>",
                 "<p>one</p><svg><foreignObject><p>x</p></foreignObject>y</svg><p>two</p><p>three</p>"):
        assert M.extract(f"<article>{page}</article>") == "one\ntwo\nthree", page
    assert M.extract("<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>") == "So x=2 holds."
    assert M.extract("<article><object data='x'><p>The fallback.</p></object></article>") == "The fallback."


SENTENCE = "This is a sentence of the story, and it goes on for a while. " * 3
REMARK = "I am a reader and this is what I have to say about all of it. " * 3


@pytest.mark.parametrize("page,want", [
    (f"<article><p>{SENTENCE}</p></article><ol class='comment-list'>{f'<li><p>{REMARK}</p>' * 3}</ol>", [SENTENCE]),
    (f"<p>{SENTENCE}</p><ol class='comment-list'>{f'<li><p>{REMARK}</p>' * 3}</ol>", [SENTENCE]),
    (f"<div class='post'><p>A short post, that is all.</p></div><div class='comments'>{f'<p>{REMARK}</p>' * 12}</div>", ["A short post, that is all."]),
    (f"<main><p>{SENTENCE}</p></main><div class=comments><article><p>{REMARK}</p></article></div>", [SENTENCE]),
    (f"<div role='dialog'>We use cookies. {REMARK}</div><article><p>{SENTENCE}</p></article>", [SENTENCE]),
    (f"<div class=sidebar-layout><article><p>{SENTENCE}</p></article></div>", [SENTENCE]),
    (f"<div class='comments'><p>{SENTENCE}</p></div>", [SENTENCE]),  # nothing else is there
    ("<article><p>One <button>Buy now</button> two <label>Name</label> three is here.</p></article>", ["One two three is here."]),
    ("<article><p>One <span hidden>no</span> two <span style='display: none'>no</span> <span class='ad'>no</span>is here.</p></article>",
     ["One two is here."]),
    (f"<article><p>{SENTENCE}</p><button>Subscribe</button><p>{SENTENCE}</p></article>", [SENTENCE, SENTENCE])])
def test_containers_that_no_share_excuses_and_inline_elements(page, want):
    assert M.extract(f"<html><body>{page}</body></html>") == "\n".join(w.strip() for w in want)


def test_a_taken_column_name_is_refused(spark):
    with pytest.raises(ValueError, match="already"):
        M.with_main_text(spark.createDataFrame([("<p>x</p>", "y")], "html string, Text string"))
