import html as entities
import re

from llm_helpers import prose

from lociweave.llm import html_text
from lociweave.llm.tables import read

FOLDER = "/root/testdata/sf0.001"
OUT = "script style template noscript nav aside footer form button select iframe".split()
BLOCKS = "p div h1 h2 h3 h4 h5 h6 ul ol li table tr td th section article blockquote pre figure figcaption dl dt dd header hr main"
NAMED = re.compile(r"""<(div|section|ul|p)\b[^>]*\b(?:class|id)=["']?(?:ad|ads|comments?|sidebar|cookie|share|related|newsletter|promo|notice|banner|menu)\b""")


def without(text, tag):
    """`text` without its elements of this name, nested ones included."""
    while found := re.search(rf"<{tag}\b", text):
        depth, at = 0, found.start()
        for m in re.finditer(rf"<(/?){tag}\b[^>]*>", text[at:]):
            depth += -1 if m[1] else 1
            if not depth:
                text = text[:at] + "\n<p>" + text[at + m.end() :]
                break
        else:
            text = text[:at]
    return text


def brute_force(page):
    """The article's source without what is left out, cut at block tags; no parser, no ratios."""
    page = re.sub(r"<!--.*?-->", "", page, flags=re.S)
    for tag in OUT:
        page = without(page, tag)
    article = re.search(r"<article\b[^>]*>(.*?)(</article>|$)", page, flags=re.S)
    if not article:
        return None
    text = article[1]
    while named := NAMED.search(text):
        tag = named[1]
        text = text[: named.start()] + first_removed(text[named.start() :], tag)
    text = re.sub(r"<br\s*/?>", " ", text)
    blocks = re.split(rf"</?(?:{'|'.join(BLOCKS.split())})\b[^>]*>", text)
    blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def first_removed(text, tag):
    depth = 0
    for m in re.finditer(rf"<(/?){tag}\b[^>]*>", text):
        depth += -1 if m[1] else 1
        if not depth:
            return "<p>" + text[m.end() :]
    return ""


def test_pages_equal_brute_force(spark):
    pages = {r.page_id: r.html for r in read(spark, FOLDER, "pages").collect()}
    got = {r.page_id: r.text for r in html_text.extract(read(spark, FOLDER, "pages")).collect()}
    want = {i: brute_force(x) for i, x in pages.items()}
    assert all(w is not None for w in want.values())
    assert {i: x for i, x in got.items() if x != want[i]} == {}


LONG, LONGER = " ".join(prose(1, 30).split()), " ".join(prose(2, 90).split())


def test_two_regions_of_prose():
    page = f"<body><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul><div><p>{LONG}</p></div><div><p>{LONGER}</p></div></body>"
    assert html_text.main_text(page) == f"{LONG}\n\n{LONGER}"


def test_short_region_beside_prose():
    menu = "".join(f"<li><a href={i}>Menu entry {i}</a></li>" for i in range(8))
    page = f"<body><div><ul>{menu}</ul></div><div id=page><div><p>{LONG}</p><p>{LONGER}</p></div><div><p>Signed</p></div><div><a href=x>More</a></div></div></body>"
    assert html_text.main_text(page) == f"{LONG}\n\n{LONGER}\n\nSigned"


def test_wrappers_are_kept():
    assert html_text.main_text(f'<div class="content has-sidebar"><p>{LONG}</p></div>') == LONG
    assert html_text.main_text(f"<form action=x><div><p>{LONG}</p></div></form>") == LONG
    assert html_text.main_text(f"<form><h1>Title</h1><p>{LONG}</p></form><div><p>{LONG}</p></div>").startswith("Title")
    assert html_text.main_text(f'<div class="no-sidebar overflow-hidden"><p>{LONG}</p></div>') == LONG


def test_names_are_whole_tokens():
    inside = f'<div class="post social-science"><p>{LONG}</p></div><p class="login-required-content">{LONGER}</p>'
    out = "".join(f'<div class="{c}"><p>Something else entirely</p></div>' for c in ("social share", "post-comments", "ad-box", "sideBar widget", "related-posts-list", "js-cookie-banner"))
    assert html_text.main_text(f"<article>{inside}{out}<form><p>Write to us</p></form></article>") == f"{LONG}\n\n{LONGER}"


def test_comments_longer_than_the_article():
    comments = "".join(f'<article class="comment"><p>{LONGER}</p></article>' for _ in range(6))
    assert html_text.main_text(f'<main><article><h1>T</h1><p>{LONG}</p></article><section class="comments">{comments}</section></main>') == f"T\n\n{LONG}"


def test_clashing_columns_and_deep_elements(spark):
    deep = "<b><i>" * 5000 + LONG
    rows = [(1, "u", f"<article><p>{LONG}</p></article>", "x", 7, "h"), (2, "u", deep, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long, __html string")
    got = html_text.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert {r.page_id: (r.text, r.n_chars) for r in got.collect()} == {1: (LONG, len(LONG)), 2: (LONG, len(LONG))}
    assert html_text.extract(pages.limit(0)).count() == 0
