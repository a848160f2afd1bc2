"""Main text of pages: hand-made pages of many forms, and what the parser must survive."""

import time

import pytest
from hourvault.llm.html_text import content_lines, main_text, names_in, page_texts
import numpy as np

PROSE = "One sentence of the article follows another, and all of them are long enough to count as text. "


@pytest.mark.parametrize("page, text", [
    ("", ""),
    ("just text &amp; more", "just text & more"),
    ("<html><head><title>T</title></head><body></body></html>", ""),
    (f"<nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{PROSE}<p>Short.</article><footer>&copy; x</footer>",
     f"Title\n{PROSE.strip()}\nShort."),
    # No article element: the region with most text, with the heading beside it.
    (f'<body><div class="top"><a href=/>Home</a></div><div><h1>Title</h1><div class="text"><p>{PROSE}</p><p>End.</p></div></div>'
     f'<div class="sidebar"><p>{PROSE}</p></div></body>', f"Title\n{PROSE.strip()}\nEnd."),
    # A menu without any name is left out by its links.
    (f"<body><p>{PROSE}</p><ul><li><a href=a>one</a><li><a href=b>two</a></ul><p>{PROSE}</p></body>", f"{PROSE.strip()}\n{PROSE.strip()}"),
    # A list in the article stays, and so do its links.
    (f"<article><p>{PROSE}</p><ul><li><a href=a>one</a><li><a href=b>two</a></ul></article>", f"{PROSE.strip()}\none\ntwo"),
    # Notices, adverts, forms, scripts, styles, comments and sidebars inside an article.
    (f'<article><p>{PROSE}</p><div class="cookie-notice">c</div><div id="ad_2">buy</div><form><p>mail</p></form><script>x("</p>")</script>'
     f'<style>p{{}}</style><aside>a</aside><section class="comments"><article><p>{PROSE}</p></article></section><!-- <p>no</p> --></article>',
     PROSE.strip()),
    # A page's header goes, an article's header holds its title.
    (f"<header><h1>Site</h1></header><main><header><h1>Title</h1></header><p>{PROSE}</p></main>", f"Title\n{PROSE.strip()}"),
    # Class names that tell of something else, and a main element in a box with a telling name.
    (f'<body class="sidebar"><div class="has-sidebar no-ads"><p>{PROSE}</p></div></body>', PROSE.strip()),
    (f'<div class="banner"><main><p>{PROSE}</p></main></div>', PROSE.strip()),
    # White space of all kinds; inline elements don't part words, cells do, and breaks do.
    ("<article><p> a\n\t b&nbsp;&#32;c<br>d<b>e</b></p><table><tr><td>x<td>y<tr><td>z</table></article>", "a b c de\nx y\nz"),
    # Crossed, unclosed and stray tags; markup cut off by the page's end.
    (f"<article><p><b>{PROSE}<p>two</b></i></span><p>three</article></div></div>", f"{PROSE.strip()}\ntwo\nthree"),
    ("<article><p>x &amp; y</p><p>cut <a hre", "x & y\ncut"),
    ("<article>a<!-- never closed <p>b</p>", "a"),
    ("<article>a<![CDATA[b]]>c &lt;p&gt; &amp;quot; &#x41;</article>", "ac <p> &quot; A"),
])
def test_pages(page, text):
    assert main_text(page) == text


def test_long_and_hostile_pages_take_linear_time():
    began = time.time()
    assert len(main_text("<article><p>" + "word " * 1_000_000)) == 4_999_999
    for mark in ("<div>", "<b>", "<!--", "<a ", "</", "<![x", "<?", "&", "<p><i></b>", "<li>", "<td>", "<"):
        main_text(mark * 30_000)
    assert time.time() - began < 60


def test_ratios_are_smoothed_and_cut_at_their_deviation():
    size, tags = np.array([4, 5, 400, 20, 380, 3, 4]), np.array([4, 4, 2, 2, 2, 4, 4])
    found = content_lines(size, tags)
    assert found.tolist() == [False, False, True, True, True, False, False] or found[2:5].all() and not found[[0, 6]].any()
    assert names_in("sideBar no-ads Cookie_banner") == {"side", "bar", "cookie", "banner"}


def test_rows(spark):
    rows = [(1, None, "<p>a</p>", "z"), (1, None, "<p>a</p>", "z"), (None, "u", None, None), (2, "v", "", "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = sorted(map(tuple, page_texts(pages).collect()), key=str)
    assert found == sorted([(1, None, "a", 1), (1, None, "a", 1), (None, "u", "", 0), (2, "v", "", 0)], key=str)
    assert page_texts(pages.limit(0)).collect() == []
