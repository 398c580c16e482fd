import html
import re

import pytest

from quern.llm import main_text, queries
from quern.sources.tables import table

LONG = "word " * 40


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("<p>", ""),
        ("plain text only", "plain text only"),
        ("<title>t</title><p>q &lt;b&gt;</p><!-- <p>no</p> -->", "q <b>"),
        ("<article>&nbsp;A&eacute;&#x41;<p>b<br>c <i>d</i></p><div class='ad'>no<div>x</div></div><p>e</article><article class=comment>x</article>", "AéA\n\nb c d\n\ne"),
        ("<nav>menu</nav><main><header><h1>T</h1></header><p>a</p><section id='comments'><p>reader</p></section><p>b</p></main><footer>f</footer>", "T\n\na\n\nb"),
        (f"<div><a href=x>Home</a></div><div><h2>Title</h2><p>{LONG}</p><p>Short.</p></div><div class=footer>x</div><p>tail</p>", f"Title\n\n{LONG.strip()}\n\nShort."),
        ("<article><p>a<div class='ad'>never closed<p>x</article><p>y", "a"),
        ("<script>if(a<b){'</p>'}", ""),
    ],
)
def test_pages(page, text):
    assert main_text.main_text(page) == text


LINKS = "".join(f"<li><a href={k}>a link with some words {k}</a></li>" for k in range(4))


@pytest.mark.parametrize(
    "page,text",
    [
        (f"<article><h1>T</h1><p>by N</p><p>May</p><p>here</p><p>{LONG}</p><p>End.</p><ul>{LINKS}</ul><div>Buy now!</div></article>", f"T\n\nby N\n\nMay\n\nhere\n\n{LONG.strip()}\n\nEnd."),
        (f"<main><p>Notice.</p><ul>{LINKS}</ul><h1>T</h1><p>{LONG}</p><ul>{LINKS}</ul><p>{LONG}</p><p>z</p></main>", f"T\n\n{LONG.strip()}\n\n{LONG.strip()}\n\nz"),
        (f"<article><h1><a href=x>T</a></h1><p>{LONG}</p></article>", f"T\n\n{LONG.strip()}"),
        (f"<article><ul>{LINKS}</ul></article>", "\n\n".join(f"a link with some words {k}" for k in range(4))),
    ],
)
def test_sums_decide_inside_a_marked_part(page, text):
    assert main_text.main_text(page) == text


TEXT = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p>"
SAID = f"Title\n\n{LONG.strip()}\n\nShort."


@pytest.mark.parametrize(
    "page,text",
    [
        (f"<div class='layout has-sidebar'><div class=sidebar>x</div><article>{TEXT}</article></div><div class=footer>f</div>", SAID),
        (f"<div id='page' class='with-nav'><nav>n</nav><main>{TEXT}</main></div>", SAID),
        (f"<body><form action=x><article>{TEXT}</article><select><option>o</select></form></body>", SAID),
        (f"<form action=x><div>{TEXT}</div></form>", SAID),
        (f"<div class='no-comments'><form><div class='with-nav'>{TEXT}</div></form></div>", SAID),
        (f"<main><div class='with-nav'>{TEXT}</div></main>", SAID),
        (f"<div class=ad><article>Buy</article></div><div>{TEXT}</div>", SAID),
        (f"<main>{TEXT}</main><div class=related><article><p>Other</p><p>words</p></article></div>", SAID),
        (f"<main>{TEXT}<div class=comments>{'<p>so long a comment of a reader</p>' * 20}</div></main>", SAID),
        (f"<main>{TEXT}<section class=comments><article class=comment>r</article></section><p>End.</p></main>", SAID + "\n\nEnd."),
    ],
)
def test_wrappers_named_like_other_parts(page, text):
    assert main_text.main_text(page) == text


def test_articles_of_the_table(spark, sf_dir):
    for r in queries.QUERIES["op4_main_text"](spark, sf_dir).join(table(spark, sf_dir, "pages").drop("url"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        blocks = re.split(r"<[^>]*>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
        assert r.text == "\n\n".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)
        assert r.n_chars == len(r.text)


def test_odd_rows(spark):
    rows = [(1, None, None, "x"), (1, "u", "", "x"), (None, "u", "<p>a</p>" * 50_000, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_text.extract(pages).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, 3 * 50_000 - 2]
    assert main_text.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page,text",
    [
        (f"""<article><p class="a"">{LONG}</p><p>second {LONG}</p></article>""", f"{LONG.strip()}\n\nsecond {LONG.strip()}"),
        (f"""<article><p data-x=don't>{LONG}</p><p>It's the second</p><p>'third'</p></article>""", f"{LONG.strip()}\n\nIt's the second\n\n'third'"),
        (f"""<article><p title='a>b' id = "x>" 'y' z=a="b>{LONG}</p><img alt="1 > 0"/>e</article>""", f"{LONG.strip()}\n\ne"),
        (f"""<article><p =\"x" a= b c = 'c>' >{LONG}</p><br/></article>""", LONG.strip()),
        (f"""<article>{LONG}<p title="never closed>{LONG}</p></article>""", LONG.strip()),
    ],
)
def test_quotes_open_only_after_an_equals_sign(page, text):
    assert main_text.main_text(page) == text


def test_long_tags_take_linear_time():
    for page in ("<p " + "a=" * 300_000, "<p " + "a " * 300_000 + ">x", "<p " + "='" * 300_000, "<p a" + " " * 300_000, '<p a="' * 50_000):
        main_text.main_text(page)
