from __future__ import annotations

import random

import pytest

from orderloom.llm.main_text import extract_main_text, main_text, path_ratios, read_blocks

LONG = "This is a sentence of the article, with some words in it. Here is another one, too."

CASES = {
    "plain": (f"<article><h1>Title</h1><p>{LONG}</p><p>Short.</p></article>", f"Title\n\n{LONG}\n\nShort."),
    "chrome": (
        f"<header><h2>Site, the best.</h2></header><nav><ul><li><a href=x>Home</a></ul></nav><main><p>{LONG}</main>"
        f"<aside><p>{LONG}</p></aside><footer>{LONG}</footer>",
        LONG,
    ),
    "divs": (
        f'<body class="no-sidebar"><div class="top-menu">Home, about.</div><div id="content"><h1>Title</h1><p>{LONG}</p>'
        f'<p>{LONG}</p></div><div class="sidebar"><p>{LONG}</p></div><div class="cookie-notice">{LONG}</div>'
        f'<div id="comments"><p>{LONG}</p></div><div class="ad">{LONG}</div></body>',
        f"Title\n\n{LONG}\n\n{LONG}",
    ),
    "links": (
        f"<div><a href=1>One</a> <a href=2>Two</a></div><div><p>{LONG}<p>{LONG}</div>"
        "<div><ul><li>a<li>b<li>c</ul></div>",
        f"{LONG}\n\n{LONG}",
    ),
    "references": (f"<article><p>a &amp; b &lt;i&gt; &copy &amp;copy; &#233; {LONG}</p></article>", f"a & b <i> © &copy; é {LONG}"),
    "space": (f"<article><p>  a\n\tb<br>c <b>d</b>e\n{LONG} </p></article>", f"a b c de {LONG}"),
    "article header": (f"<article><header><h1>Title</h1></header><p>{LONG}</p></article>", LONG),
    "form": (f"<article><p>{LONG}</p><form><p>{LONG}</p></form></article>", LONG),
    "script": (f'<article><script>var a="</p><p>x.";</script><style>p{{}}</style><p>{LONG}</article>', LONG),
    "comment": (f"<article><!-- <p>no</p> --><p>{LONG}<!-- open </p></article>", LONG),
    "cut off": (f"<article><p>{LONG}</p><p>End of &am", f"{LONG}\n\nEnd of &am"),
    "cut tag": (f'<article><p>{LONG}</p><p>End <a href="x', f"{LONG}\n\nEnd"),
    "less than": (f"<article><p>1 < 2, {LONG}</p></article>", f"1 < 2, {LONG}"),
    "quoted": (f'<article title="a > b"><p class=\'x>\'>{LONG}</p></article>', LONG),
    "upper case": (f"<ARTICLE><P>{LONG}</P></ARTICLE><FOOTER>{LONG}</FOOTER>", LONG),
    "hidden": (f'<article><p>{LONG}</p><p hidden>{LONG}</p><p style="display: none">{LONG}</p></article>', LONG),
    "lists": (f"<article><p>{LONG}</p><ul><li>one<li>two</ul><blockquote>three</blockquote></article>", f"{LONG}\n\none\n\ntwo\n\nthree"),
    "no markup": (LONG, LONG),
    "only chrome": (f"<nav>{LONG}</nav>", ""),
    "empty": ("", ""),
    "null": (None, ""),
    "blank": ("<p> \n </p>", ""),
    "unmatched": (f"</div></p><article></b><p>{LONG}</article></article>", LONG),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    page, want = CASES[name]
    if name == "article header":  # a heading in the article's own header belongs to it
        want = f"Title\n\n{LONG}"
    assert main_text(page) == want


def test_ratios_by_hand():
    blocks = read_blocks("<div><h1>abcd</h1><p>aa, bb.</p><p>cccc.</p></div>")
    assert [b.text for b in blocks] == ["abcd", "aa, bb.", "cccc."]
    fused, path = path_ratios(blocks)
    assert path.tolist() in ([0, 1, 1], [1, 0, 0])
    from math import exp

    w = [exp(-0.5 * d * d) for d in range(3)]
    chars, marks = [4, 6, 6], [0, 1.5, 1.5]

    def smooth(v, i):
        return sum(w[abs(i - j)] * v[j] for j in range(3)) / sum(w[abs(i - j)] for j in range(3))

    for i in range(3):
        assert fused[i] == pytest.approx(smooth(chars, i) * smooth(marks, i))


def test_random_pages_against_their_plan():
    rng = random.Random(1)

    def sentence():
        return " ".join(rng.choice("alpha beta gamma delta omega".split()) for _ in range(rng.randint(3, 15))) + "."

    for _ in range(200):
        want, body = [], ""
        for kind in rng.choices(["p", "h2", "li", "open"], k=rng.randint(1, 12)):
            text = sentence() if kind != "h2" else sentence()[:20].strip(" .")
            want.append(text)
            body += {"p": f"<p>{text}</p>", "h2": f"<h2>{text}</h2>", "li": f"<ul><li>{text}</ul>", "open": f"<p><b>{text}<br>"}[kind]
        page = (
            f"<html><head><title>{sentence()}</title></head><body><nav><ul><li><a href=x>{sentence()}</a></ul></nav>"
            f'<div class="ad">{sentence()}</div><article><p>{LONG}{body}</article><footer>{sentence()}</footer></body></html>'
        )
        assert main_text(page) == "\n\n".join([LONG, *want])


@pytest.mark.parametrize(
    "page",
    ["<div>" * 200_000 + LONG, "<p>" * 200_000, "<" * 300_000, "</a" * 100_000, "&amp;" * 200_000,
     "<a href='" * 100_000, "<!--" * 100_000, "<div></span>" * 100_000, "<script>" * 100_000,
     f"<article><p>{LONG * 30_000}</p></article>", '<p class="' + "a " * 500_000 + f'">{LONG}</p>'],
    ids=range(11),
)
def test_odd_pages_stay_linear(page):
    import time

    began = time.time()
    main_text(page)
    assert time.time() - began < 20


def test_table(spark):
    rows = [(1, "u", CASES["plain"][0], "x", 5), (1, "u", CASES["plain"][0], "x", 5), (2, None, None, None, None),
            (None, "v", "", "y", 1), (3, "w", f"<article><p>{LONG * 20_000}</p></article>", "z", 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    found = extract_main_text(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    plain = CASES["plain"][1]
    want = [(1, "u", plain, len(plain)), (1, "u", plain, len(plain)), (2, None, "", 0), (None, "v", "", 0),
            (3, "w", LONG * 20_000, len(LONG) * 20_000)]
    assert got == sorted(want, key=repr)
    assert extract_main_text(pages.limit(0)).collect() == []


def test_given_pages(spark):
    """Every page of the given tables, against the blocks of its article element."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    texts = {r.page_id: r.text for r in extract_main_text(pages).collect()}
    for row in pages.collect():
        inner = re.sub("<[^>]*$", "", row.html.split("<article>", 1)[1].split("</article>")[0])
        blocks = [
            " ".join(html.unescape(re.sub("<[^>]*>", " ", part)).split())
            for part in re.split("</?(?:p|h1)>", inner)
        ]
        assert texts[row.page_id] == "\n\n".join(b for b in blocks if b)
