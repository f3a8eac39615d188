"""Templates by host against a plain version, and pages whose names mislead."""

import random
from collections import Counter

import pytest

from dqspark.llm import html as H

SCHEMA = "page_id long, url string, html string"


def extracted(spark, rows):
    return {r["page_id"]: r["text"] for r in H.extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()}


@pytest.mark.parametrize(
    "page, text",
    [
        ('<div class="has-sidebar"><article><p>One</p></article><div class="sidebar">x</div></div>', "One"),
        ('<div class="post-content no-comments"><article><p>One</p></article></div>', "One"),
        ('<div class="sidebar-right"><main><p>One</p></main></div>', "One"),  # holds all that is the article
        ('<form id="page"><article><p>One</p></article><form class="search">x</form></form>', "One"),
        ('<article><section id="related-work"><p>Two</p></section></article>', "Two"),
        ('<article><h2 id="social-policy">Three</h2><h2 class="menu">Four</h2></article>', "Three\nFour"),
        ('<article><p>Teaser</p></article><p>Body</p><p>More</p>', "Teaser\nBody\nMore"),
        ('<article><p>One</p></article><aside><article>Other</article></aside>', "One"),
        ('<article><p>One</p></article><div class="related"><article>Other</article></div>', "One"),
        ('<article><p>One</p><div class="share-links">Share</div><ul class="commentlist"><li>First!</ul></article>', "One"),
        ('<article><header><h1>Head</h1></header><p>One</p></article><header>Site</header>', "Head\nOne"),
        ('<div role="navigation">x</div><div hidden>y</div><p style="display: none">z<p>One &amp;  two<br>three', "One & two three"),
        ('<div id="cookie-notice">c</div><div class="adverts">a</div><div class="address">Here</div>', "Here"),
        ("text < 3 <b>bold</b></i> end</div>next<!-- open", "text < 3 bold end\nnext"),
        ("", ""),
    ],
)
def test_pages_alone(page, text):
    assert H.main_text(page, set(), set()) == text


def site(i, around="div", link="Home"):
    return (
        f"<html><body><div class='top'><ul><li><a href=/>{link} {i % 2}</a><li><a href=/x>Docs {i}</a></ul></div>"
        f"<p>Site of all things</p><{around} class='story'><p>Text number {i}</p><p>and more {i * i}</p></{around}>"
        + "".join(f"<div class='box'><i>{i} {j}</i><span>Read on</span></div>" for j in range(i % 3 + 1))
        + "<p>All rights kept</p></body></html>"
    )


def test_templates_of_hosts(spark):
    rows = [(i, "http://a.example/x", site(i)) for i in range(1, 9)]
    rows += [(20, "http://a.example/", None), (21, "http://a.example/", ""), (22, "http://a.example/", site(9)[:40])]
    rows += [(30 + i, "http://A.example/copy", site(5)) for i in range(20)]
    rows += [(60 + i, "http://b.example/", site(1 + i % 2)) for i in range(9)]  # two different pages have no template
    rows += [(80, None, site(1)), (81, "no address", site(2))]
    rows += [(90 + i, "http://c.example/", site(i, "article")) for i in range(5)]
    got = extracted(spark, rows)

    def boxes(i):
        return "".join(f"\n{i} {j}Read on" for j in range(i % 3 + 1))

    for i in range(1, 9):
        # The frame's texts and the menu without a name go. A box is one block, which differs from page to page.
        assert got[i] == f"Text number {i}\nand more {i * i}" + boxes(i)
    assert got[20] == got[21] == got[22] == "" and {got[30 + i] for i in range(20)} == {got[5]}
    assert "Site of all things" in got[60] and "Home" in got[60] and got[80] == got[60]
    for i in range(5):
        # Three boxes are longer than the element that says it is the article.
        assert got[90 + i] == f"Text number {i}\nand more {i * i}" + (boxes(i) if i % 3 == 2 else "")


def test_repeated_labels_are_nested_in_the_frame(spark):
    def page(i):
        items = "".join(f"<div class='item'><p>{i} and {j}</p><b>x{i}-{j}</b><div class='more'>Read on</div></div>" for j in range(i))
        return f"<body><div class='story'>{items}</div></body>"

    got = extracted(spark, [(i, "http://h.example/", page(i)) for i in range(1, 8)])
    for i in range(1, 8):
        assert got[i] == "\n".join(f"{i} and {j}\nx{i}-{j}" for j in range(i))


def plain_templates(sources):
    """Texts and menus of one host by whole occurrence vectors."""
    pages = sorted({s for s in sources if s and "<" in s})
    vectors, chars, most = {}, Counter(), Counter()
    for at, source in enumerate(pages):
        for token, n, c, linked, around in H.counted(H.parsed(source)):
            vectors.setdefault((token, around), {})[at] = n
            chars[token] += c
            chars["linked", token] += linked
            most[token] = max(most[token], n)
    valid = {k: v for k, v in vectors.items() if len(v) >= max(H.LEAST_SUPPORT, H.SHARE * len(pages))}
    elements = {token: v for (token, around), v in valid.items() if around is None}
    texts = set()
    for (token, around), vector in valid.items():
        if around is not None:
            frames = [v for e, v in elements.items() if most[e] == 1] if most[token] == 1 else [elements.get(around)]
            if vector in frames:
                texts.add(token)
    menus = {e for e in elements if most[e] == 1 and chars[e] and chars["linked", e] >= H.MENU_SHARE * chars[e]}
    return texts, menus


def test_templates_against_a_plain_version(spark):
    rng = random.Random(5)
    tags = ["div", "p", "section", "ul", "article", "nav", "a", "span", "div", "a"]

    def tree(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice(["shared text", "other shared", f"own {rng.random():.3f}", ""])
        name = rng.choice(tags)
        mark = rng.choice(["", " class=c", " class='menu'", " class='wide c'"])
        return f"<{name}{mark}>" + "".join(tree(depth - 1) for _ in range(rng.randint(1, 3))) + f"</{name}>"

    rows = []
    for host in range(24):
        frame = [tree(2) for _ in range(3)]
        for _ in range(rng.randint(1, 12)):
            page = frame[0] + tree(3) + frame[1] + "".join(frame[2] for _ in range(rng.randint(0, 2)))
            rows += [(0, f"https://h{host}.example/", page[: rng.choice([len(page), 10_000, 10_000, 30])])] * rng.randint(1, 2)
    rows = [(i, url, page) for i, (_, url, page) in enumerate(rows)]
    got = extracted(spark, rows)
    used = 0
    for host in range(24):
        mine = [r for r in rows if r[1] == f"https://h{host}.example/"]
        texts, menus = plain_templates([page for _, _, page in mine])
        used += bool(texts) + bool(menus)
        for i, _, page in mine:
            assert got[i] == H.main_text(page, texts, menus)
    assert used > 5
