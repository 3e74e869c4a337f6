from __future__ import annotations

import random

import pytest

from terrafold.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Top</header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice">We use</div><article><h1>Head &amp; line</h1><p>One <b>two</b>
 three&nbsp;&#x41;<br>four<p>Five<script>var a="</p>";</script></p><aside>Side</aside><form><p>Mail</p></form><div class="ad">Buy</div></article>
<section id=comments><article class=comment><p>I said this and that and much more than the article itself says, at length.</article></section><footer>&copy; x</footer></body></html>"""


def test_article():
    assert H.extract(PAGE) == "Head & line\nOne two three A four\nFive"


@pytest.mark.parametrize(
    ("page", "text"),
    [(None, ""), ("", ""), ("plain &lt; text", "plain < text"), ("<p>a<p>b", "a\nb"), ("<div>a<!-- x <p> --></div><p>b", "a\nb"), ("<p>open <b", "open <b"), ("</p></div>x", "x"), ("<main><p>a</main><p>b", "a"), ("<p>" * 3000 + "deep", "deep"), ("<ul><li><a>m</a><li>text</ul>", "text"), ("&am", "&am")],
)
def test_odd_pages(page, text):
    assert H.extract(page) == text


def plain_match(a, b):
    """Simple tree matching as published."""
    if (a.tag, a.names) != (b.tag, b.names):
        return 0
    xs, ys = a.nodes(), b.nodes()
    kept = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i, x in enumerate(xs):
        for j, y in enumerate(ys):
            kept[i + 1][j + 1] = max(kept[i + 1][j], kept[i][j + 1], kept[i][j] + plain_match(x, y))
    return 1 + kept[-1][-1]


def random_page(rng, depth=4):
    if not depth or rng.random() < 0.2:
        return rng.choice(["<p>x</p>", "<li class=a>y</li>", "z", "<section></section>"])
    tag, name = rng.choice(["div", "ul", "section"]), rng.choice(["", " class=a", " class=b"])
    return f"<{tag}{name}>" + "".join(random_page(rng, depth - 1) for _ in range(rng.randint(0, 5))) + f"</{tag}>"


@pytest.mark.parametrize("cells", [1 << 20, 4])
def test_matching_is_simple_tree_matching(monkeypatch, cells):
    monkeypatch.setattr(H, "_CELLS", cells)
    rng = random.Random(11)
    for _ in range(300):
        a, b = (H.parse(f"<div>{''.join(random_page(rng) for _ in range(3))}</div>") for _ in range(2))
        pairs = H.match(a, b)
        assert len(pairs) == plain_match(a, b)
        first = {id(x): (i, y) for i, (x, y) in enumerate((x, y) for x, y in pairs)}
        assert len(first) == len({id(y) for _, y in pairs}) == len(pairs)
        for x, y in pairs:  # children of matched nodes match in order
            inner = [y.nodes().index(first[id(c)][1]) if any(first[id(c)][1] is d for d in y.nodes()) else None for c in x.nodes() if id(c) in first]
            assert None not in inner and inner == sorted(inner)


def test_simple_tree_matching():
    a, b = H.parse("<div><p>1<p>2<ul><li>x</ul></div>"), H.parse("<div><p>1<ul><li>y<li>z</ul></div>")
    assert len(H.match(a, b)) == 5


def test_wrapper_drops_what_all_pages_share():
    make = lambda i: f"<div><div class=top>Welcome to us</div><div class=x><p>Story {i} of many</p><p>More {i * 7}</p></div><div class=end>Call us now</div></div>"
    wrapper = H.induce([make(i) for i in range(5)])
    assert H.extract(make(9), wrapper) == "Story 9 of many\nMore 63"
    assert H.induce([make(1)] * 5) is None and H.induce([make(1), make(2)]) is None


def site(rng, host, n, layout):
    """(url, html, text) of pages whose text is known. What is beside the text has neither telling
    elements nor names: only a wrapper can tell it."""
    words = lambda k: " ".join(rng.choice("al be co du em fi go ha".split()) + str(rng.randint(0, 999)) for _ in range(k))
    top, bottom, note = words(8), words(12), words(6)
    out = []
    for i in range(n):
        text = [words(rng.randint(10, 40)) for _ in range(rng.randint(1, 6))]
        body = "".join(f"<p>{x}</p>" for x in text[: len(text) // 2]) + (f"<div class=q>{note}</div>" if rng.random() < 0.9 else "") + "".join(f"<p>{x}</p>" for x in text[len(text) // 2 :])
        if layout:
            html = f"<body><div class=a><p>{top}</p><div class=u>{words(2)}</div></div><div class=b>{body}</div><div class=c><p>{bottom}</p></div></body>"
        else:
            html = f"<body><div class=a>{top}</div><article>{body}</article><div class=c>{bottom}</div></body>"
        out.append((f"http://{host}/{i}", html, "\n".join(text)))
    return out


def test_known_texts_with_and_without_wrappers(spark):
    rng = random.Random(5)
    known = [x for h, n, layout in (("a.x", 40, 1), ("b.x", 40, 0), ("c.x", 25, 1), ("c.x", 25, 0)) for x in site(rng, h, n, layout)]
    known += [(f"http://b.x/copy{i}", known[45][1], known[45][2]) for i in range(60)]  # copies of a page: most of the host
    df = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(known)], "page_id long, url string, html string").repartition(5)
    got = {r["page_id"]: r["text"] for r in H.main_text(df).collect()}
    with_wrapper = sum(got[i] == t for i, (_, _, t) in enumerate(known))
    alone = sum(H.extract(h) == t for _, h, t in known)
    assert with_wrapper >= 0.97 * len(known) and alone <= 0.4 * len(known), (with_wrapper, alone, len(known))


def test_deep_and_wide_pages():
    assert H.extract("<div>" * 20_000 + "deep" + "</div>" * 20_000 + "<p>after") == "deep\nafter"
    assert H.extract("<div><article>" + "<div>" * 200 + "in" + "</div>" * 200 + "<p>rest</article></div><p>out") == "in\nrest"
    assert H.extract("<article>" + "<div>" * 300 + "<nav>menu</nav>text" + "</div>" * 300 + "</article>") == "text"
    wide = "".join(f"<p>{i}</p>" for i in range(2000))
    assert H.extract(wide) == "\n".join(map(str, range(2000)))
    pages = [f"<div>Top</div>{wide}<p>{i} own</p>" + "<div class=z>" * 3000 + f"{i}" + "</div>" * 3000 + "<section>End</section>" for i in range(5)]
    assert H.extract(pages[1], H.induce(pages)) == "1 own\n1"
    odd, even = ("<p>x</p><ul><li>y</ul>" * k for k in (1500, 1700))
    assert len(H.match(H.parse(f"<div>{odd}</div>"), H.parse(f"<div><ul></ul>{even}<p>z</div>"))) == 2 + 3 * 1500
    assert H.extract("<article" + " a='" * 5000 + ">x") and H.extract("<" * 20_000) and H.extract("&" * 20_000)
    for page in ("<h1>" * 20_000 + "x", "<div>" * 20_000 + "</p>" * 20_000 + "x", "<body>" * 20_000 + "x"):
        assert H.extract(page) == "x"


def test_whole_table(spark):
    rows = [(1, "http://a.b/1", PAGE), (2, None, PAGE), (3, "http://a.b/2", None), (1, "http://a.b/1", PAGE), (None, "odd", "<p>x"), (4, "http://a.b/3", "<p>" + "y " * 100_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as text", "3 as wrapper")
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in H.main_text(df).collect()}
    assert got[2, None] == (H.extract(PAGE), len(H.extract(PAGE))) and got[3, "http://a.b/2"] == ("", 0) and got[None, "odd"] == ("x", 1) and got[4, "http://a.b/3"][1] == 199_999
    assert H.main_text(df).count() == len(rows) and H.main_text(df.where("false")).count() == 0
