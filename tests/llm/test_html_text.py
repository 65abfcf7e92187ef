import html
import re

import pytest
from conftest import DATA, rows

from lakemodels.llm import html_text as H

PARAGRAPHS = [
    "The first paragraph tells a story of some length, with commas, and with an ending.",
    "A second one follows it &amp; goes on for a while so that it is clearly text.",
    "Finally a third paragraph <a href='/x'>with a link</a> in the middle of it, and more words.",
]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
TEXT = "\n\n".join(html.unescape(re.sub(r"<[^>]+>", "", p)) for p in PARAGRAPHS)
MENU = "<ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li><li><a href='/c'>Contact</a></li></ul>"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body><nav>{MENU}</nav><article>{BODY}</article><footer>Copyright 2020</footer></body></html>",
        f"<html><body><div>{MENU}</div><div class=main-text>{BODY}</div><div id=footer><p>All rights reserved by us</p></div>",
        f"<body><header>Site title</header><main>{BODY}</main><aside>{MENU}<p>Read this too, it is good</p></aside>",
        f"<body><div class='cookie-notice'>We use cookies, accept?</div><div>{BODY}</div><form><p>Name</p><input></form>",
        f"<body><div>{BODY}</div><div class='comments'><p>I liked this text very much, thanks for it.</p></div>",
        f"<body><article>{BODY}<script>var x = '</p><p>no';</script><style>p {{}}</style><!-- <p>no</p> --></article>",
        f"<body><div class=ad>Buy this now</div><section><div>{BODY.replace('</p>', '')}</div></section>",
    ],
)
def test_only_the_article_stays(page):
    assert H.main_text(page) == TEXT


def test_blocks_white_space_and_references():
    page = "<article><h1> A&nbsp;&lt;b&gt;\n title</h1><p>one<br>two\t\tthree<p>four <b>f<i>iv</i>e</b><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></article>"
    assert H.main_text(page) == "A <b> title\n\none two three\n\nfour five\n\nx\n\ny\n\n1\n\n2"


@pytest.mark.parametrize("page", [None, "", "   ", "<html></html>", "<nav>a</nav>", "<!-- x", "<", "<script>x"])
def test_pages_without_text(page):
    assert H.main_text(page) in ("", "<")


def test_deep_and_broken_pages():
    assert H.main_text("<div>" * 30_000 + "deep text") == "deep text"
    assert H.main_text("<b><p>a</b></p></i></div>b") == "a\n\nb"
    assert H.main_text("<p class=\"a>b\" title='c>d'>text</p>") == "text"


def test_query_finds_every_article(spark):
    """The given pages mark their article, so a plain cut by its tags is the truth."""

    def cut(page):
        inner = page[page.index("<article>") + 9 : page.index("</article>")].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        return "\n\n".join(b for b in blocks if b)

    wanted = [(r.page_id, r.url, cut(r.html)) for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    got = H.op8_html(spark, DATA)
    assert rows(got.select("page_id", "url", "text")) == sorted(wanted, key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert got.where("n_chars <> char_length(text)").count() == 0


def test_rows_that_are_odd(spark):
    df = spark.createDataFrame(
        [(1, None, "t"), (2, "", "t"), (3, "<p>a</p>", "t"), (3, "<p>a</p>", "t"), (None, "<p>b</p>", "t")], "page_id long, html string, Text string"
    )
    got = H.extracted(df)
    assert sorted(got.columns) == ["n_chars", "page_id", "text"]
    assert rows(got.select("page_id", "text", "n_chars")) == [(None, "b", 1), (1, "", 0), (2, "", 0), (3, "a", 1), (3, "a", 1)]
    assert H.extracted(df.limit(0)).count() == 0


def test_frames_with_names_of_noise_keep_their_article():
    body = "<p>" + "Plain words of the story go on for a while. " * 8 + "</p>"
    text = " ".join(("Plain words of the story go on for a while. " * 8).split())
    side = "<div class='sidebar'><p>Elsewhere</p></div><div class='comments'><p>I liked it</p></div>"
    for frame in ("<div class='content has-sidebar'>", "<div class='wrapper header-fixed'>", "<form action='/'>", "<div id='pageMenuLayout'>"):
        end = "</form>" if frame.startswith("<form") else "</div>"
        assert H.main_text(f"<body>{frame}<div>{body}{body}</div>{side}{end}</body>") == f"{text}\n\n{text}", frame
    titled = f"<body><article><header class='entry-header'><h1>The title</h1></header>{body}</article>{side}</body>"
    assert H.main_text(titled) == f"The title\n\n{text}"
    talk = "<div id='comments'>" + "<article><p>" + "A long reply of a reader. " * 40 + "</p></article></div>"
    assert H.main_text(f"<body><div><h1>Top</h1>{body}</div>{talk}</body>") == f"Top\n\n{text}"


LONG = "Plain words of the story go on for a while, with a point at the end. " * 6


@pytest.mark.parametrize(
    "part",
    [
        "<p class='market-share'>The share of the market rose.</p>",
        "<div class='social-policy'><p>What the state pays for.</p></div>",
        "<section id='related-work'><h2>Related work</h2><p>Others did this before, in another way.</p></section>",
        "<p class='alert'>Mind the step, it is high.</p>",
        "<p class='informed-consent notice'>They agreed to it.</p>",
        "<h2>References</h2><ul>" + "".join(f"<li><a href='/{i}'>Source number {i}</a></li>" for i in range(8)) + "</ul>",
    ],
)
def test_names_of_subjects_and_lists_of_links_stay_in_an_article(part):
    page = f"<body><nav>{MENU}</nav><article><p>{LONG}</p>{part}<p>{LONG}</p></article><div class='ad'>Buy</div></body>"
    said = [" ".join(t.split()) for t in re.split(r"</?(?:p|h2|li|ul|div|section)[^>]*>", re.sub(r"</?a[^>]*>", "", part))]
    text = " ".join(LONG.split())
    assert H.main_text(page) == "\n\n".join([text, *[t for t in said if t], text])


@pytest.mark.parametrize(
    "part",
    [
        f"<div class='social-links'>{MENU}</div>",
        f"<div class='site-social-media'>{MENU}</div>",
        "<div class='cookie-notice'>We use cookies, accept?</div>",
        "<div class='ad-slot'>Buy this now</div>",
        "<div class='notice'>The shop is shut on Monday</div>",
        "<p class='share'><a href='/f'>Tell</a> <a href='/t'>others</a></p>",
        "<ol class='comment-list'><li>I liked it</li></ol>",
        "<template><div><template>inner</template>tail</div></template>",
        "<svg><g><svg><text>a</text></svg><text>b</text></g></svg>",
    ],
)
def test_noise_goes_from_an_article(part):
    assert H.main_text(f"<body><article><p>{LONG}</p>{part}</article></body>") == " ".join(LONG.split())


def test_articles_beside_each_other():
    text = " ".join(LONG.split())
    two = f"<article><p>{LONG}</p><p>{LONG}</p></article>"
    other = f"<article><p>{LONG}</p></article><article class='comment'><p>{LONG}</p></article>"
    assert H.main_text(f"<body><div>{two}{other}</div></body>") == "\n\n".join([text] * 3)


def test_the_core_has_the_greatest_density_sum(monkeypatch):
    """Random pages without article or main, against sums taken node by node over whole subtrees."""
    import math
    import random

    draw = random.Random(4)

    def made(depth):
        out = ""
        for _ in range(draw.randrange(1, 4)):
            words = " ".join(["word"] * draw.randrange(1, 30))
            kind = draw.choice(["p", "div", "link", "text"]) if depth else "p"
            inner = {"p": f"<p>{words}</p>", "text": words, "link": f"<a href=x>{words}</a>"}.get(kind)
            out += inner or f"<div>{made(depth - 1)}</div>"
        return out

    seen = {}
    kept = H.Page._kept
    monkeypatch.setattr(H.Page, "_kept", lambda self, path, *a: seen.update(path=path, threshold=a[1]) or kept(self, path, *a))
    for _ in range(60):
        page = H.Page(f"<body>{made(4)}</body>")
        page.text()
        n, tags, parents = len(page.tags), page.tags, page.parents

        def up(i):
            while i >= 0:
                yield i
                i = parents[i]

        inside = [[j for j in range(n) if i in up(j)] for i in range(n)]
        size = [sum(len("".join(t.split())) for k, t in page.events if k == j and t) for j in range(n)]
        linked = [any(tags[k] == "a" for k in up(j)) for j in range(n)]
        c = [sum(size[j] for j in inside[i]) for i in range(n)]
        lc = [sum(size[j] for j in inside[i] if linked[j]) for i in range(n)]
        body = tags.index("body")

        def density(i):
            if not c[i]:
                return 0.0
            t, lt = len(inside[i]) - 1, sum(tags[j] == "a" for j in inside[i] if j != i)
            base = math.log(c[i] * lc[i] / ((c[i] - lc[i]) or 1) + c[i] * lc[body] / c[body] + math.e)
            return c[i] / (t or 1) * math.log(max(c[i] * (t or 1) / ((lc[i] or 1) * (lt or 1)), 1)) / max(math.log(base), 1e-4)

        sums = {i: sum(density(j) for j in range(n) if parents[j] == i) for i in inside[body]}
        assert sums[seen["path"][0]] == pytest.approx(max(sums.values()))
        assert seen["threshold"] == pytest.approx(min(density(i) for i in up(seen["path"][0]) if i in sums))
