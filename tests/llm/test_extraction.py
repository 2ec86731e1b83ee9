import html as entities
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlens.llm import extraction
from adlens.llm.extraction import Reader, extracted, gradient, lessons, logits, inputs, new_network, numbers, op11_html_extraction, page_texts, train
from adlens.llm.words import WordHash

SCHEMA = "page_id long, url string, html string"


def article_text(html):
    """What the given pages' one article holds, cut out by its tags."""
    inside = re.search(r"<article>(.*)</article>", html, re.S)[1]
    blocks = [" ".join(entities.unescape(re.sub(r"</?b>", "", x).replace("<br>", " ")).split())
              for x in re.split(r"</?(?:p|h1)>", inside)]
    return "\n\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.1/pages.parquet")


@pytest.fixture(scope="module")
def network(pages):
    return train(pages)


def test_every_page_of_the_table(pages, network):
    got = {r["page_id"]: r for r in extracted(pages, network).collect()}
    html = pages.collect()
    assert len(got) == len(html)
    for r in html:
        want = article_text(r["html"])
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)
        assert got[r["page_id"]]["url"] == r["url"]


def test_query(spark):
    got = op11_html_extraction(spark, "/root/testdata/sf0.01").collect()
    html = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(got) == len(html)
    assert all(r["text"] == article_text(html[r["page_id"]]) for r in got)


def test_held_out_labels(pages, network):
    """Blocks of pages whose texts and make-up the network has not seen."""
    seen = {r[0] for r in pages.orderBy(F.xxhash64("html"), "html").limit(400).select("html").collect()}
    other = [r["html"] for r in pages.orderBy("page_id").collect() if r["html"] not in seen][:150]
    rows = lessons(other, 300, seed=99)[300:]
    b = numbers([p for p, _ in rows], WordHash())
    wanted = np.array([y for _, ys in rows for y in ys])
    right = (logits(network, inputs(network, b)[0], b.sizes) > 0) == (wanted == 1)
    assert len(rows) == 300 and right.mean() > 0.99


MAIN = ("A first paragraph of the story, which has some length to it.", "Then a second one &amp; it goes on  for\n a while, too.",
        "Short.")
AROUND = [
    '<header class="site-header"><h1>Our site</h1></header>', "<nav><ul><li><a href='/'>Home</a><li><a href='/x'>About us</a></ul></nav>",
    '<aside><h3>More</h3><p>Something else entirely that is long enough to read.</p></aside>',
    '<div class="sidebar"><p>Something else entirely that is long enough to read.</p></div>',
    '<div class="cookie-notice"><p>We use cookies to make this site better for you.</p></div>',
    '<div class="ads"><p>Buy these fine things now, they are cheap.</p></div>',
    '<form action="/s"><label>Your name</label><input><button>Send</button></form>',
    '<section id="comments"><h3>Comments</h3><div class="comment"><p>I liked the story a lot, it is a good one.</p></div></section>',
    "<footer><p>All rights reserved by the people who run this.</p></footer>",
    "<script>var x = '<p>no</p>';</script>", "<style>p { margin: 0 }</style>", "<!-- <p>hidden</p> -->",
]


@pytest.mark.parametrize("wrapper", ["<article>{}</article>", "<main>{}</main>", '<div class="entry-content">{}</div>'])
def test_layouts_that_the_table_does_not_have(network, wrapper):
    body = "".join(f"<p>{t}</p>" for t in MAIN)
    k = len(AROUND) // 2
    page = "<html><body>" + "".join(AROUND[:k]) + wrapper.format(body) + "".join(AROUND[k:]) + "</body></html>"
    want = ("A first paragraph of the story, which has some length to it.\n\n"
            "Then a second one & it goes on for a while, too.\n\nShort.")
    assert page_texts([page], network, Reader(), WordHash()) == [want]


def test_blocks_of_odd_markup():
    def read(h):
        return Reader().read(h).texts

    assert read("plain &lt;b&gt; text") == ["plain <b> text"]
    assert read("<p>a<br>b<p>c<li>d<li>e</p>f") == ["a b", "c", "d", "e", "f"]
    assert read("x<!-- no <p>a --> y<!-- open <p>z") == ["x y"]
    assert read("<p>1 < 2 && 3 > 2 <unclosed") == ["1 < 2 && 3 > 2 <unclosed"]
    assert read("<script>a</script><SCRIPT>b</ScRiPt >c<style>d") == ["c"]
    assert read("<p title='a>b'>x</p><p title=\"q>r\">y&nbsp; z</p>") == ["x", "y z"]
    assert read("<td>a<td>b</tr><tr><td>c</b></i></table>d") == ["a", "b", "c", "d"]
    assert read("") == read(None) == read("<p> </p><div>\n&#32;</div>") == []


def test_work_in_step_with_length(network):
    """Deep nesting, very many blocks and unclosed marks: no work that grows with the square."""
    page = "<div>" * 60_000 + "x" + "<p>a b" * 30_000 + "<a <b '" * 20_000 + "<!--" * 20_000
    assert len(Reader().read(page).texts) >= 30_000
    assert len(page_texts([page, "<p>x"], network, Reader(), WordHash())) == 2


def test_edge_rows(spark, network):
    big = "<article>" + "<p>word &amp; word.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, None, "<article><p>x y z here.</p></article>"), (3, "u", "<nav><a>x</a></nav>"),
            (4, "v", big), (4, "v", big), (None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("text", "n_chars", "h", "_row")})
    got = extracted(frame, network)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(got.collect(), key=str)
    assert len(got) == len(rows)
    texts = [r["text"] for r in got]
    assert texts.count("") == 4 and texts.count("\n\n".join(["word & word."] * 20_000)) == 2
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_empty_table(spark, monkeypatch):
    monkeypatch.setattr(extraction, "MADE_PAGES", 20)
    none = spark.createDataFrame([], SCHEMA)
    assert extracted(none, train(none)).collect() == []


def test_gradient_against_differences():
    net = {k: v.astype(np.float64) for k, v in new_network(np.random.default_rng(0)).items()}
    rows = lessons(["<article><p>a b c.</p><p>d e.</p></article><nav><a>x</a></nav>"] * 2, 3)
    b, wanted = numbers([p for p, _ in rows], WordHash()), np.array([y for _, ys in rows for y in ys])
    grad = gradient(net, b, wanted)[1]
    for name, g in grad.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        losses = []
        for change in (1e-4, -1e-4):
            moved = {k: v.copy() for k, v in net.items()}
            moved[name][at] += change
            losses.append(gradient(moved, b, wanted)[0])
        assert abs((losses[0] - losses[1]) / 2e-4 - g[at]) < 1e-3 * max(1, abs(g[at]))


def test_pages_read_together_or_alone(pages, network):
    htmls = [r["html"] for r in pages.limit(40).collect()]
    together = page_texts(htmls, network, Reader(), WordHash())
    assert together == [page_texts([h], network, Reader(), WordHash())[0] for h in htmls]
