"""Operator 11, main text of web pages by a recurrent block labeller.

A page is read once from front to back into its leaf blocks: the runs of text
between block-level tags, in page order, with the words of the tags above them
(names, classes, ids, roles), their own words and a few measures. A bidirectional
LSTM in numpy reads a page's blocks as one sequence, so every block is judged in
the light of the whole page, and labels each as main text or not. The text of a
page is its main blocks.

The network is trained here on a bounded sample of the pages (``train_pages``
pages of at most ``TRAIN_CHARS`` characters, drawn by a hash). Pages carry no
labels; the teacher is what their tags say outright (``article`` and ``main``
against ``nav``, ``footer``, ``aside``, names such as ``comments``). Besides the
sampled pages themselves the network learns from pages made of their texts anew:
main text and the texts around it are put into other wrappers (some of which say
nothing), in other orders, with comments, notices, forms and adverts between. So
it has to use what stands around a block where its tags are silent.

Pages are labelled where Spark has them, in Arrow batches; pages of about one
length go through the network together. What is broadcast is the network (about
half a MB, whatever the data).

Defined cases: NULL and empty html, and pages without any main block, give the
empty text and 0 characters; text outside any tag is a block like others;
unclosed, misnested and unknown tags are read on; an unclosed script or comment
takes the rest of the page, as in browsers; character references are decoded,
white space inside a block (``br`` too) becomes one space; NULL ids and urls stay;
repeated rows are read each for itself; an empty table gives an empty result;
other columns are ignored. Memory is bounded by the longest page.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.common import table
from adlens.llm.words import WordHash, mix, runs, words_of

PATH_BUCKETS, WORD_BUCKETS = 2048, 4096
PATH_DIM, WORD_DIM, MEASURES, HIDDEN = 24, 12, 6, 24
TRAIN_CHARS = 100_000
MADE_PAGES = 900      # pages made anew for training
RUN_CHARS = 2_000_000
STEP_BLOCKS = 20_000  # blocks that go through the network at once; a longer page alone

# Kinds of HTML elements.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav noscript ol optgroup "
    "option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style template textarea title xmp".split())
SPACED = frozenset(["br", "img", "input"])
CLOSES = {  # an opening tag closes these open ones, up to the list or table that holds them
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}), "option": ({"option"}, {"select", "optgroup"}),
}
# Names that tell what an element is for.
MAIN_NAMES = frozenset("article main articlebody content entry post story".split())
OTHER_TAGS = frozenset("nav footer aside form noscript dialog menu button select label legend option search".split())
OTHER_NAMES = frozenset(
    "ad ads adsbygoogle advert advertisement alert banner breadcrumb breadcrumbs colophon comment commentlist comments "
    "complementary consent contentinfo cookie copyright dialog disqus footer form login masthead menu modal nav navbar "
    "navigation newsletter notice overlay pagination popup promo related replies responses reviews search share sidebar "
    "signup social sponsor sponsored subscribe tags toolbar widget".split())

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^<>]*>|</(?P<end>[a-zA-Z][^\s/<>]*)[^<>]*>?|"
    r"<(?P<tag>[a-zA-Z][^\s/<>]*)(?P<attrs>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME = re.compile(r"[a-z]+")
SCAN = 8  # open elements looked through for one that an opening tag closes


# -- pages to blocks ------------------------------------------------------------------

def bucket(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name.encode()) % PATH_BUCKETS


@dataclass
class Page:
    """The blocks of a page, in order."""

    texts: list[str] = field(default_factory=list)
    paths: list[list[int]] = field(default_factory=list)   # buckets of the tags above, without repeats
    labels: list[int | None] = field(default_factory=list)  # what the tags say: 1 main, 0 other, None nothing
    starts: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)        # characters inside links


class Reader:
    """Reads pages into blocks; one pass, work in step with the page's length."""

    def __init__(self):
        self.buckets: dict[str, int] = {}

    def _bucket(self, name: str) -> int:
        if len(self.buckets) > 100_000:
            self.buckets.clear()
        if name not in self.buckets:
            self.buckets[name] = bucket(name)
        return self.buckets[name]

    def _open(self, tag: str, attrs: str) -> tuple[list[int], int]:
        """Buckets of an element, and what it says: 1 main, -1 other, 0 nothing, 2 header."""
        names = [n for m in ATTRIBUTE.finditer(attrs) for n in NAME.findall((m[2] or m[3] or m[4] or "").lower())] \
            if "=" in attrs else []
        says = 0
        if tag in OTHER_TAGS or not OTHER_NAMES.isdisjoint(names):
            says = -1
        elif tag == "header" or ("header" in names and tag != "h1"):
            says = 2
        elif tag not in ("body", "html") and (tag in ("article", "main") or not MAIN_NAMES.isdisjoint(names)):
            says = 1
        return [self._bucket(tag), *[self._bucket("." + n) for n in dict.fromkeys(names)]], says

    def read(self, html: str | None) -> Page:
        page, html = Page(), html or ""
        stack: list[tuple[str, list[int], int]] = []         # open blocks
        inline: list[tuple[str, list[int], int, int]] = []   # open others, with how many blocks were open
        count: dict[str, int] = {}
        above: dict[int, int] = {}                           # bucket to open elements that have it
        says = {1: 0, -1: 0, 2: 0, 0: 0}
        parts: list[str] = []
        start, linked, path, label = 0, 0, None, None

        def enter(tag, found, said, into):
            into.append((tag, found, said) if into is stack else (tag, found, said, len(stack)))
            count[tag] = count.get(tag, 0) + 1
            says[said] += 1
            for x in found:
                above[x] = above.get(x, 0) + 1

        def leave(into):
            tag, found, said = into.pop()[:3]
            count[tag] -= 1
            says[said] -= 1
            for x in found:
                if above[x] == 1:
                    del above[x]
                else:
                    above[x] -= 1
            if into is stack:
                while inline and inline[-1][3] > len(stack):
                    leave(inline)

        def end_block():
            nonlocal linked, path
            if path is not None:
                page.texts.append(" ".join("".join(parts).split()))
                page.paths.append(path)
                page.labels.append(label)
                page.starts.append(start)
                page.linked.append(linked)
            parts.clear()
            linked, path = 0, None

        def text(at, to):
            nonlocal start, linked, path, label
            piece = html[at:to]
            if "&" in piece:
                piece = entities.unescape(piece)
            if path is None and not piece.isspace():
                start = at
                own = stack[-1][0] if stack else ""
                holder = stack[-2][0] if len(stack) > 1 else ""
                path = [*above, self._bucket("own " + own), self._bucket(f"{holder} {own}")]
                label = 0 if says[-1] or (says[2] and not says[1]) else 1 if says[1] else None
            parts.append(piece)
            if count.get("a"):
                linked += len(piece)

        at = 0
        while at < len(html):
            m = TOKEN.search(html, at)
            to = m.start() if m else len(html)
            if to > at:
                text(at, to)
            if not m:
                break
            at = m.end()
            if m["end"]:
                tag = m["end"].lower()
                if tag in BLOCKS:
                    end_block()
                into = stack if tag in BLOCKS else inline
                if count.get(tag):
                    while into and into[-1][0] != tag:
                        leave(into)
                    if into:
                        leave(into)
            elif m["tag"]:
                tag = m["tag"].lower()
                if tag in RAW:
                    close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^<>]*>?", re.I).search(html, at)
                    at = close.end() if close else len(html)
                    continue
                if tag in SPACED:
                    parts.append(" ")
                if tag in BLOCKS:
                    end_block()
                    if stack and stack[-1][0] == "p":
                        leave(stack)
                    if tag in CLOSES:
                        shut, within = CLOSES[tag]
                        for k in range(len(stack) - 1, max(-1, len(stack) - 1 - SCAN), -1):
                            if stack[k][0] in shut:
                                while len(stack) > k:
                                    leave(stack)
                                break
                            if stack[k][0] in within:
                                break
                if tag not in VOID:
                    enter(tag, *self._open(tag, m["attrs"]), stack if tag in BLOCKS else inline)
        end_block()
        return page


# -- blocks to numbers ------------------------------------------------------------------

@dataclass
class Blocks:
    """Blocks of several pages in a row, as the network reads them."""

    sizes: np.ndarray       # blocks of each page
    path_ids: np.ndarray
    path_of: np.ndarray     # block of each path id
    word_ids: np.ndarray
    word_of: np.ndarray
    measures: np.ndarray


def numbers(pages: list[Page], hashes: WordHash) -> Blocks:
    sizes = np.array([len(p.texts) for p in pages], np.int64)
    texts = [t for p in pages for t in p.texts]
    paths = [x for p in pages for x in p.paths]
    words = [words_of(t) for t in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    n_path = np.array([len(x) for x in paths], np.int64)
    n_chars = np.array([len(t) for t in texts], np.float64)
    linked = np.array([x for p in pages for x in p.linked], np.float64)
    ends = np.array([t.endswith((".", "!", "?", "。")) for t in texts], np.float64)
    place = np.concatenate([np.arange(n) / max(n, 1) for n in sizes.tolist()]) if len(sizes) else np.zeros(0)
    many = np.repeat(np.log1p(sizes), sizes)
    measures = np.stack([np.log1p(n_chars) / 5, np.log1p(n_words) / 4, np.minimum(linked / np.maximum(n_chars, 1), 1),
                         ends, place, many / 5], axis=1).astype(np.float32) if len(texts) else np.zeros((0, MEASURES), np.float32)
    h = mix(hashes.of([w for ws in words for w in ws]))
    k = np.arange(len(texts))
    return Blocks(sizes, np.fromiter((i for x in paths for i in x), np.int64, int(n_path.sum())), np.repeat(k, n_path),
                  (h % np.uint64(WORD_BUCKETS)).astype(np.int64), np.repeat(k, n_words), measures)


# -- the network ------------------------------------------------------------------------

def new_network(rng: np.random.Generator) -> dict[str, np.ndarray]:
    d = PATH_DIM + WORD_DIM + MEASURES
    net = {"paths": rng.normal(0, 0.3, (PATH_BUCKETS, PATH_DIM)), "words": rng.normal(0, 0.1, (WORD_BUCKETS, WORD_DIM)),
           "out": rng.normal(0, 0.3, 2 * HIDDEN), "out_bias": np.zeros(1)}
    for way in ("f", "b"):
        net["x" + way] = rng.normal(0, d ** -0.5, (d, 4 * HIDDEN))
        net["h" + way] = rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN))
        net["bias" + way] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    return {k: v.astype(np.float32) for k, v in net.items()}


def inputs(net: dict, b: Blocks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The network's input of each block, and by what its path and word sums were divided."""
    n = len(b.measures)
    per_path = np.sqrt(np.maximum(np.bincount(b.path_of, minlength=n), 1)).astype(np.float32)
    per_word = np.maximum(np.bincount(b.word_of, minlength=n), 1).astype(np.float32)
    x = np.zeros((n, PATH_DIM + WORD_DIM + MEASURES), np.float32)
    for table_, ids, of, at, per in (("paths", b.path_ids, b.path_of, 0, per_path),
                                     ("words", b.word_ids, b.word_of, PATH_DIM, per_word)):
        width = net[table_].shape[1]
        if len(ids):
            first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            x[of[first], at:at + width] = np.add.reduceat(net[table_][ids], first, axis=0)
        x[:, at:at + width] /= per[:, None]
    x[:, PATH_DIM + WORD_DIM:] = b.measures
    return x, per_path, per_word


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def steps(sizes: np.ndarray, reverse: bool) -> tuple[np.ndarray, np.ndarray]:
    """(pages x longest) places of blocks, each page from its start or its end, and which are there."""
    t = np.arange(sizes.max(initial=0))
    there = t[None, :] < sizes[:, None]
    first = np.cumsum(sizes) - sizes
    at = (sizes[:, None] - 1 - t[None, :]) if reverse else np.broadcast_to(t, there.shape)
    return np.where(there, first[:, None] + at, 0), there


def run_way(net: dict, way: str, x: np.ndarray, sizes: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden state of every block in one direction; with ``keep`` what the gradient needs."""
    at, there = steps(sizes, way == "b")
    pre = x @ net["x" + way] + net["bias" + way]
    h = np.zeros((len(sizes), HIDDEN), np.float32)
    c, out, kept = np.zeros_like(h), np.zeros((len(x), HIDDEN), np.float32), []
    for t in range(at.shape[1]):
        on = there[:, t]
        z = pre[at[on, t]] + h[on] @ net["h" + way]
        i, f, o = (sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN:])
        old_c, old_h = c[on], h[on]
        new_c = f * old_c + i * g
        tanh_c = np.tanh(new_c)
        c[on], h[on] = new_c, o * tanh_c
        out[at[on, t]] = h[on]
        if keep:
            kept.append((on, at[on, t], i, f, o, g, old_c, old_h, tanh_c))
    return out, kept


def logits(net: dict, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    both = np.concatenate([run_way(net, way, x, sizes, False)[0] for way in "fb"], axis=1)
    return both @ net["out"] + net["out_bias"][0]


def gradient(net: dict, b: Blocks, wanted: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean log loss over the blocks with a label (``wanted`` >= 0), and its gradient."""
    x, per_path, per_word = inputs(net, b)
    ways = {way: run_way(net, way, x, b.sizes, True) for way in "fb"}
    both = np.concatenate([ways[w][0] for w in "fb"], axis=1)
    z = both @ net["out"] + net["out_bias"][0]
    known = wanted >= 0
    n = max(int(known.sum()), 1)
    loss = float(np.logaddexp(0, np.where(wanted == 1, -z, z))[known].sum() / n)
    dz = np.where(known, (sigmoid(z) - (wanted == 1)) / n, 0).astype(np.float32)
    grad = {"out": both.T @ dz, "out_bias": dz.sum(keepdims=True)}
    dx = np.zeros_like(x)
    for k, way in enumerate("fb"):
        d_out = dz[:, None] * net["out"][k * HIDDEN:(k + 1) * HIDDEN]
        d_pre = np.zeros((len(x), 4 * HIDDEN), np.float32)
        dh = np.zeros((len(b.sizes), HIDDEN), np.float32)
        dc = np.zeros_like(dh)
        gh = np.zeros_like(net["h" + way])
        for on, at, i, f, o, g, old_c, old_h, tanh_c in reversed(ways[way][1]):
            d = dh[on] + d_out[at]
            e = dc[on] + d * o * (1 - tanh_c ** 2)
            dzs = np.concatenate([e * g * i * (1 - i), e * old_c * f * (1 - f), d * tanh_c * o * (1 - o),
                                  e * i * (1 - g ** 2)], axis=1)
            d_pre[at] = dzs
            gh += old_h.T @ dzs
            dh[on], dc[on] = dzs @ net["h" + way].T, e * f
        grad["x" + way], grad["h" + way], grad["bias" + way] = x.T @ d_pre, gh, d_pre.sum(axis=0)
        dx += d_pre @ net["x" + way].T
    for name, ids, of, at, per in (("paths", b.path_ids, b.path_of, 0, per_path),
                                   ("words", b.word_ids, b.word_of, PATH_DIM, per_word)):
        g = np.zeros_like(net[name])
        np.add.at(g, ids, (dx[:, at:at + g.shape[1]] / per[:, None])[of])
        grad[name] = g
    return loss, grad


def train_network(pages: list[tuple[Page, list[int]]], epochs: int = 10, batch: int = 32, rate: float = 0.01,
                  seed: int = 11) -> dict[str, np.ndarray]:
    """Adam over the pages' blocks; a label below 0 is not learned from."""
    rng = np.random.default_rng(seed)
    net, hashes = new_network(rng), WordHash()
    first, second = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    pages = sorted((p for p in pages if p[0].texts), key=lambda p: len(p[0].texts))
    batches = [pages[k:k + batch] for k in range(0, len(pages), batch)]  # of about one length
    ready = [(numbers([p for p, _ in part], hashes), np.array([y for _, ys in part for y in ys])) for part in batches]
    total, done = max(1, epochs * len(ready)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(ready)).tolist():
            _, grad = gradient(net, *ready[k])
            done += 1
            norm = np.sqrt(sum(float((g ** 2).sum()) for g in grad.values()))
            now = rate * (1 - 0.9 * done / total)
            for name, g in grad.items():
                g = g / max(norm, 1.0)
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                net[name] -= now * (first[name] / (1 - 0.9 ** done)) / (np.sqrt(second[name] / (1 - 0.99 ** done)) + 1e-6)
    return net


# -- pages to learn from ------------------------------------------------------------------

# Wrappers of main text and of the rest, as pages have them; {} is what they hold.
MAIN_WRAPPERS = (
    "<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", "<article>{}</article>", '<div id="content">{}</div>',
    '<div class="post-body">{}</div>', '<section class="entry-content">{}</section>', '<div class="story">{}</div>',
    '<div itemprop="articleBody">{}</div>', '<div role="main">{}</div>', "<div>{}</div>", "<section>{}</section>", "{}")
MENUS = ("<nav><ul>{}</ul></nav>", '<div class="menu"><ul>{}</ul></div>', '<ul class="nav-links">{}</ul>',
         '<div role="navigation">{}</div>', '<div class="breadcrumbs">{}</div>', "<ul>{}</ul>", '<div class="pagination">{}</div>')
HEADERS = ("<header>{}</header>", '<div class="site-header">{}</div>', '<div id="masthead">{}</div>')
FOOTERS = ("<footer>{}</footer>", '<div class="footer">{}</div>', '<div id="colophon">{}</div>', '<div class="copyright">{}</div>')
SIDEBARS = ("<aside>{}</aside>", '<div class="sidebar">{}</div>', '<div class="widget">{}</div>', '<div class="related-posts">{}</div>',
            '<div class="share social">{}</div>', '<div class="tags">{}</div>')
NOTICES = ('<div class="cookie-notice">{}</div>', '<div class="alert">{}</div>', '<div role="dialog">{}</div>', '<div class="popup">{}</div>',
           "<noscript>{}</noscript>", '<div class="consent-banner">{}</div>', '<div class="notice">{}</div>')
ADVERTS = ('<div class="ad">{}</div>', '<div class="ads">{}</div>', '<div class="advert">{}</div>', '<div class="sponsored">{}</div>',
           '<section class="promo">{}</section>', '<ins class="adsbygoogle">{}</ins>', '<div id="ad-top">{}</div>')
FORMS = ("<form>{}</form>", '<div class="newsletter">{}</div>', '<div class="search">{}</div>', '<form class="login">{}</form>',
         '<div class="subscribe"><form>{}</form></div>', '<div class="signup">{}</div>')
COMMENTS = ('<section id="comments">{}</section>', '<div class="comments">{}</div>', '<ol class="commentlist">{}</ol>',
            '<div id="disqus_thread">{}</div>', '<div class="reviews">{}</div>', '<div class="responses">{}</div>')
SHELLS = ("{}", '<div class="wrap">{}</div>', '<div id="page"><div class="row">{}</div></div>', '<div class="container">{}</div>')


class Maker:
    """Makes pages to learn from out of the texts of sampled pages."""

    def __init__(self, main: list[str], other: list[str], rng: np.random.Generator):
        self.main, self.other, self.rng = main or ["text"], other or main or ["text"], rng

    def pick(self, of):
        return of[int(self.rng.integers(len(of)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def words(self) -> str:
        """A text of the main ones, or a few words of it."""
        text = self.pick(self.main)
        return " ".join(text.split()[:int(self.rng.integers(1, 6))]) if self.chance(0.25) else text

    def block(self, text: str, tag: str = "p") -> str:
        text = entities.escape(text)
        return f"<p>{text}" if tag == "p" and self.chance(0.1) else f"<{tag}>{text}</{tag}>"

    def links(self) -> str:
        tag = self.pick(["li", "li", "span", "div"])
        return "".join(f'<{tag}><a href="/">{entities.escape(" ".join(self.pick(self.other).split()[:3]))}</a></{tag}>'
                       for _ in range(int(self.rng.integers(2, 9))))

    def around(self, kind: str) -> str:
        """A piece that is not main text."""
        few = int(self.rng.integers(1, 4))
        text = self.pick(self.main if self.chance(0.4) else self.other)
        if kind == "menu":
            return self.pick(MENUS).format(self.links())
        if kind == "header":
            return self.pick(HEADERS).format(self.pick([self.block(text, "h1"), self.block(text), self.links()]))
        if kind == "footer":
            return self.pick(FOOTERS).format(self.pick([entities.escape(text), self.block(text), self.links()]))
        if kind == "sidebar":
            return self.pick(SIDEBARS).format(self.block(" ".join(text.split()[:3]), "h3") + self.pick([self.links(), self.block(text)]))
        if kind == "notice":
            return self.pick(NOTICES).format(self.pick([entities.escape(text), self.block(text), self.block(text) + "<button>ok</button>"]))
        if kind == "advert":
            return self.pick(ADVERTS).format(self.pick([entities.escape(text), self.block(text)]))
        if kind == "form":
            words = [entities.escape(" ".join(self.pick(self.other).split()[:4])) for _ in range(few)]
            held = "".join(self.pick([f"<label>{w}</label><input>", f"<p>{w}</p><input>", f"<button>{w}</button>",
                                      f"<select><option>{w}<option>{w}</select>"]) for w in words)
            return self.pick(FORMS).format(held)
        said = [self.block(self.pick(self.main), "p") for _ in range(few)]
        shape = self.pick(["{}", '<div class="comment">{}</div>', "<article>{}</article>", "<li>{}</li>", "<div><b>x</b>{}</div>"])
        return self.pick(COMMENTS).format(self.block(" ".join(text.split()[:2]), "h3") + "".join(shape.format(s) for s in said))

    def page(self) -> tuple[str, list[tuple[int, int]]]:
        """A page and where its main text stands in it."""
        body = []  # (html, main)
        if self.chance(0.8):
            body.append((self.block(self.words()[:80], "h1"), True))
        for _ in range(int(self.rng.integers(1, 10))):
            text, sort = self.words(), self.rng.random()
            if sort < 0.75:
                body.append((self.block(text), True))
            elif sort < 0.95:
                body.append((self.pick(["<h2>{}</h2>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<pre>{}</pre>",
                                        "<table><tr><td>{}</td></tr></table>", "<h3>{}</h3>", "<div>{}</div>"]).format(entities.escape(text)), True))
            else:
                body.append((self.around(self.pick(["advert", "notice", "sidebar"])), False))
        if self.chance(0.1):
            body.append((self.around("comment"), False))
        left, right = self.pick(MAIN_WRAPPERS).split("{}")
        before = [self.around(k) for k in ("notice", "menu", "header", "menu", "advert", "form") if self.chance(0.45)]
        after = [self.around(k) for k in ("advert", "sidebar", "comment", "comment", "form", "notice", "footer") if self.chance(0.45)]
        shell_left, shell_right = self.pick(SHELLS).split("{}")
        pieces = [("<html><body>", False), (shell_left, False), *[(x, False) for x in before], (left, False), *body,
                  (right, False), *[(x, False) for x in after], (shell_right, False)]
        spans, at = [], 0
        for piece, is_main in pieces:
            if is_main:
                spans.append((at, at + len(piece)))
            at += len(piece)
        return "".join(x for x, _ in pieces), spans


def cut(page: Page, rng: np.random.Generator) -> Page:
    """The page with a third of its texts cut to a few words, as its tags tell the same of short texts."""
    texts = [" ".join(t.split()[:int(rng.integers(1, 4))]) if rng.random() < 0.33 else t for t in page.texts]
    return Page(texts, page.paths, page.labels, page.starts, page.linked)


def lessons(htmls: list[str], made: int, seed: int = 5) -> list[tuple[Page, list[int]]]:
    """Pages with labels (-1: none): the sampled ones as their tags label them (also with
    shorter texts), and ``made`` pages of their texts."""
    reader, rng = Reader(), np.random.default_rng(seed)
    real = [reader.read(h) for h in htmls]
    out = [(p, [-1 if y is None else y for y in p.labels]) for p in real if any(y == 1 for y in p.labels)]
    out += [(cut(p, rng), y) for p, y in out]
    texts = {y: [t for p in real for t, said in zip(p.texts, p.labels) if said in (y, None)] for y in (0, 1)}
    maker = Maker(texts[1], texts[0], rng)
    for _ in range(made):
        html, spans = maker.page()
        page = reader.read(html)
        out.append((page, [int(any(a <= s < z for a, z in spans)) for s in page.starts]))
    return out


# -- over the pages -------------------------------------------------------------------------

def train(pages: DataFrame, train_pages: int = 400, html_col: str = "html") -> dict[str, np.ndarray]:
    """The network, trained on a bounded sample of ``pages``."""
    sample = (pages.select(F.col(html_col).cast("string").alias("h")).where(F.length("h").between(1, TRAIN_CHARS))
              .orderBy(F.xxhash64("h"), "h").limit(train_pages).toArrow())
    return train_network(lessons(sample.column("h").to_pylist(), MADE_PAGES))


def page_texts(htmls: list[str | None], net: dict, reader: Reader, hashes: WordHash) -> list[str]:
    """The main text of each page."""
    pages = [reader.read(h) for h in htmls]
    out = [""] * len(pages)
    order = sorted((k for k, p in enumerate(pages) if p.texts), key=lambda k: len(pages[k].texts))
    for part in runs(order, lambda k: len(pages[k].texts), STEP_BLOCKS):
        b = numbers([pages[k] for k in part], hashes)
        main = logits(net, inputs(net, b)[0], b.sizes) > 0
        at = 0
        for k in part:
            texts = pages[k].texts
            out[k] = "\n\n".join(t for t, keep in zip(texts, main[at:at + len(texts)].tolist()) if keep)
            at += len(texts)
    return out


def extracted(pages: DataFrame, net: dict[str, np.ndarray], html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, hashes = Reader(), WordHash()
        for b in batches:
            at = 0
            for htmls in runs(b.column(2).to_pylist(), lambda h: len(h or "") + 100, RUN_CHARS):
                texts = page_texts(htmls, shared.value, reader, hashes)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(htmls)), b.column(1).slice(at, len(htmls)), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
                at += len(htmls)

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` with their main text."""
    pages = table(spark, sf_dir, "pages")
    return extracted(pages, train(pages))
