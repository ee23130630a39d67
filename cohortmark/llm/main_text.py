"""Main-text extraction: gradient-boosted trees over DOM nodes, decoded over the tree.

A page becomes its block elements (inline tags belong to the text around them). Each gets features of its subtree (text and link density,
marks), attribute tokens of itself and its ancestors, depth, and its place among its siblings; boosted trees give the
log-odds that it is main text. Decoding then chooses for every node to keep its whole subtree, drop it, or decide below, by the best sum
over the tree, so that nothing is kept inside something dropped.

The trees are fitted on a bounded sample of ``TRAIN_PAGES`` pages (by hash of page_id, those of at most ``TRAIN_CHARS`` characters first; of a longer one
so many characters). Labels come by
construction: the sampled texts are laid into generated layouts with menus, headers, notices, adverts, sidebars, forms,
comments and footers, in which tags and class names vary or say nothing; the sampled pages themselves are labelled where they use
HTML's own sectioning tags. Extraction reads every page whole, in time in proportion to its length, whatever its markup: blocks nested deeper than
``MOST_DEEP`` count as that deep, and once a quote stays open to the end of a page its tags end at the next ``>``.

Character references are decoded, white space inside a block becomes one space, blocks are joined in page order by a line end. A page without any element is one text. Null or
empty html, and pages without main text, give an empty text. Repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import per_batch

TRAIN_PAGES, TRAIN_CHARS, VARIANTS, TREES, DEPTH = 200, 50_000, 5, 60, 4

#: A tag up to its end, quotes skipped whole: group 1 the slash, 2 the name, 3 the attributes.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
SPACES = re.compile(r"\s+")
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "select", "object", "xmp", "noembed", "noframes"}
RAW_END = {t: re.compile(f"</{t}", re.I) for t in RAW}
#: The attribute that marks main text (1) and the rest (0) in generated layouts.
LABEL = "data-truth"
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
TAG_GROUPS = (
    ("article", "main"), ("section", "div", "center"), ("p",), ("h1", "h2", "h3", "h4", "h5", "h6"), ("ul", "ol", "dl", "menu"), ("li", "dt", "dd"), ("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"),
    ("nav",), ("aside",), ("header", "hgroup"), ("footer", "address"), ("form", "fieldset", "dialog", "button", "label"), ("blockquote", "pre", "figure", "figcaption", "details", "summary"), ("html", "head", "body"),
)
GROUP = {t: i for i, g in enumerate(TAG_GROUPS) for t in g}
HEADINGS = set(TAG_GROUPS[3])
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
CONTAINERS = {"div", "article", "section", "main", "aside", "nav", "header", "footer", "form", "body", "html", "table", "td", "th", "ul", "ol", "blockquote", "figure", "details", "fieldset", "dialog"}
TOKEN_GROUPS = (
    {"nav", "navbar", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc", "topbar", "tabs", "navigation", "links"},
    {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner", "adsense", "adslot", "teaser"},
    {"header", "footer", "foot", "masthead", "copyright", "legal", "colophon", "site", "logo", "bottom"},
    {"sidebar", "side", "aside", "widget", "widgets", "related", "recommended", "trending", "popular", "rail", "more"},
    {"cookie", "cookies", "notice", "consent", "gdpr", "alert", "popup", "modal", "overlay", "paywall", "message", "warning", "privacy", "hidden", "none"},
    {"comment", "comments", "reply", "replies", "disqus", "respond", "discussion", "commentlist", "thread", "reader", "readers", "response", "responses"},
    {"form", "subscribe", "newsletter", "signup", "login", "search", "share", "social", "sharing", "contact", "register", "follow"},
    {"article", "content", "main", "post", "entry", "story", "body", "text", "articlebody", "prose", "maincontent"},
)
#: Elements deeper than this stay on this level, as in browsers.
MOST_DEEP = 512
N_TOKENS, N_TAGS = len(TOKEN_GROUPS), len(TAG_GROUPS)
SECTIONING = (0, 7, 8, 9, 10, 11)  # tag groups that ancestors are asked for
MARKS = re.compile(r"[.,;:!?]")
N_FEATURES = 14 + N_TAGS + 2 * N_TOKENS + len(SECTIONING)


class Markup:
    """The tags of a page, one after the other. Every search that fails once is not made again."""

    def __init__(self, source: str):
        self.source, self.quotes_close, self.sections_close = source, True, True

    def next(self, at: int) -> tuple[int, int, re.Match | None] | None:
        """Start, end and, of a tag, the match of the next markup from ``at`` on; None if only text is left."""
        source = self.source
        while (start := source.find("<", at)) >= 0:
            if source.startswith("<!--", start):
                end = source.find("-->", start + 4)
                return start, len(source) if end < 0 else end + 3, None
            first = source[start + 1 : start + 3]
            if not (first[:1] in ("!", "?") or first[:1].isascii() and first[:1].isalpha() or first[:1] == "/" and first[1:].isascii() and first[1:].isalpha()):
                at = start + 1
                continue
            close = source.find(">", start)
            if close < 0:
                return None
            if first[0] in "!?":
                end = -1
                if self.sections_close and source.startswith("<![CDATA[", start):
                    end = source.find("]]>", start)
                    self.sections_close = end >= 0
                return start, close + 1 if end < 0 else end + 3, None
            tag = TAG.match(source, start) if self.quotes_close else None
            if not tag:
                self.quotes_close = False
                tag = PLAIN_TAG.match(source, start)
            return start, tag.end(), tag
        return None

    def end_of(self, tag: str, at: int) -> int:
        """Where the closing tag of a raw element ends."""
        found = RAW_END[tag].search(self.source, at)
        end = self.source.find(">", found.end()) if found else -1
        return len(self.source) if end < 0 else end + 1


class Page:
    """Block elements of a page: tag, parent, attribute tokens, and the pieces of text in page order.

    ``truth`` holds the labels of generated layouts, the values of their attribute LABEL; it is not read from other pages.
    """

    def __init__(self, source: str, labelled: bool = False):
        self.tag, self.parent, self.groups, self.truth = ["html"], [-1], [0], [None]
        self.pieces: list[tuple[int, str, int]] = []  # node, text, characters in links
        stack, buffer, links, in_link = [("html", 0)], [], 0, 0
        markup, at, n = Markup(source), 0, len(source)

        def flush():
            nonlocal links
            if buffer:
                text = SPACES.sub(" ", entities.unescape("".join(buffer))).strip()
                if text:
                    node = next(i for _, i in reversed(stack) if i >= 0)
                    self.pieces.append((node, text, min(links, len(text))))
                buffer.clear()
                links = 0

        while at < n:
            found = markup.next(at)
            if not found:
                tail = source[at:]
                buffer.append(tail)
                links += len(tail) * bool(in_link)
                break
            start, end, m = found
            if start > at:
                part = source[at:start]
                buffer.append(part)
                links += len(part) * bool(in_link)
            at = end
            if m is None:
                continue
            tag, closing = m[2].lower(), m[1]
            if tag in RAW:
                if not closing and not m[3].endswith("/"):
                    at = markup.end_of(tag, at)
                    if tag != "title":
                        buffer.append(" ")
                continue
            if tag in VOID or tag not in GROUP:
                if tag == "a":
                    in_link = 0 if closing else 1
                elif tag == "hr":
                    flush()
                elif tag in ("br", "img"):
                    buffer.append(" ")
                continue
            flush()
            if closing:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
                    if stack[k][0] in CONTAINERS and tag not in CONTAINERS:
                        break
                continue
            closes = ("p", *HEADINGS) if tag in HEADINGS or tag not in CLOSED_BY else CLOSED_BY[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in closes:
                    del stack[k:]
                    break
                if stack[k][0] in CONTAINERS and not (stack[k][0] in closes):
                    break
            in_link = 0
            if tag in ("html", "head", "body"):
                continue
            self.tag.append(tag)
            self.parent.append(stack[-1][1])
            bits, truth = 0, None
            if m[3].strip():
                for name, a, b, c in ATTRIBUTE.findall(m[3]):
                    name = name.lower()
                    if name in ("class", "id", "role", "style", "aria-label", "itemprop"):
                        for t in TOKENS.findall(a or b or c):
                            bits |= BITS.get(t.lower(), 0)
                    elif name == "hidden":
                        bits |= BITS["hidden"]
                    elif labelled and name == LABEL:
                        truth = int(a)
            self.groups.append(bits)
            self.truth.append(truth)
            if len(stack) < MOST_DEEP:
                stack.append((tag, len(self.tag) - 1))
        flush()

    def features(self) -> np.ndarray:
        n = len(self.tag)
        size, link, marks, pieces, first = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
        own = [0] * n
        total = 0
        for node, text, in_links in self.pieces:
            if not pieces[node]:
                first[node] = total
            total += len(text)
            size[node] += len(text)
            own[node] += len(text)
            link[node] += in_links
            marks[node] += len(MARKS.findall(text))
            pieces[node] += 1
        children, index = [0] * n, [0] * n
        for i in range(1, n):
            p = self.parent[i]
            index[i] = children[p]
            children[p] += 1
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            if pieces[i]:
                first[p] = min(first[p], first[i]) if pieces[p] else first[i]
            size[p] += size[i]
            link[p] += link[i]
            marks[p] += marks[i]
            pieces[p] += pieces[i]
        x = np.zeros((n, N_FEATURES), np.float32)
        depth, above, inside = [0] * n, [0] * n, [0] * n
        before = [-1] * n
        last: dict[int, int] = {}
        for i in range(n):
            p = self.parent[i]
            if p >= 0:
                depth[i] = depth[p] + 1
                above[i] = above[p] | self.groups[p]
                inside[i] = inside[p] | 1 << GROUP[self.tag[p]]
                before[i] = last.get(p, -1)
                last[p] = i
        after = [-1] * n
        for i in range(n):
            if before[i] >= 0:
                after[before[i]] = i
        for i in range(n):
            p, s, b, a = self.parent[i], size[i], before[i], after[i]
            row = [
                depth[i], math.log1p(s), link[i] / s if s else 0.0, math.log1p(own[i]), math.log1p(children[i]), index[i], children[p] if p >= 0 else 1,
                math.log1p(s / pieces[i]) if pieces[i] else 0.0, 100 * marks[i] / s if s else 0.0, s / total if total else 0.0, first[i] / total if total else 0.0,
                link[b] / size[b] if b >= 0 and size[b] else 0.0, math.log1p(size[a]) if a >= 0 else 0.0, math.log1p(size[b]) if b >= 0 else 0.0,
            ]
            x[i, :14] = row
            x[i, 14 + GROUP[self.tag[i]]] = 1
            g, u = self.groups[i], above[i]
            for k in range(N_TOKENS):
                x[i, 14 + N_TAGS + k] = g >> k & 1
                x[i, 14 + N_TAGS + N_TOKENS + k] = u >> k & 1
            for k, t in enumerate(SECTIONING):
                x[i, 14 + N_TAGS + 2 * N_TOKENS + k] = inside[i] >> t & 1
        return x

    def decode(self, odds: np.ndarray, split_cost: float = 1.0) -> list[str]:
        """Best consistent choice of keep, drop or split for each node; the texts of what is kept."""
        n = len(self.tag)
        if n == 1:  # no element at all: the text is all there is
            return [text for _, text, _ in self.pieces]
        keep, drop = np.minimum(0, odds), np.minimum(0, -odds)  # log-probabilities up to a small term
        keep, drop = keep - np.log1p(np.exp(-np.abs(odds))), drop - np.log1p(np.exp(-np.abs(odds)))
        own = [False] * n
        for node, _, _ in self.pieces:
            own[node] = True
        all_keep, all_drop, below = keep.tolist(), drop.tolist(), [0.0] * n
        best = [0.0] * n
        for i in range(n - 1, -1, -1):
            # a split node still decides on the text that it holds itself
            below[i] += -split_cost + (max(keep[i], drop[i]) if own[i] else 0.0)
            best[i] = max(all_keep[i], all_drop[i], below[i])
            p = self.parent[i]
            if p >= 0:
                all_keep[p] += all_keep[i]
                all_drop[p] += all_drop[i]
                below[p] += best[i]
        state = [0] * n  # 1 keep, -1 drop, 0 split
        for i in range(n):
            p = self.parent[i]
            if p >= 0 and state[p]:
                state[i] = state[p]
            elif below[i] >= max(all_keep[i], all_drop[i]):
                state[i] = 0
            else:
                state[i] = 1 if all_keep[i] > all_drop[i] else -1
        return [text for node, text, _ in self.pieces if state[node] > 0 or state[node] == 0 and odds[node] > 0]


BITS = {t: 1 << i for i, g in enumerate(TOKEN_GROUPS) for t in sorted(g)}


class Boosted:
    """Gradient-boosted regression trees for a binary outcome, on quantile bins."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = 0.25, least: int = 20, bins: int = 32):
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) for f in range(x.shape[1])]
        b = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
        self.depth, self.trees = depth, []
        p0 = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.start = math.log(p0 / (1 - p0))
        score = np.full(len(y), self.start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
            for level in range(depth):
                first, count = 2**level - 1, 2**level
                best = np.full(count, 1e-6)
                for f, c in enumerate(cuts):
                    k = (node - first) * (bins + 1) + b[:, f]
                    size = count * (bins + 1)
                    sums = [np.cumsum(np.bincount(k, v, size).reshape(count, -1), axis=1) for v in (g, h, np.ones(len(y)))]
                    (gl, hl, nl), (gt, ht, nt) = sums, [s[:, -1:] for s in sums]
                    gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                    gain[(nl < least) | (nt - nl < least)] = 0
                    gain[:, len(c) :] = 0
                    at = gain.argmax(axis=1)
                    won = gain[np.arange(count), at] > best
                    best[won] = gain[np.arange(count), at][won]
                    feature[first : first + count][won] = f
                    if len(c):
                        cut[first : first + count][won] = c[np.minimum(at[won], len(c) - 1)]
                node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
            leaf = node - (2**depth - 1)
            value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + 1)
            score += value[leaf]
            self.trees.append((feature, cut, value))

    def odds(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += value[node - (2**self.depth - 1)]
        return out


def layout(texts: list[str], phrases: list[str], rng: random.Random) -> str:
    """A generated page around ``texts``: data-truth is 1 for main text, 0 for the rest."""
    esc = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")
    phrase = lambda: esc(rng.choice(phrases))

    def box(truth: int | None, tags: tuple, names: tuple, inner: str, plain: float = 0.2) -> str:
        tag = rng.choice(tags)
        name = rng.choice(names) if rng.random() >= plain else rng.choice(("c1", "x-7", "col", "box", "wrap", "inner"))
        mark = "" if truth is None else f' {LABEL}="{truth}"'
        attr = "" if tag not in ("div", "section", "ul") and rng.random() < 0.5 else f' {rng.choice(("class", "id"))}="{name}"'
        return f"<{tag}{attr}{mark}>{inner}</{tag}>"

    link = lambda: f'<a href="/x">{" ".join(phrase().split()[: rng.randint(1, 6)])}</a>'
    links = lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(3, 9))) + "</ul>"
    lines = lambda k: "".join(f"<p>{phrase()}</p>" for _ in range(k))
    ad = lambda: box(0, ("div", "aside", "section"), ("ad", "advert", "sponsored", "promo-box", "ad-slot banner"), rng.choice((phrase(), lines(1), link())))
    form = lambda: box(0, ("form", "form", "div"), ("newsletter", "subscribe", "search-form", "login"), f"<label>{phrase()}</label><input type=text><button>{phrase()}</button>")
    body, k = [f"<h1>{esc(texts[0])}</h1>"] if texts else [], 0
    for t in texts[1:]:
        kind = rng.random()
        body.append(f"<p>{esc(t)}</p>" if kind < 0.75 else f"<{(g := rng.choice(('h2', 'h3')))}>{esc(t)}</{g}>" if kind < 0.82 else f"<ul><li>{esc(t)}</li></ul>" if kind < 0.9 else f"<blockquote>{esc(t)}</blockquote>" if kind < 0.95 else f"<table><tr><td>{esc(t)}</td></tr></table>")
        k += 1
        if rng.random() < 0.05:
            body.append(rng.choice((ad, form))())
    marked = [x if LABEL in x[:300].split(">")[0] else re.sub(r"^<(\w+)", rf'<\1 {LABEL}="1"', x) for x in body]
    if rng.random() < 0.4:  # paragraphs in a block of their own
        at = rng.randint(0, min(2, len(marked)))
        marked = [*marked[:at], "<div>", *marked[at:], "</div>"]
    names = ("content", "post", "entry-content", "story", "article-body", "main")
    main = box(None, ("article", "article", "main", "div", "div", "section"), names, "".join(marked), plain=0.35)
    comment = lambda: box(None, ("div", "li", "article"), ("comment", "comment-body", "reply"), f"<p>{phrase()}</p>" + f"<p>{phrase()} {phrase()}</p>" * rng.randint(0, 1))
    head = box(0, ("header", "div"), ("header", "site-header", "masthead", "top"), (f"<h2>{phrase()}</h2>" if rng.random() < 0.5 else f"<p>{phrase()}</p>") + (box(0, ("nav", "div", "ul"), ("nav", "menu", "navbar", "breadcrumb"), links()) if rng.random() < 0.5 else ""))
    parts = [
        (0.5, head), (0.8, box(0, ("nav", "nav", "div"), ("nav", "menu", "main-menu", "breadcrumbs"), links())), (0.4, box(0, ("div", "section", "aside"), ("cookie-notice", "notice", "consent", "alert", "gdpr-banner"), lines(rng.randint(1, 2)) + "<button>OK</button>" * rng.randint(0, 1))), (0.5, ad()),
        (1.0, main), (0.5, box(0, ("aside", "div"), ("sidebar", "widget", "related", "rail"), rng.choice((links, lambda: lines(2), lambda: f"<h3>{phrase()}</h3>" + links()))())), (0.3, form()),
        (0.4, box(0, ("section", "div", "ol", "aside"), ("comments", "comment-list", "responses", "discussion", "reader-comments"), f"<h3>{phrase()}</h3>" * rng.randint(0, 1) + "".join(comment() for _ in range(rng.randint(1, 5))))), (0.3, ad()), (0.8, box(0, ("footer", "footer", "div"), ("footer", "site-footer", "copyright", "legal"), rng.choice((phrase(), lines(rng.randint(1, 3)), links())))),
    ]
    if rng.random() < 0.08:  # nothing but the text
        return "<body>" + "".join(f'<p {LABEL}="1">{esc(t)}</p>' for t in texts) + "</body>"
    if rng.random() < 0.2:
        parts[4], parts[5] = parts[5], parts[4]
    inner = "".join(x for chance, x in parts if rng.random() < chance)
    return f"<html><head><title>{phrase()}</title></head><body>{box(None, ('div', 'main', 'section'), ('page', 'wrapper', 'container'), inner) if rng.random() < 0.5 else inner}</body></html>"


def node_truth(page: Page) -> list[int | None]:
    """Label of each node: its own mark or that of what encloses it; of unmarked nodes, what all below agree on."""
    n, down = len(page.tag), list(page.truth)
    for i in range(1, n):
        if down[i] is None:
            down[i] = down[page.parent[i]]
        elif down[page.parent[i]] == 0:
            down[i] = 0
    seen: list[set] = [set() for _ in range(n)]
    for i in range(n - 1, 0, -1):
        if down[i] is not None:
            seen[i].add(down[i])
        seen[page.parent[i]] |= seen[i]
    return [down[i] if down[i] is not None else next(iter(seen[i])) if len(seen[i]) == 1 else None for i in range(n)]


def train(pages: DataFrame, most: int = TRAIN_PAGES, seed: int = 5) -> Boosted:
    """Fit on at most ``most`` pages, those of the smallest hashes, laid into generated layouts."""
    long = F.length(F.coalesce("html", F.lit(""))) > TRAIN_CHARS
    rows = pages.where(F.length("html") > 0).select("page_id", long.alias("long"), F.xxhash64("page_id", F.lit(9)).alias("h"))
    rows = rows.orderBy("long", "h", "page_id").limit(most).select("page_id")
    got = pages.join(F.broadcast(rows), "page_id", "left_semi").select(F.substring("html", 1, TRAIN_CHARS).alias("html"))  # at most ``most`` ids
    got = sorted(r.html for r in got.distinct().orderBy("html").limit(most).collect())
    rng, texts = random.Random(seed), []
    known = [Page(h) for h in got]
    for p in known:
        texts.append([t for _, t, _ in p.pieces])
    phrases = [" ".join(t.split()[: rng.randint(2, 25)]) for own in texts for t in own[:40]] or ["Lorem ipsum dolor", "Sit amet", "All rights reserved 2020"]
    xs, ys = [], []
    for own in texts or [["Lorem ipsum dolor sit amet.", "Consectetur adipiscing elit, sed do."] * 4] * 20:
        for _ in range(VARIANTS):
            main = rng.sample(own, min(len(own), rng.randint(1, rng.choice((4, 10, 25)))))
            if rng.random() < 0.4:  # articles have short paragraphs, too
                main = [" ".join(t.split()[: rng.randint(6, 40)]) for t in main]
            page = Page(layout(main, phrases, rng), labelled=True)
            truth = node_truth(page)
            x = page.features()
            use = [i for i, t in enumerate(truth) if t is not None]
            xs.append(x[use])
            ys += [truth[i] for i in use]
    for p in known:  # sampled pages, where their own tags say what is what
        x = p.features()
        inside = x[:, 14 + N_TAGS + 2 * N_TOKENS :]
        tags = [GROUP[t] for t in p.tag]
        bad = np.array([t in (7, 8, 10, 11) for t in tags]) | (inside[:, [1, 2, 4, 5]] > 0).any(axis=1)
        good = ~bad & ((np.array(tags) == 0) | (inside[:, 0] > 0))
        if good.any():
            use = np.flatnonzero(good | bad)
            xs.append(x[use])
            ys += good[use].astype(int).tolist()
    return Boosted(np.concatenate(xs), np.array(ys, float))


SCHEMA = "page_id long, url string, text string, n_chars long"


def main_text(pages: DataFrame, train_pages: int = TRAIN_PAGES, pages_at_once: int = 100) -> DataFrame:
    """page_id, url, text, n_chars of each row of ``pages`` (page_id, url, html)."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    model = train(pages, train_pages)

    def step(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, pages_at_once):
                batch = whole.slice(i, pages_at_once)
                parsed = [Page(h or "") for h in batch.column("html").to_pylist()]
                x = [p.features() for p in parsed]
                odds = np.split(model.odds(np.concatenate(x)), np.cumsum([len(v) for v in x])[:-1])
                texts = ["\n".join(p.decode(o)) for p, o in zip(parsed, odds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return per_batch(pages, step, SCHEMA)
