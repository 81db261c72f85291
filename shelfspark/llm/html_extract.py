"""Main text of web pages by a tree-structured graphical model over their DOM.

Every block-level element is a node with a hidden state, content or not. Its own features (tag, words in class, id and
role, length and link share of its text, kinds of its ancestors, its share of the page) give a unary potential, and each edge a potential of
the states of parent and child, by the kind of the child. Sum-product messages pass from the leaves to the root and
back; they give the exact marginal of every node, and the text of nodes with a content marginal of at least one half is
the main text. The same messages give the gradient of the conditional likelihood, by which the weights are learned
from labelled pages: elements marked with ``data-content="1"`` or ``"0"``, valid for everything below. Without pages of
one's own, ``training_pages`` composes a bounded number of them from common page layouts.

Text: the pieces of text between the boundaries of block-level elements are the blocks. Character references are
decoded, white space inside a block (line breaks by ``br`` too) becomes one space, ends are trimmed, empty blocks go,
the others are joined by a line feed in page order. Nothing is cut or capped.

A class word says what an element is only as far as it can: ``html`` and ``body`` have none, names of a state
(``has-sidebar``, ``comments-open``, ``category-social``) are features apart, and an element with most of the page's
text that holds an article or a headline of the first level (a layout, a form around the page, an unclosed header) hands
nothing down.

A null or empty page has an empty text. Broken markup does not fail: open elements end with their parent, an end tag
without a start is ignored, an unfinished tag or comment ends with the page.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterable
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML elements by their role in the tree.
BLOCKS = frozenset(
    "html head title body div nav header footer main article section aside form ul ol li dl dt dd table thead tbody "
    "tfoot tr td th caption p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption address details summary dialog menu "
    "fieldset legend label button select option textarea noscript center hgroup search".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template svg annotation annotation-xml iframe object canvas audio video".split())
#: An opening element of the key ends open elements of these kinds, up to one of the kinds in ``SCOPE``.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "body": ("head", "title"),
}
SCOPE = frozenset("ul ol dl table menu select html body div article section main aside nav form".split())
NO_P_INSIDE = BLOCKS - frozenset("label button select option textarea noscript".split())

# A quote opens a value only right behind "=".
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=\s*[^\s>\"'][^\s>]*|=)*+)>")
_LETTER = re.compile("[a-zA-Z]")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"([\w:-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Page:
    """Parallel lists over nodes, parents before children, and the text runs in page order."""

    __slots__ = ("attributes", "linked", "parents", "runs", "tags")

    def __init__(self):
        self.tags, self.parents, self.attributes = ["#root"], [-1], [""]
        self.runs: list[tuple[int, str]] = []
        self.linked: dict[int, int] = {}


def parse(source: str) -> Page:
    page = Page()
    open_nodes, links, parts = [0], 0, []
    at, size = 0, len(source)

    def flush():
        if parts:
            text = "".join(parts)
            parts.clear()
            if not text.isspace():
                page.runs.append((open_nodes[-1], text))

    while at < size:
        less = source.find("<", at)
        if less < 0:
            less = size
        if less > at:
            text = source[at:less]
            parts.append(text)
            if links and not text.isspace():
                node = open_nodes[-1]
                page.linked[node] = page.linked.get(node, 0) + len(text)
        if less == size:
            break
        if source.startswith("<!--", less):
            end = source.find("-->", less + 2)  # "<!-->" and "<!--->" are whole comments
            at = size if end < 0 else end + 3
            continue
        ended = source.startswith("</", less) and less + 2 < size and not _LETTER.match(source, less + 2)
        if ended or source[less + 1 : less + 2] in ("!", "?"):
            end = source.find(">", less)
            at = size if end < 0 else end + 1
            continue
        m = _TAG.match(source, less) or _LOOSE.match(source, less)
        if not m:
            if _LETTER.match(source, less + 1) or source.startswith("</", less):
                break  # an unfinished tag
            parts.append("<")
            at = less + 1
            continue
        at = m.end()
        closing, tag = m[1], m[2].lower()
        if tag in RAW:
            if not closing and (tag in ("script", "style") or not m[3].endswith("/")):
                end = re.compile(f"</{re.escape(tag)}\\b[^>]*>", re.I).search(source, at)
                at = end.end() if end else size
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            parts.append(" ")
            continue
        if tag == "a":
            links = max(0, links + (-1 if closing else 1))
            continue
        if tag not in BLOCKS:
            continue
        if closing:
            if tag == "p" and "p" not in (page.tags[n] for n in open_nodes):
                flush()
                continue
            for k in range(len(open_nodes) - 1, 0, -1):
                if page.tags[open_nodes[k]] == tag:
                    flush()
                    del open_nodes[k:]
                    break
                # The end of an inner element does not end an outer structure.
                if tag in ("p", "li", "dt", "dd", "td", "th", "tr", "label", "option") and page.tags[open_nodes[k]] in SCOPE:
                    break
            links = 0 if tag in SCOPE else links
            continue
        flush()
        if tag in NO_P_INSIDE and page.tags[open_nodes[-1]] == "p":
            open_nodes.pop()
        elif tag in NO_P_INSIDE:
            for k in range(len(open_nodes) - 1, 0, -1):
                if page.tags[open_nodes[k]] == "p":
                    del open_nodes[k:]
                    break
                if page.tags[open_nodes[k]] in SCOPE:
                    break
        for k in range(len(open_nodes) - 1, 0, -1):
            kind = page.tags[open_nodes[k]]
            if kind in CLOSES.get(tag, ()):
                del open_nodes[k:]
            elif kind in SCOPE:
                break
        page.tags.append(tag)
        page.parents.append(open_nodes[-1])
        page.attributes.append(m[3])
        open_nodes.append(len(page.tags) - 1)
    flush()
    return page


# --- features and messages -------------------------------------------------------------------------------------

_STRUCTURE = ("nav", "header", "footer", "aside", "form", "article", "main", "head", "ul", "table", "dialog", "figure")


# First and last words of class names that tell a state, a layout or a topic, not what the element is.
_STATE_FIRST = frozenset("has no with without category tag status type format js layout".split())
_STATE_LAST = frozenset("open closed enabled disabled fixed free on off".split())


@lru_cache(4096)
def _attribute_words(attributes: str) -> tuple[tuple[str, ...], str | None]:
    """Words of names and the label, if any. Words of a state follow ``~``, all but the last of another name ``^``."""
    words, label = [], None
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            for token in value.split():
                parts = [w.lower() for w in _WORDS.findall(token)]
                state = len(parts) > 1 and (parts[0] in _STATE_FIRST or parts[-1] in _STATE_LAST)
                words += ["~" + w for w in parts] if state else ["^" + w for w in parts[:-1]] + parts[-1:]
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (
            name == "style" and "display:none" in value.replace(" ", "")
        ):
            words.append("#hidden")
        elif name == "data-content":
            label = value
    return tuple(dict.fromkeys(words)), label


def node_features(page: Page) -> list[list[str]]:
    n = len(page.tags)
    length, words = [0] * n, [0] * n
    sentence = [False] * n
    for node, text in page.runs:
        length[node] += len(text)
        words[node] += text.count(" ") + 1
        sentence[node] = sentence[node] or text.rstrip()[-1:] in ".!?…\"”’:"
    named = [_attribute_words(a)[0] if t not in _ROOTS else () for t, a in zip(page.tags, page.attributes, strict=True)]
    below, direct, landmark, article = list(length), [0] * n, [False] * n, False
    for i in range(n - 1, 0, -1):
        parent, tag = page.parents[i], page.tags[i]
        below[parent] += below[i]
        direct[parent] += length[i] if tag == "p" else 0
        if tag in ("h1", "main", "article") and not _marked(named[i]):
            landmark[parent] = True
            article = article or tag != "h1"
        landmark[parent] = landmark[parent] or landmark[i]
    around: list[frozenset[str]] = [frozenset()] * n
    out = []
    for i in range(n):
        tag, above = page.tags[i], around[page.parents[i]] if i else frozenset()
        wide = 2 * below[i] > below[0]
        outer = wide and landmark[i]
        own = {tag} if tag in _STRUCTURE else set()
        if tag in _ROOTS:
            features = ["bias", f"tag={tag}", f"paragraphs={min(3, 4 * direct[i] // max(1, below[0]))}:{article}"]
        elif outer:
            features = ["bias", f"outer:tag={tag}", *(f"outer:word={w}" for w in named[i])]
            own &= {"article", "main"}
        else:
            features = ["bias", f"tag={tag}", *(f"word={w}" for w in named[i])]
            own |= _marked(named[i])
            if wide:
                features += [f"wide:tag={tag}", *(f"wide:word={w}" for w in named[i])]
                own |= {f"wide:{w}" for w in own}
        features += [f"in={k}" for k in above]
        around[i] = above | own
        if "article" not in around[i] and "main" not in around[i]:
            features.append(f"outside={article}:{page.tags[page.parents[i]] in _ROOTS}")
        if length[i]:
            share = page.linked.get(i, 0) / length[i]
            features.append(f"words={min(6, words[i].bit_length())}")
            features.append("linked=" + ("all" if share > 0.8 else "much" if share > 0.3 else "little"))
            features.append(f"ends={sentence[i]}")
            features.append(f"{tag}:words={min(6, words[i].bit_length())}")
        out.append(features)
    return out


def _marked(words: tuple[str, ...]) -> set[str]:
    return {w for w in words if w.removeprefix("^") in _MARKERS}


_ROOTS = frozenset(("#root", "html", "body"))
#: Words of class, id or role that are remembered for the elements below.
_MARKERS = frozenset(
    "ad ads advert advertisement sponsored promo banner cookie consent notice alert popup modal newsletter subscribe "
    "signup nav navigation menu breadcrumb breadcrumbs sidebar widget related share social comment comments reply "
    "replies respond discussion footer header masthead copyright legal form login search contentinfo complementary "
    "disclaimer toolbar pagination tags hidden".split()
)


def _kind(tag: str) -> str:
    return tag if tag in ("p", "li", "div", "section", "article", "td") else "heading" if tag[0] == "h" and tag[1:].isdigit() else "other"


def _soft(a: float, b: float) -> float:
    """log(e^a + e^b)"""
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


class TreeModel:
    def __init__(self, weights: dict[str, float] | None = None):
        self.weights = weights or {}

    def _edges(self, page: Page) -> list[tuple[float, float]]:
        """Log potentials of a child in its parent's state: both outside, both content; unequal states have 0."""
        w = self.weights.get
        same = {}
        for tag in set(page.tags):
            k = _kind(tag)
            same[tag] = (w(f"edge0:{k}", 0.0), w(f"edge1:{k}", 0.0))
        return [same[t] for t in page.tags]

    def messages(self, page: Page, unary: list[float]):
        """Marginals of content, and for each node the joint marginals with its parent: (both outside, both content)."""
        n, edges = len(unary), self._edges(page)
        belief = list(unary)  # log odds from below
        up = [0.0] * n
        for i in range(n - 1, 0, -1):
            e0, e1 = edges[i]
            up[i] = _soft(0.0, e1 + belief[i]) - _soft(e0, belief[i])
            belief[page.parents[i]] += up[i]
        total = list(belief)
        joint = [(0.0, 0.0)] * n
        for i in range(1, n):
            e0, e1 = edges[i]
            rest = total[page.parents[i]] - up[i]  # the parent without this child
            total[i] = belief[i] + _soft(0.0, rest + e1) - _soft(e0, rest)
            logs = (e0, belief[i], rest, rest + belief[i] + e1)
            top = max(logs)
            z = sum(math.exp(x - top) for x in logs)
            joint[i] = (math.exp(logs[0] - top) / z, math.exp(logs[3] - top) / z)
        return [1 / (1 + math.exp(-max(-500.0, min(500.0, x)))) for x in total], joint

    def unary(self, features: list[list[str]]) -> list[float]:
        w = self.weights.get
        return [sum(w(f, 0.0) for f in fs) for fs in features]

    def marginals(self, page: Page) -> list[float]:
        return self.messages(page, self.unary(node_features(page)))[0]

    def fit(self, pages: Iterable[str], rounds: int = 25, rate: float = 0.3, decay: float = 1e-3) -> TreeModel:
        """Adaptive gradient steps on the log likelihood of the labels, a page at a time."""
        prepared = []
        for source in pages:
            page = parse(source)
            labels = [0] * len(page.tags)
            for i in range(1, len(labels)):
                mark = _attribute_words(page.attributes[i])[1]
                labels[i] = labels[page.parents[i]] if mark is None else int(mark)
            prepared.append((page, node_features(page), labels))
        square: dict[str, float] = {}
        for _ in range(rounds):
            for page, features, labels in prepared:
                marginal, joint = self.messages(page, self.unary(features))
                gradient: dict[str, float] = {}
                for i, fs in enumerate(features):
                    d = labels[i] - marginal[i]
                    for f in fs:
                        gradient[f] = gradient.get(f, 0.0) + d
                    if i:
                        both = labels[i], labels[page.parents[i]]
                        k = _kind(page.tags[i])
                        for name, seen, expected in (
                            (f"edge0:{k}", both == (0, 0), joint[i][0]),
                            (f"edge1:{k}", both == (1, 1), joint[i][1]),
                        ):
                            gradient[name] = gradient.get(name, 0.0) + seen - expected
                for f, g in gradient.items():
                    old = self.weights.get(f, 0.0)
                    g -= decay * old
                    square[f] = square.get(f, 1e-6) + g * g
                    self.weights[f] = old + rate * g / math.sqrt(square[f])
        return self

    def main_text(self, source: str | None) -> str:
        if not source:
            return ""
        page = parse(source)
        marginal = self.marginals(page)
        blocks = (
            " ".join(html.unescape(text).split()) for node, text in page.runs if marginal[node] >= 0.5
        )
        return "\n".join(b for b in blocks if b)


# --- labelled pages --------------------------------------------------------------------------------------------

_SYLLABLES = "ta re mi so lan der qui ver ton al es or un ka po ne sil ba cor du".split()


def _words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(_SYLLABLES, k=rng.randint(1, 3))) for _ in range(n))


def _sentences(rng: random.Random, n: int) -> str:
    return " ".join(_words(rng, rng.randint(1, 18)).capitalize() + rng.choice((".", ".", ".", "!", "?")) for _ in range(n))


def training_pages(n: int = 480, seed: int = 11) -> list[str]:
    """Pages in the layouts of blogs, news sites and plain articles, with the article marked as content; names of other
    parts occur in the class words of elements around it too."""
    rng = random.Random(seed)
    some = lambda *parts: [p() for p in parts if rng.random() < 0.6]

    def links(k: int) -> str:
        return "".join(f'<li><a href="/{i}">{_words(rng, rng.randint(1, 2))}</a></li>' for i in range(k))

    def named(*words: str) -> str:
        return f'{rng.choice(("class", "id"))}="{rng.choice(words)}"'

    def nav() -> str:
        tag, extra = rng.choice((("nav", ""), ("nav", " class=main-nav"), ("div", named("nav", "menu", "navigation", "top-menu", "breadcrumb"))))
        return f'<{tag} {extra} data-content="0"><ul>{links(rng.randint(2, 9))}</ul></{tag}>'

    def header() -> str:
        tag, extra = rng.choice((("header", ""), ("div", named("header", "site-header", "masthead", "page-header", "banner"))))
        site = rng.choice((f"<h1>{_words(rng, 2)}</h1>", f"<div>{_words(rng, 3)}</div>", f"<p>{_words(rng, 6)}</p>", _words(rng, 2)))
        return f'<{tag} {extra} data-content="0">{site}{nav() if rng.random() < 0.5 else ""}</{tag}>'

    def footer() -> str:
        tag, extra = rng.choice((("footer", ""), ("footer", ""), ("div", named("footer", "site-footer", "copyright", "legal", "contentinfo"))))
        inner = rng.choice((f"&copy; {_words(rng, 4)} &middot; {_sentences(rng, 2)}", f"<p>{_sentences(rng, rng.randint(1, 3))}</p>", f"<ul>{links(4)}</ul><p>{_words(rng, 6)}</p>"))
        return f'<{tag} {extra} data-content="0">{inner}</{tag}>'

    def advert() -> str:
        extra = named("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "ad-banner", "promo-box", "sponsored-links")
        return f'<div {extra} data-content="0">{rng.choice((_sentences(rng, rng.randint(1, 3)), f"<p>{_sentences(rng, 2)}</p>", f"<p>{_words(rng, 4)}</p>"))}</div>'

    def notice() -> str:
        extra = named("cookie", "cookie-notice", "notice", "consent", "alert", "popup", "modal", "disclaimer", "gdpr-banner", "newsletter", "subscribe")
        return f'<{(t := rng.choice(("div", "div", "section", "aside", "dialog")))} {extra} data-content="0"><p>{_sentences(rng, rng.randint(1, 4))}</p>{"<button>" + _words(rng, 1) + "</button>" if rng.random() < 0.6 else ""}</{t}>'

    def sidebar() -> str:
        tag, extra = rng.choice((("aside", ""), ("aside", ""), ("div", named("sidebar", "side-bar", "widget", "related", "complementary", "social", "share", "social-links", "share-buttons", "related-posts", "sidebar-left", "widget-area"))))
        return f'<{tag} {extra} data-content="0"><h3>{_words(rng, 2)}</h3>{rng.choice((f"<ul>{links(5)}</ul>", f"<p>{_sentences(rng, rng.randint(1, 4))}</p>"))}</{tag}>'

    def form() -> str:
        extra = rng.choice(("", named("search", "login", "signup", "contact-form")))
        return f'<form {extra} data-content="0"><label>{_words(rng, 2)}</label><input name="q"><select><option>{_words(rng, 1)}<option>{_words(rng, 1)}</select><textarea>{_words(rng, 3)}</textarea><button>{_words(rng, 1)}</button>{"<p>" + _sentences(rng, 1) + "</p>" if rng.random() < 0.4 else ""}</form>'

    def comments() -> str:
        one = lambda: rng.choice((
            f'<li class="comment"><b>{_words(rng, 1)}</b><p>{_sentences(rng, rng.randint(1, 5))}</p></li>',
            f'<div class="comment"><p>{_sentences(rng, rng.randint(1, 5))}</p></div>',
            f'<article class="comment"><p>{_sentences(rng, rng.randint(1, 5))}</p></article>',
            f"<p>{_sentences(rng, rng.randint(1, 5))}</p>",
        ))
        tag = rng.choice(("section", "div", "div", "ol", "ul"))
        extra = named("comments", "comment-list", "comments-area", "reader-comments", "discussion", "replies", "responses comments", "respond")
        return f'<{tag} {extra} data-content="0"><h2>{_words(rng, 2)}</h2>{"".join(one() for _ in range(rng.choice((1, 2, 3, 5, 12))))}</{tag}>'

    def paragraph() -> str:
        text = _sentences(rng, rng.choice((1, 1, 2, 3, 5, 8, 12)))
        return rng.choice((
            f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>", f"<p>{text} <a href=x>{_words(rng, 2)}</a> {_sentences(rng, 1)}</p>",
            f"<p>{_words(rng, rng.randint(1, 4))}</p>", f"<p>{_words(rng, 30)}", f"<h2>{_words(rng, 3)}</h2>", f"<h3>{_words(rng, 4)}.</h3>",
            f"<ul><li>{_words(rng, 5)}</li><li>{_sentences(rng, 1)}</li></ul>", f"<blockquote>{text}</blockquote>", f"<pre>{_words(rng, 8)}</pre>",
            f"<table><tr><td>{_words(rng, 2)}</td><td>{_words(rng, 1)}</td></tr></table>", f"<figure><figcaption>{_words(rng, 6)}</figcaption></figure>",
            f"<div>{text}</div>", f"<section><h2>{_words(rng, 2)}</h2><p>{text}</p></section>",
        ))

    def layout() -> str:
        """Names of elements around an article: plain ones, states, and words of other parts with a word behind."""
        part = rng.choice(sorted(_MARKERS - {"hidden"}))
        other = rng.choice(("history", "area", "page", "story", _words(rng, 1)))
        return rng.choice((
            "wrapper", "container", "page", "layout", "site", "content-area", "home", f"has-{part}", f"no-{part}", f"{part}-open",
            f"right-{part}", f"{part}-{other}", f"content with-{part}", f"page {part}-{other}", f"content-area has-{part}",
        ))

    def around(inner: str) -> str:
        return rng.choice((
            f'<div class="{layout()}">{inner}</div>', f'<div id="{layout()}">{inner}</div>', f'<section class="{layout()}">{inner}</section>',
            f'<form method="post" id="aspnetForm">{inner}</form>', f"<form action=/>{inner}</form>",
        ))

    def article() -> str:
        tag, extra = rng.choice((
            ("article", ""), ("article", ""), ("article", named("post", "entry", "story")), ("main", ""),
            ("article", f'class="post type-post {layout()} comments-{rng.choice(("open", "closed"))}"'), ("main", f"class={layout().split()[0]}"),
            ("div", f'class="{layout()}"'), ("div", f'class="content {layout()}"'),
            ("div", named("content", "article", "post-content", "entry-content", "main-content", "story-body", "text", "article-body")),
        ))
        title = f"<h1>{_words(rng, rng.randint(1, 9))}{rng.choice(('', '.'))}</h1>"
        title = rng.choice((title, title, title, f"<header>{title}</header>", ""))
        parts = [paragraph() for _ in range(rng.choice((1, 2, 4, 7, 12)))]
        for extra_part in some(advert, lambda: "", form if rng.random() < 0.3 else lambda: ""):
            parts.insert(rng.randint(0, len(parts)), extra_part)
        body = title + "".join(parts)
        if rng.random() < 0.2:
            body = around(body)
        if rng.random() < 0.25:
            body += sidebar()
        if rng.random() < 0.25:
            body += comments()
        return f'<{tag} {extra} data-content="1">{body}</{tag}>'

    pages = []
    for _ in range(n):
        before = some(header, nav, notice, advert, form if rng.random() < 0.3 else lambda: "")
        after = some(comments, sidebar, footer, notice if rng.random() < 0.3 else lambda: "")
        rng.shuffle(before)
        middle = article() if rng.random() < 0.7 else f"<main>{article()}</main>" if rng.random() < 0.5 else f'<div {named("wrapper", "container", "page", "layout")}>{article()}{sidebar()}</div>'
        loose = rng.random() < 0.2  # paragraphs directly in the body
        if loose:
            middle = "".join(paragraph() for _ in range(rng.choice((2, 3, 5, 9))))
            middle = f"<h1>{_words(rng, 4)}</h1>{middle}" if rng.random() < 0.5 else middle
        elif rng.random() < 0.25:
            middle = around(middle)
        inner = f"{''.join(before)}{middle}{''.join(after)}"
        if not loose and rng.random() < 0.25:
            inner = around(inner)
        names = f' class="{layout()} {layout()}"' if rng.random() < 0.5 else ""
        pages.append(
            f"<!DOCTYPE html><html{names if rng.random() < 0.2 else ''}><head><title>{_words(rng, 4)}</title><style>p{{}}</style></head>"
            f"<body{names}{' data-content=1' if loose else ''}>{inner}{'</body></html>' if rng.random() < 0.8 else ''}"
        )
    return pages


def fit_tree_model(pages: Iterable[str] | None = None) -> TreeModel:
    return TreeModel().fit(training_pages() if pages is None else pages)


def main_texts(pages: DataFrame, model: TreeModel, html_col: str = "html") -> DataFrame:
    """All columns of ``pages`` with ``text string``, empty if none, and ``n_chars long``, its code points."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def extract(sources: pd.Series) -> pd.Series:
        return pd.Series([shared.value.main_text(s) for s in sources], dtype=object)

    return pages.withColumn("text", extract(F.col(html_col))).withColumn("n_chars", F.char_length("text").cast("long"))
