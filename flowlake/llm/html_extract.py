"""HTML extraction by a recurrent block labeller (numpy bidirectional LSTM).

A page is read once by a tolerant tag scanner and becomes a sequence of leaf blocks: runs
of text between block-level tags, with character references decoded and white space
made single.  Each block carries its tag path (tags, classes, ids, roles of its
ancestors) and its words, both hashed into fixed-length vectors.  A bidirectional
LSTM reads the page's blocks in order, so each one is judged with the context of the
whole page, and a logistic layer says main text or not.

Training (``fit``): a bounded, hashed draw of pages of at most ``max_chars`` is labelled
by what their markup says (article or main, against navigation, headers, footers,
asides, forms, adverts, notices, comments by tag, class, id or role).  The texts of
these pages are also set into generated page frames, so that frames rare in the draw
are learned too.  Every page is learned a second time with most of its names, and many of its
telling tags, replaced by others that say nothing, so that text, links and place have to
decide: what looks like main text in a frame of unknown names is kept.  The drawn pages are all that
reaches the driver.  Reading is linear in the page: an element adds its hashed features to its
parent's, and no block copies the path above it.

Null html: no blocks, empty text.  Pages are never cut; a page without main text gives
an empty string.  Repeated rows are extracted each.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH_SIZE = 512
WORD_SIZE = 32
EXTRA = 6
INPUT = PATH_SIZE + WORD_SIZE + EXTRA
HIDDEN = 24

# Element names of HTML by their role here.
SILENT = {"script", "style", "noscript", "template", "svg", "iframe", "object", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details",
         "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
         "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol",
         "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "textarea", "tfoot",
         "th", "thead", "title", "tr", "ul"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"table", "ul", "ol", "dl", "select", "div", "article", "section", "body", "html"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg(?=[\s/])(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>"
    r"|<(?P<raw>script|style)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>", re.S | re.I)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[a-z]+|[0-9]+")


#: Elements whose text counts for nothing where they are closed; unclosed ones are ordinary tags.
_WHOLE = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in sorted(SILENT - {"script", "style"})}

# What the markup says of an element or one around it.
_FRAME, _MAIN, _ASIDE = 1, 2, 4


@dataclass
class Block:
    text: str
    path: tuple                           # hashed features (a bit each) and what the markup says
    linked: int = 0                       # characters inside links


@dataclass
class _Element:
    tag: str
    features: int                         # with those of all elements around it
    says: int
    leaf: str                             # nearest block-level tag, as it is to be learned
    links: int
    block_at: int                         # place of the nearest block-level element


def _feature(token: str) -> int:
    return 1 << crc32(token.encode()) % PATH_SIZE


@dataclass
class _Reader:
    called: Callable[[str], str] | None = None      # another name for a tag or a ``.name``, for training
    blocks: list[Block] = field(default_factory=list)
    stack: list[_Element] = field(default_factory=list)
    places: dict[str, list[int]] = field(default_factory=dict)     # of open elements, by tag
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                top = self.stack[-1] if self.stack else None
                path = (top.features | _feature("leaf " + top.leaf), top.says) if top else ()
                self.blocks.append(Block(text, path, min(self.linked, len(text))))
        self.parts, self.linked = [], 0

    def words(self, raw: str) -> None:
        if raw:
            text = entities.unescape(raw) if "&" in raw else raw
            self.parts.append(text)
            if self.stack and self.stack[-1].links:
                self.linked += len(text.strip())

    def opened(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        if tag in BLOCK:
            self.flush()
            self.close_inside({"p"} | CLOSES.get(tag, set()), tag)
        if tag in VOID:
            return
        names = []
        if "=" in attrs:
            for m in _NAMED.finditer(attrs):
                names += _PARTS.findall((m[2] or m[3] or m[4] or "").lower())
        above = self.stack[-1] if self.stack else _Element("", 0, 0, "", 0, -1)
        called = self.called or (lambda token: token)
        features = above.features
        if tag not in ("html", "b", "i", "em"):
            for token in (tag, *(f".{n}" for n in names)):
                features |= _feature(called(token))
        framed = tag in MAIN_TAGS
        says = (above.says | _FRAME * framed | _MAIN * (framed or "main" in names)
                | _ASIDE * (tag in ASIDE_TAGS or not ASIDE_NAMES.isdisjoint(names)))
        here = len(self.stack)
        self.stack.append(_Element(tag, features, says, called(tag) if tag in BLOCK else above.leaf,
                                   above.links + (tag == "a"), here if tag in BLOCK else above.block_at))
        self.places.setdefault(tag, []).append(here)

    def last(self, tags: set[str]) -> int:
        """Place of the innermost open element of these tags, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def cut(self, place: int) -> None:
        for e in reversed(self.stack[place:]):
            self.places[e.tag].pop()
        del self.stack[place:]

    def close_inside(self, tags: set[str], opening: str) -> None:
        """End tags that HTML lets a page leave out."""
        place = self.last(tags)
        if place > self.last(SCOPE - tags - ({"table"} if opening == "tr" else set())):
            self.cut(place)

    def closed(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        place = self.last({tag})
        if place >= 0 and (tag in BLOCK or self.stack[-1].block_at < place):  # else a stray inline end tag
            self.cut(place)


def read_blocks(page: str | None, called: Callable[[str], str] | None = None) -> list[Block]:
    """Leaf blocks of a page in order."""
    r, at = _Reader(called), 0
    page = page or ""
    unclosed: set[str] = set()
    while m := _TOKEN.search(page, at):
        r.words(page[at:m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag:
            tag = tag.lower()
            if m["end"] or m["end2"]:
                r.closed(tag)
                continue
            if tag in _WHOLE and tag not in unclosed:
                end = _WHOLE[tag].search(page, at)
                if end:
                    at = end.end()
                    continue
                unclosed.add(tag)  # no later one is closed either
            r.opened(tag, m["attrs"] if m["tag"] else m["attrs2"])
    r.words(page[at:])
    r.flush()
    return r.blocks


# --- vectors -----------------------------------------------------------------

def _path_slots(path: tuple, known: dict) -> np.ndarray:
    features = path[0] if path else 1
    got = known.get(features)
    if got is None:
        got = np.array([k for k in range(PATH_SIZE) if features >> k & 1])
        if len(known) < 100_000:
            known[features] = got
    return got


def vectors(blocks: list[Block], known: dict) -> np.ndarray:
    x = np.zeros((len(blocks), INPUT), np.float32)
    for i, b in enumerate(blocks):
        x[i, _path_slots(b.path, known)] = 1
        words = b.text.lower().split()
        for w in words:
            x[i, PATH_SIZE + crc32(w.encode()) % WORD_SIZE] += 1
        x[i, PATH_SIZE:PATH_SIZE + WORD_SIZE] /= max(1, len(words))
        n = len(b.text)
        x[i, -EXTRA:] = (np.log1p(n) / 8, b.linked / n, len(words) / 40, b.text[-1] in ".!?:;\"'»”",
                         i == 0, i == len(blocks) - 1)
    return x


# --- the network -------------------------------------------------------------

def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class BiLSTM:
    """Two LSTMs (forward, backward) and a logistic layer over both."""
    w: list[np.ndarray]      # per direction (INPUT + HIDDEN, 4 * HIDDEN)
    b: list[np.ndarray]
    out: np.ndarray          # (2 * HIDDEN,)
    bias: np.ndarray         # (1,)

    @staticmethod
    def fresh(seed: int = 0) -> "BiLSTM":
        rng = np.random.default_rng(seed)
        b = np.zeros(4 * HIDDEN, np.float32)
        b[HIDDEN:2 * HIDDEN] = 1  # remember at first
        return BiLSTM([rng.normal(0, 0.15, (INPUT + HIDDEN, 4 * HIDDEN)).astype(np.float32) for _ in "fb"],
                      [b.copy(), b.copy()], rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32),
                      np.zeros(1, np.float32))

    def _pass(self, x: np.ndarray, mask: np.ndarray, side: int, keep: list | None) -> np.ndarray:
        """Hidden states (time, pages, HIDDEN); a masked step leaves the state as it is."""
        steps, pages, _ = x.shape
        h = np.zeros((pages, HIDDEN), np.float32)
        c = np.zeros_like(h)
        w, seen = self.w[side], x @ self.w[side][:INPUT] + self.b[side]
        out = np.empty((steps, pages, HIDDEN), np.float32)
        for t in (range(steps) if side == 0 else range(steps - 1, -1, -1)):
            z = seen[t] + h @ w[INPUT:]
            i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            on = mask[t][:, None]
            c1 = f * c + i * g
            s = np.tanh(c1)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, s))
            c, h = np.where(on, c1, c), np.where(on, o * s, h)
            out[t] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._pass(x, mask, 0, None), self._pass(x, mask, 1, None)], 2)
        return both @ self.out + self.bias

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        tapes: list[list] = [[], []]
        hidden = [self._pass(x, mask, s, tapes[s]) for s in (0, 1)]
        both = np.concatenate(hidden, 2)
        d = (_sigmoid(both @ self.out + self.bias) - y) * mask / max(1, mask.sum())
        grads_w, grads_b = [], []
        for s in (0, 1):
            top = d[..., None] * self.out[s * HIDDEN:(s + 1) * HIDDEN]
            w = self.w[s]
            gw, gb = np.zeros_like(w), np.zeros_like(self.b[s])
            dh = np.zeros((x.shape[1], HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t, h, c, i, f, o, g, th in reversed(tapes[s]):
                on = mask[t][:, None]
                dh = dh + top[t]
                live_h, live_c = np.where(on, dh, 0), np.where(on, dc, 0)
                dc1 = live_c + live_h * o * (1 - th * th)
                dz = np.concatenate([dc1 * g * i * (1 - i), dc1 * c * f * (1 - f),
                                     live_h * th * o * (1 - o), dc1 * i * (1 - g * g)], 1)
                gw[:INPUT] += x[t].T @ dz
                gw[INPUT:] += h.T @ dz
                gb += dz.sum(0)
                dh = np.where(on, dz @ w[INPUT:].T, dh)
                dc = np.where(on, dc1 * f, dc)
            grads_w.append(gw)
            grads_b.append(gb)
        return [*grads_w, *grads_b, (both * d[..., None]).sum((0, 1)), np.array([d.sum()], np.float32)]

    def params(self) -> list[np.ndarray]:
        return [*self.w, *self.b, self.out, self.bias]


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), INPUT), np.float32)
    mask = np.zeros((steps, len(pages)), bool)
    for k, p in enumerate(pages):
        x[:len(p), k], mask[:len(p), k] = p, True
    return x, mask


def train(pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 12, batch: int = 32,
          rate: float = 0.01, seed: int = 0) -> BiLSTM:
    """Adam on the logistic loss of every block of (vectors, labels) pages."""
    net, rng, step = BiLSTM.fresh(seed), np.random.default_rng(seed), 0
    pages = [p for p in pages if len(p[0])]
    m = [np.zeros_like(p) for p in net.params()]
    v = [np.zeros_like(p) for p in net.params()]
    for _ in range(epochs):
        order = sorted(rng.permutation(len(pages)), key=lambda k: len(pages[k][0]))
        starts = rng.permutation(range(0, len(order), batch))
        for s in starts:
            pick = [pages[k] for k in order[s:s + batch]]
            x, mask = padded([p for p, _ in pick])
            y = np.zeros(mask.shape, np.float32)
            for k, (_, lab) in enumerate(pick):
                y[:len(lab), k] = lab
            step += 1
            for p, g, mi, vi in zip(net.params(), net.gradients(x, mask, y), m, v):
                g = np.clip(g, -1, 1)
                mi += 0.1 * (g - mi)
                vi += 0.001 * (g * g - vi)
                p -= rate * (mi / (1 - 0.9 ** step)) / (np.sqrt(vi / (1 - 0.999 ** step)) + 1e-8)
    return net


# --- labels for training -----------------------------------------------------

# Markup that names a block's role.
MAIN_TAGS = {"article", "main"}
ASIDE_TAGS = {"nav", "header", "footer", "aside", "form", "head", "menu", "button", "select", "dialog", "label"}
ASIDE_NAMES = {"ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment",
               "comments", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "header", "menu",
               "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo", "related",
               "share", "sidebar", "social", "sponsor", "sponsored", "subscribe", "widget", "reply", "replies",
               "complementary", "discussion", "outbrain", "taboola", "pagination", "toolbar", "recommended"}

MENU_NAMES = {"breadcrumb", "breadcrumbs", "menu", "nav", "navbar", "navigation", "pagination", "toolbar"}


def markup_labels(blocks: list[Block]) -> np.ndarray:
    """1 for main text by the markup's own words."""
    says = [b.path[1] if b.path else 0 for b in blocks]
    framed = any(x & _FRAME for x in says)
    return np.array([(x & _MAIN > 0 or not framed) and not x & _ASIDE for x in says], np.float32)


def unnamed(seed: int) -> Callable[[str], str]:
    """Other names for most names of a page, and a plain ``div`` for many tags of main text and menus.

    Menus are shown by their links as well.  Often nothing but its name shows another block beside the
    main text, so those names stay."""
    rng, chosen = np.random.default_rng(seed), {}

    def called(token: str) -> str:
        if token not in chosen:
            name = token.removeprefix(".")
            aside = name in ASIDE_NAMES or token in ASIDE_TAGS
            rate = 0.7 if name in MENU_NAMES else 0 if aside else 0.8 if token != name else 0.5
            if rng.random() >= rate:
                chosen[token] = token
            elif token != name:
                chosen[token] = f".{rng.integers(1 << 30):x}"
            else:
                chosen[token] = "div" if aside or token in MAIN_TAGS else token
        return chosen[token]
    return called


def generated_pages(texts: list[str], count: int, seed: int = 0) -> list[str]:
    """Page frames of common kinds around given texts."""
    rng = np.random.default_rng(seed)
    pick = lambda n: [texts[int(i)] for i in rng.integers(0, len(texts), n)]
    esc = lambda s: s.replace("&", "&amp;").replace("<", "&lt;")
    short = lambda s: esc(" ".join(s.split()[:int(rng.integers(1, 6))]))
    names, menus = sorted(ASIDE_NAMES), sorted(MENU_NAMES)

    def aside() -> str:
        kind, some = int(rng.integers(0, 11)), pick(3)
        name, menu = names[int(rng.integers(0, len(names)))], menus[int(rng.integers(0, len(menus)))]
        link = "".join(f"<li><a href='/x'>{short(s)}</a></li>" for s in pick(int(rng.integers(2, 8))))
        return [f"<nav><ul>{link}</ul></nav>", f"<header><h1>{short(some[0])}</h1><p>{short(some[1])}</p></header>",
                f"<footer><p>{esc(some[0])}</p>{short(some[1])}</footer>",
                f"<aside><h3>{short(some[0])}</h3><p>{esc(some[1])}</p><ul>{link}</ul></aside>",
                f"<form><label>{short(some[0])}</label><p>{short(some[2])}</p><button>{short(some[1])}</button></form>",
                f"<div class='{name}'>{esc(some[0])}</div>", f"<div id='{name}'><p>{esc(some[0])}</p><p>{esc(some[1])}</p></div>",
                f"<section class='{name}'><h3>{short(some[0])}</h3><div class='{name}'><p>{esc(some[1])}</p></div>"
                f"<div><p>{esc(some[2])}</p></div></section>",
                f"<div class='{name}-box'><ul>{link}</ul></div>", f"<div class='{menu}'><ul>{link}</ul></div>",
                f"<div id='{menu}'>{link.replace('li>', 'span>')}</div>"][kind]

    out = []
    for _ in range(count):
        body = f"<h1>{short(pick(1)[0])}</h1>"
        for s in pick(int(rng.integers(1, 9))):
            kind = int(rng.integers(0, 10))
            body += (f"<h2>{short(s)}</h2>" if kind == 0 else f"<ul><li>{esc(s)}</li><li>{short(s)}</li></ul>" if kind == 1
                     else f"<blockquote>{esc(s)}</blockquote>" if kind == 2 else f"<p><b>{short(s)}<br><p>{esc(s)}" if kind == 3
                     else f"<div>{esc(s)}</div>" if kind == 4 else f"<p>{esc(s)}</p>")
            if rng.random() < 0.12:
                body += aside()
        frame = [("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"),
                 ("<div id='content'>", "</div>"), ("<article class='post'><div class='entry-content'>", "</div></article>"),
                 ("<div class='page'><section>", "</section></div>")][int(rng.integers(0, 6))]
        before = "".join(aside() for _ in range(int(rng.integers(0, 4))))
        after = "".join(aside() for _ in range(int(rng.integers(0, 4))))
        out.append(f"<html><head><title>{short(pick(1)[0])}</title></head><body>{before}{frame[0]}{body}{frame[1]}{after}</body></html>")
    return out


def fit(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", sample: int = 400,
        max_chars: int = 20_000, generated: int = 1000) -> BiLSTM:
    """Train on about ``sample`` drawn pages and ``generated`` frames of their texts."""
    known = pages.filter(F.char_length(html_col).between(1, max_chars))
    total = known.count()
    draw = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)
    rows = known.filter(draw < sample / max(1, total)).select(html_col).limit(2 * sample).collect()
    real = sorted(r[0] for r in rows)
    texts = [b.text for h in real for b in read_blocks(h)] or ["Some text.", "More"]
    learned = real + generated_pages(texts, generated)
    read = [read_blocks(h) for h in learned] + [read_blocks(h, unnamed(k)) for k, h in enumerate(learned)]
    paths: dict = {}
    return train([(vectors(b, paths), markup_labels(b)) for b in read])


# --- the operator ------------------------------------------------------------

def main_text(pages: list[list[Block]], net: BiLSTM, paths: dict, budget: int = 8192) -> list[str]:
    """Blocks that the network calls main text, joined by line feeds."""
    out = [""] * len(pages)
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):
        group = []
        while at < len(order) and (not group or (len(group) + 1) * len(pages[order[at]]) <= budget):
            group.append(order[at])
            at += 1
        x, mask = padded([vectors(pages[k], paths) for k in group])
        keep = net.logits(x, mask) > 0
        for j, k in enumerate(group):
            out[k] = "\n".join(b.text for i, b in enumerate(pages[k]) if keep[i, j])
    return out


def extract(pages: DataFrame, net: BiLSTM, html_col: str = "html", into: str = "text") -> DataFrame:
    """Add ``into``: the main text of each page (an existing column is replaced)."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        paths: dict = {}
        for htmls in batches:
            values, out = htmls.tolist(), []
            for k in range(0, len(values), 256):
                out += main_text([read_blocks(h) for h in values[k:k + 256]], net, paths)
            yield pd.Series(out, dtype=object)

    columns = [c for c in pages.columns if c != into]
    return pages.select(*columns, F.pandas_udf(run, "string")(F.col(html_col)).alias(into))
