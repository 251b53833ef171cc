"""Main text of web pages by a recurrent labeller of text blocks.

A page becomes the sequence of its leaf blocks: text between block-level tags,
with the path of open elements (names, classes, ids) and hashed words. A
bidirectional LSTM in numpy reads the whole sequence, so each block is judged
by what stands before and after it, and labels it article or not. The weights
are fitted on the driver from pages composed with known labels
(``composed_pages``: a fixed number, whatever the table's size) and go to the
tasks with the function, about 300 KB. Extraction is one pass, no shuffle.
"""

from __future__ import annotations

import random
import re
import zlib
from functools import lru_cache
from html import unescape
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import map_batches

#: Pages composed for training, and passes over them.
TRAIN_PAGES = 700
EPOCHS = 12
_PATH_SLOTS, _WORD_SLOTS, _EMBED, _HIDDEN = 1024, 512, 20, 16
_PLAIN = 5

# Elements of the HTML standard by how they take part in blocks.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template noscript svg math iframe object canvas audio video".split())
RAW = frozenset("script style textarea title iframe noscript xmp".split())
HEAD_ONLY = frozenset(["title", "head"])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*'|\"[^\"]*\Z|'[^']*\Z)*\Z",
    re.S,
)
_LABEL = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[a-z]+")


class Block:
    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple[str, ...], text: str, linked: int):
        self.path, self.text, self.linked = path, text, linked


def blocks(html: str) -> list[Block]:
    """Leaf blocks in page order; text decoded, white space made one space, empty ones left out.

    Inline elements do not end a block, ``br`` is white space. Scripts, styles,
    comments and the head are passed over; what a cut-off page leaves open ends
    with it.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    piece: list[str] = []
    linked = in_link = 0

    def close() -> None:
        nonlocal linked
        if piece:
            text = " ".join("".join(piece).split())
            if text:
                path = tuple(chain.from_iterable(marks for _, marks in stack))
                out.append(Block(path, text, linked))
            piece.clear()
        linked = 0

    at, end = 0, len(html)
    while at < end:
        tag = html.find("<", at)
        if tag < 0:
            tag = end
        found = _TOKEN.match(html, tag) if tag < end else None
        if tag > at or (tag < end and not found):
            upto = tag if tag > at else tag + 1
            text = unescape(html[at:upto])
            piece.append(text)
            if in_link:
                linked += len(text)
            at = upto
            continue
        if not found:
            break
        at = found.end()
        closing, opening = found.group(1), found.group(2)
        if closing:
            name = closing.lower()
            if name not in INLINE:
                close()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            if name == "a":
                in_link = 0
        elif opening:
            name = opening.lower()
            if name == "br":
                piece.append(" ")
            if name in SILENT or name in RAW:
                close()
                stop = re.compile(rf"</{name}\s*(?:>|\Z)", re.I).search(html, at)
                at = stop.end() if stop else end
                continue
            if name not in INLINE:
                close()
                if any(n == "p" for n, _ in stack) and name in _ENDS_P:
                    while stack.pop()[0] != "p":
                        pass
                if name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] in ("ul", "ol", "dl", "table", "tbody", "select"):
                            break
                        if stack[i][0] == name:
                            del stack[i:]
                            break
            if name == "a":
                in_link = 1
            if name not in VOID and name not in ("b", "i", "em", "strong", "span", "u", "small"):
                marks = [f"<{name}"]
                for found_label in _LABEL.finditer(found.group(3) or ""):
                    value = next((g for g in found_label.groups() if g), "")
                    marks += [f".{w}" for w in _PARTS.findall(value.lower())]
                stack.append((name, tuple(marks)))
    close()
    return out


_ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)


@lru_cache(maxsize=100_000)
def _slot(word: str, slots: int) -> int:
    return zlib.crc32(word.encode()) % slots


def _features(page: list[Block]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
    plain = np.zeros((len(page), _PLAIN), np.float32)
    paths, words = [], []
    for i, b in enumerate(page):
        own = list(b.path)
        own += [f"^{m}" for m in own[-3:]]  # the nearest elements once more, as such
        paths.append([_slot(m, _PATH_SLOTS) for m in own] or [0])
        n = len(b.text)
        words.append([_slot(w, _WORD_SLOTS) for w in b.text.lower().split()])
        plain[i] = (min(n, 2000) ** 0.5 / 20, min(1.0, b.linked / n), b.text[-1] in ".!?…:;\"”", i / len(page), 1.0 / (1 + i))
    return paths, words, plain


class Labeller:
    """Embeddings of path marks and words, an LSTM each way, one output per block."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        wide = 2 * _EMBED + _PLAIN

        def weights(*shape: int) -> np.ndarray:
            return (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.w = {
            "path": (r.standard_normal((_PATH_SLOTS, _EMBED)) * 0.3).astype(np.float32),
            "word": (r.standard_normal((_WORD_SLOTS, _EMBED)) * 0.1).astype(np.float32),
            "out": weights(2 * _HIDDEN, 1),
            "bias": np.zeros(1, np.float32),
        }
        for way in ("f", "b"):
            self.w[f"x{way}"], self.w[f"h{way}"] = weights(wide, 4 * _HIDDEN), weights(_HIDDEN, 4 * _HIDDEN)
            self.w[f"c{way}"] = np.concatenate([np.ones(_HIDDEN), np.zeros(3 * _HIDDEN)]).astype(np.float32)

    @staticmethod
    def _mean(vectors: np.ndarray, lists: list[list[int]], divide: bool) -> tuple[np.ndarray, tuple]:
        sizes = np.array([len(x) for x in lists])
        flat = np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
        out = np.zeros((len(lists), vectors.shape[1]), np.float32)
        full = np.flatnonzero(sizes)
        if len(full):
            starts = np.cumsum(sizes[full]) - sizes[full]
            out[full] = np.add.reduceat(vectors[flat], starts, axis=0)
        scale = 1 / np.maximum(sizes, 1) if divide else np.full(len(sizes), 0.5)
        return out * scale[:, None].astype(np.float32), (flat, sizes, scale)

    def _inputs(self, pages) -> tuple[np.ndarray, tuple]:
        paths = [p for page in pages for p in page[0]]
        words = [w for page in pages for w in page[1]]
        a, back_a = self._mean(self.w["path"], paths, False)
        b, back_b = self._mean(self.w["word"], words, True)
        return np.concatenate([a, b, np.concatenate([page[2] for page in pages])], axis=1), (back_a, back_b)

    @staticmethod
    def _places(pages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the flat block list at (step, page) each way; the last row stands for none."""
        sizes = np.array([len(p[0]) for p in pages])
        begin, total = np.cumsum(sizes) - sizes, int(sizes.sum())
        step = np.arange(sizes.max())[:, None]
        live = step < sizes
        return live, np.where(live, begin + step, total), np.where(live, begin + sizes - 1 - step, total)

    def _run(self, x: np.ndarray, live: np.ndarray, way: str, keep: list | None) -> np.ndarray:
        n = live.shape[1]
        h = np.zeros((n, _HIDDEN), np.float32)
        c = np.zeros_like(h)
        inputs = x @ self.w[f"x{way}"] + self.w[f"c{way}"]
        out = np.zeros((*live.shape, _HIDDEN), np.float32)
        for t in range(live.shape[0]):
            z = inputs[t] + h @ self.w[f"h{way}"]
            s = 1 / (1 + np.exp(-z[:, : 3 * _HIDDEN]))
            g = np.tanh(z[:, 3 * _HIDDEN :])
            f, i, o = s[:, :_HIDDEN], s[:, _HIDDEN : 2 * _HIDDEN], s[:, 2 * _HIDDEN :]
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            h_new = o * tc
            m = live[t][:, None]
            if keep is not None:
                keep.append((h, c, f, i, o, g, tc, m))
            c, h = np.where(m, c_new, c), np.where(m, h_new, h)
            out[t] = h
        return out

    def forward(self, pages, keep: dict | None = None) -> np.ndarray:
        flat, back = self._inputs(pages)
        live, fore, aft = self._places(pages)
        padded = np.vstack([flat, np.zeros((1, flat.shape[1]), np.float32)])
        hidden = np.zeros((len(padded), 2 * _HIDDEN), np.float32)
        steps: dict[str, list] = {"f": [], "b": []}
        for way, place in (("f", fore), ("b", aft)):
            half = slice(0, _HIDDEN) if way == "f" else slice(_HIDDEN, None)
            hidden[place.ravel(), half] = self._run(padded[place], live, way, steps[way] if keep is not None else None).reshape(
                -1, _HIDDEN
            )
        hidden[-1] = 0
        score = 1 / (1 + np.exp(-(hidden[:-1] @ self.w["out"] + self.w["bias"])[:, 0]))
        if keep is not None:
            keep |= {"padded": padded, "hidden": hidden, "steps": steps, "live": live, "f": fore, "b": aft, "back": back}
        return score

    def gradients(self, pages, labels: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
        k: dict = {}
        score = self.forward(pages, k)
        delta = ((score - labels) / len(labels)).astype(np.float32)[:, None]
        loss = float(-np.mean(np.log(np.where(labels > 0, score, 1 - score) + 1e-7)))
        grads = {"out": k["hidden"][:-1].T @ delta, "bias": delta.sum(0)}
        d_hidden = np.vstack([delta @ self.w["out"].T, np.zeros((1, 2 * _HIDDEN), np.float32)])
        d_padded = np.zeros_like(k["padded"])
        for way, half in (("f", slice(0, _HIDDEN)), ("b", slice(_HIDDEN, None))):
            place, wx, wh = k[way], self.w[f"x{way}"], self.w[f"h{way}"]
            dh = np.zeros((place.shape[1], _HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            dz_all = np.zeros((*place.shape, 4 * _HIDDEN), np.float32)
            g_h = np.zeros_like(wh)
            for t in range(place.shape[0] - 1, -1, -1):
                h0, c0, f, i, o, g, tc, m = k["steps"][way][t]
                dh = dh + d_hidden[place[t], half] * m
                dcm = np.where(m, dc + dh * o * (1 - tc * tc), 0)
                dhm = np.where(m, dh, 0)
                dz = np.concatenate(
                    [dcm * c0 * f * (1 - f), dcm * g * i * (1 - i), dhm * tc * o * (1 - o), dcm * i * (1 - g * g)], axis=1
                )
                dz_all[t] = dz
                g_h += h0.T @ dz
                dc = np.where(m, dcm * f, dc)
                dh = np.where(m, dz @ wh.T, dh)
            x = k["padded"][place].reshape(-1, k["padded"].shape[1])
            flat = dz_all.reshape(-1, 4 * _HIDDEN)
            grads |= {f"x{way}": x.T @ flat, f"h{way}": g_h, f"c{way}": flat.sum(0)}
            np.add.at(d_padded, place.ravel(), flat @ wx.T)
        for name, part, (ids, sizes, scale) in zip(
            ("path", "word"), (slice(0, _EMBED), slice(_EMBED, 2 * _EMBED)), k["back"]
        ):
            grads[name] = np.zeros_like(self.w[name])
            np.add.at(grads[name], ids, np.repeat(d_padded[:-1, part] * scale[:, None].astype(np.float32), sizes, axis=0))
        return grads, loss


def _say(r: random.Random, least: int, most: int) -> str:
    """Invented words: the labeller is to learn places and shapes, hardly words."""
    words = ["".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(r.randint(least, most))]
    return " ".join(words)


_SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe qui ro su ta ve wi xo yu an er in on th st".split()


def _sentences(r: random.Random, least: int, most: int) -> str:
    return " ".join(_say(r, 1, 14).capitalize() + r.choice("...!?") for _ in range(r.randint(least, most)))


def composed_page(r: random.Random) -> tuple[str, list[int]]:
    """A page of varied layout and the label of each of its blocks (1: article)."""
    labels: list[int] = []

    def block(tag: str, text: str, label: int) -> str:
        labels.append(label)
        text = text.replace("&", "&amp;")
        if r.random() < 0.1:
            text = f"<b>{text}" + r.choice(["</b>", "<br>"])
        elif r.random() < 0.08:
            text = f"{text}<br>" + _say(r, 1, 6)
        elif r.random() < 0.08:
            text = f'{text} <a href="/x">{_say(r, 1, 3)}</a> ' + _say(r, 1, 4)
        return f"<{tag}>{text}" + ("" if tag == "p" and r.random() < 0.15 else f"</{tag.split()[0]}>")

    def links(n: int, tag: str = "li") -> str:
        out = ""
        for _ in range(n):
            labels.append(0)
            out += f'<{tag}><a href="/{r.randint(0, 99)}">{_say(r, 1, 3)}</a></{tag}>'
        return f"<ul>{out}</ul>" if tag == "li" else out

    def named(*names: str) -> str:
        name = r.choice(names)
        name = name + r.choice(["", "", "-box", "-wrapper", "-area"])
        return f' {r.choice(["class", "class", "id"])}="{name}"'

    def menu() -> str:
        n = r.randint(2, 9)
        kind = r.random()
        if kind < 0.6:
            return f"<nav>{links(n)}</nav>"
        return f"<div{named('menu', 'nav', 'navigation', 'navbar', 'breadcrumb', 'topnav')}>{links(n, r.choice(['li', 'div', 'p']))}</div>"

    def header() -> str:
        inner = block(r.choice(["h1", "div", "p", "h2"]), _say(r, 1, 6), 0) + (block("p", _say(r, 2, 9), 0) if r.random() < 0.5 else "")
        if r.random() < 0.5:
            return f"<header>{inner}{menu() if r.random() < 0.5 else ''}</header>"
        return f"<div{named('header', 'site-header', 'masthead', 'banner', 'top')}>{inner}</div>"

    def advert() -> str:
        tag = r.choice(["div", "div", "aside", "section"])
        if r.random() < 0.6:
            labels.append(0)
            return f"<{tag}{named('ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'banner')}>{_sentences(r, 1, 4)}</{tag}>"
        return f"<{tag}{named('ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo')}>{block('p', _sentences(r, 1, 4), 0)}</{tag}>"

    def notice() -> str:
        tag = r.choice(["div", "div", "section", "p"])
        mark = named("cookie", "cookie-notice", "notice", "consent", "alert", "gdpr", "popup", "newsletter", "subscribe")
        if tag == "p" or r.random() < 0.5:
            labels.append(0)
            return f"<{tag}{mark}>{_sentences(r, 1, 3)}</{tag}>"
        return f"<{tag}{mark}>{block('p', _sentences(r, 1, 3), 0)}</{tag}>"

    def form() -> str:
        labels.append(0)
        more = f"<button>{_say(r, 1, 2)}</button>" if r.random() < 0.7 else ""
        labels.extend([0] * bool(more))
        return f'<form action="/s"><label>{_say(r, 1, 4)}</label><input name="q">{more}</form>'

    def sidebar() -> str:
        inner = block(r.choice(["h2", "h3", "h4"]), _say(r, 1, 4), 0)
        inner += links(r.randint(1, 6)) if r.random() < 0.6 else block("p", _sentences(r, 1, 3), 0)
        if r.random() < 0.5:
            return f"<aside>{inner}</aside>"
        return f"<div{named('sidebar', 'side', 'related', 'widget', 'recommended', 'trending', 'share', 'social', 'tags')}>{inner}</div>"

    def comments() -> str:
        mark = named("comments", "comment-list", "responses", "discussion", "replies", "disqus")
        inner = block(r.choice(["h2", "h3"]), _say(r, 1, 3), 0) if r.random() < 0.7 else ""
        for _ in range(r.randint(1, 6)):
            inner += f"<div{named('comment', 'reply')}>{block('p', _sentences(r, 1, 4), 0)}</div>"
        tag = r.choice(["div", "section", "ol"])
        return f"<{tag}{mark}>{inner}{form() if r.random() < 0.3 else ''}</{tag}>"

    def footer() -> str:
        if r.random() < 0.6:
            if r.random() < 0.6:
                labels.append(0)
                return f"<footer>&copy; {_say(r, 1, 2)}.example &middot; {_sentences(r, 1, 2)}</footer>"
            return f"<footer>{block('p', '© ' + _sentences(r, 1, 2), 0)}{links(r.randint(1, 4))}</footer>"
        return f"<div{named('footer', 'site-footer', 'bottom', 'copyright')}>{block('p', _sentences(r, 1, 2), 0)}</div>"

    def article() -> str:
        inner = block("h1", _say(r, 2, 12).capitalize() + r.choice([".", "", ""]), 1) if r.random() < 0.9 else ""
        for _ in range(r.choice([0, 1, 1, 2, 3, 5, 8, 13, 20, 30])):
            kind = r.random()
            if kind < 0.8:
                inner += block("p", _sentences(r, 1, r.choice([1, 2, 5, 12])), 1)
            elif kind < 0.86:
                inner += block(r.choice(["h2", "h3"]), _say(r, 1, 7), 1)
            elif kind < 0.91:
                items = "".join(block("li", _say(r, 2, 16), 1) for _ in range(r.randint(1, 5)))
                inner += f"<{'ul'}>{items}</ul>"
            elif kind < 0.94:
                inner += f"<blockquote>{block('p', _sentences(r, 1, 3), 1)}</blockquote>"
            elif kind < 0.95:
                inner += f"<table><tr>{block('td', _say(r, 1, 4), 1)}{block('td', _say(r, 1, 4), 1)}</tr></table>"
            elif kind < 0.97:
                inner += advert()
            elif kind < 0.985:
                inner += sidebar()
            else:
                inner += notice()
        if r.random() < 0.1:
            inner += comments()
        kind = r.random()
        if kind < 0.65:
            return f"<article>{inner}</article>"
        if kind < 0.8:
            return f"<main>{inner}</main>"
        return f"<div{named('content', 'main', 'article', 'post', 'entry', 'story', 'body', 'text')}>{inner}</div>"

    def maybe(make, chance: float) -> str:
        return make() if r.random() < chance else ""

    plain = r.random() < 0.35  # the leanest layout: menu, advert, article, footer
    body = maybe(notice, 0 if plain else 0.3) + maybe(header, 0 if plain else 0.5) + maybe(menu, 0.9)
    body += maybe(advert, 0.6) + maybe(form, 0 if plain else 0.2) + maybe(sidebar, 0 if plain else 0.25)
    body += article()
    body += maybe(comments, 0 if plain else 0.4) + maybe(sidebar, 0 if plain else 0.3) + maybe(advert, 0 if plain else 0.3)
    body += maybe(form, 0 if plain else 0.15) + maybe(notice, 0 if plain else 0.15) + maybe(footer, 0.9)
    if r.random() < 0.2:
        body = f"<div{named('page', 'wrapper', 'container')}>{body}</div>"
    page = f"<html><head><title>x</title><style>p{{}}</style></head><body>{body}</body></html>"
    return page, labels


def composed_pages(n: int = TRAIN_PAGES, seed: int = 11) -> list[tuple[list[Block], list[int]]]:
    r = random.Random(seed)
    made = []
    while len(made) < n:
        html, labels = composed_page(r)
        found = blocks(html)
        if found and len(found) == len(labels):
            made.append((found, labels))
    return made


@lru_cache(maxsize=1)
def fitted(seed: int = 5) -> Labeller:
    """The labeller after training on ``TRAIN_PAGES`` composed pages with Adam; the same weights every time."""
    pages = [(_features(p), np.array(y, np.float32)) for p, y in composed_pages()]
    model, r = Labeller(), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    step, size = 0, 30
    pages.sort(key=lambda p: len(p[1]))
    groups = [pages[i : i + size] for i in range(0, len(pages), size)]
    for epoch in range(EPOCHS):
        for g in r.permutation(len(groups)):
            batch = []
            for (paths, words, plain), y in groups[g]:
                kept = [[m for m in p if r.random() > 0.15] for p in paths] if r.random() < 0.5 else paths
                batch.append((kept, words if r.random() < 0.5 else [[] for _ in words], plain))
            grads, _ = model.gradients(batch, np.concatenate([y for _, y in groups[g]]))
            step += 1
            rate = 0.01 * (1 - epoch / EPOCHS) + 0.001
            for k, d in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                model.w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def label_pages(pages: list[list[Block]], model: Labeller, cells: int = 60_000) -> list[list[bool]]:
    """For each page whether each block is article text; pages of like length are run together."""
    out: list[list[bool]] = [[] for _ in pages]
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        upto = at + 1
        while upto < len(order) and (upto + 1 - at) * len(pages[order[upto]]) <= cells and upto - at < 512:
            upto += 1
        group = order[at:upto]
        score = model.forward([_features(pages[i]) for i in group])
        cut = np.cumsum([len(pages[i]) for i in group])[:-1]
        for i, part in zip(group, np.split(score, cut)):
            out[i] = (part > 0.5).tolist()
        at = upto
    return out


def main_texts(htmls: list[str | None], model: Labeller) -> list[str]:
    pages = [blocks(h or "") for h in htmls]
    return ["\n".join(b.text for b, keep in zip(p, y) if keep) for p, y in zip(pages, label_pages(pages, model))]


def extract(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), html: str = "html", model: Labeller | None = None) -> DataFrame:
    """``keys`` (as they are), ``text`` (kept blocks joined by line feeds), ``n_chars``.

    Null or empty html gives an empty text; every row gives one row, repeats
    included; other columns are not read.
    """
    weights = (model or fitted()).w
    rows = pages.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{html}`").alias("_html"))
    kept = rows.select(*[F.col(f"`{k}`") for k in keys])
    schema = kept.withColumn("text", F.lit("")).withColumn("n_chars", F.lit(0).cast("long")).schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        labeller = Labeller.__new__(Labeller)
        labeller.w = weights
        texts: list[str] = []
        for i in range(0, batch.num_rows, 512):
            texts += main_texts(batch.column(len(keys)).slice(i, 512).to_pylist(), labeller)
        columns = [*batch.columns[: len(keys)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, [*keys, "text", "n_chars"])

    return map_batches(rows, schema, run)
