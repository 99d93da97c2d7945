"""Main text of web pages: a linear-chain conditional random field over the pages' leaf blocks.

A page is read into blocks of running text, each with the elements around it. Features of a block are
the names and class words of these elements and a few bins of its text; the field scores labels
(text or not) by features and by neighbours, and Viterbi picks the best sequence. It is trained here, by
maximum likelihood, on labelled pages: pages drawn from patterns of layout, as no table has labels.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements whose content is no text.
SILENT = {"script", "style", "noscript", "template", "svg", "iframe", "object", "head", "title", "select", "textarea", "button", "canvas", "audio", "video", "annotation", "annotation-xml"}
#: Elements that run on within a block.
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s",
    "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "br", "input",
    "nobr", "ruby", "rb", "rt", "rtc", "rp", "math", "svg", "output", "meter", "progress", "slot", "script", "noscript", "template", "iframe", "object",
    "select", "textarea", "button", "canvas", "audio", "video", "picture", "source", "track", "embed", "map", "area", "datalist",
}
#: Elements whose own parts never end the block around them.
WHOLE = (SILENT & INLINE) | {"math"}
#: Elements that may stand in a head; any other, or text, ends one whose end tag is left out.
IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
#: A head is the first or second open element.
HEAD_WITHIN = 2
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that end an open one of the kind.
ENDS_ITS_KIND = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
RAW = {"script", "style", "textarea", "title", "noscript", "iframe"}
#: Width of the hashed feature space.
FEATURES = 1 << 13


class Block:
    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple, linked: int):
        self.text, self.path, self.linked = text, path, linked


def class_words(attributes: str) -> tuple[str, ...]:
    words: list[str] = []
    for name, *values in ATTRIBUTE.findall(attributes):
        for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(values)).lower()):
            if w:
                words.append(w)
    return tuple(words)


def leaf_blocks(page: str) -> list[Block]:
    """Blocks of text in page order; white space in a block is one space, references are decoded."""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    linked = silent = whole = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            blocks.append(Block(text, tuple(stack), linked))
        pieces.clear()
        linked = 0

    def pop(to: int) -> None:
        nonlocal silent, whole
        silent -= sum(t in SILENT for t, _ in stack[to:])
        whole -= sum(t in WHOLE for t, _ in stack[to:])
        del stack[to:]

    at = 0
    while at < len(page):
        token = TOKEN.search(page, at)
        text = page[at : token.start() if token else len(page)]
        if stack and stack[-1][0] == "head" and text.strip():
            pop(len(stack) - 1)
        if text and not silent:
            pieces.append(text)
            if any(t == "a" for t, _ in stack):
                linked += len(text)
        if not token:
            break
        at = token.end()
        closing, name = token[1], (token[2] or "").lower()
        if not name:
            continue
        if not closing and name != "head":
            for k, (t, _) in enumerate(stack[:HEAD_WITHIN]):
                if t == "head" and (name == "body" or k == len(stack) - 1 and name not in IN_HEAD):
                    pop(k)
                    break
        if name == "br":
            pieces.append(" ")
            continue
        if closing:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            # An end tag may end elements that have none of their own, and with them their silence.
            if name not in INLINE and not (whole and any(t in WHOLE for t, _ in stack[:k])):
                flush()
            if k is not None:
                pop(k)
            continue
        if name not in INLINE and not whole:
            flush()
        if name in VOID or token[3].endswith("/"):
            continue
        if name in ENDS_ITS_KIND:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    pop(k)
                    break
                if stack[k][0] not in INLINE and stack[k][0] != "p":
                    break
        if name in RAW:  # up to the end tag all is text, or nothing
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append((name, class_words(token[3])))
        silent += name in SILENT
        whole += name in WHOLE
    flush()
    return blocks


def _bin(x: float, edges: tuple) -> int:
    return sum(x >= e for e in edges)


def _feature(text: str) -> int:
    return zlib.crc32(text.encode()) % FEATURES


_KNOWN: dict[tuple, tuple[int, ...]] = {}


def path_features(path: tuple) -> tuple[int, ...]:
    """Features of the elements around a block; pages of a site share most paths."""
    found = _KNOWN.get(path)
    if found is None:
        names = {f"t={t}" for t, _ in path}
        names |= {f"c={w}" for _, words in path for w in words}
        outer = [t for t, _ in path if t not in INLINE]
        names.add(f"leaf={outer[-1] if outer else ''}")
        names.add(f"up={'/'.join(outer[-2:])}")
        found = tuple(sorted({_feature(x) for x in names}))
        if len(_KNOWN) > 50_000:
            _KNOWN.clear()
        _KNOWN[path] = found
    return found


def block_features(block: Block) -> tuple[int, ...]:
    t = block.text
    words = t.count(" ") + 1
    own = (
        f"w={_bin(words, (2, 4, 8, 15, 30, 60))}",
        f"l={_bin(block.linked / max(len(t), 1), (0.05, 0.3, 0.7))}",
        f"e={t[-1] in '.!?:'}",
        f"u={'©' in t}",
    )
    return path_features(block.path) + tuple(_feature(x) for x in own)


class Field:
    """``weights`` (features, 2), ``steps`` (2, 2; from, to), ``first`` (2)."""

    def __init__(self, weights: np.ndarray, steps: np.ndarray, first: np.ndarray):
        self.weights, self.steps, self.first = weights, steps, first

    def scores(self, page: list[tuple[int, ...]]) -> np.ndarray:
        return np.array([self.weights[list(f)].sum(axis=0) for f in page])

    def decode(self, page: list[tuple[int, ...]]) -> list[int]:
        """The best sequence of labels."""
        if not page:
            return []
        (aa, ab), (ba, bb) = self.steps.tolist()
        scores = self.scores(page).tolist()
        a, b = scores[0][0] + self.first[0], scores[0][1] + self.first[1]
        back = []
        for x, y in scores[1:]:
            from_a, from_b = a + aa >= b + ba, a + ab > b + bb
            back.append((0 if from_a else 1, 0 if from_b else 1))
            a, b = (a + aa if from_a else b + ba) + x, (a + ab if from_b else b + bb) + y
        labels = [0 if a >= b else 1]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(pages: list[tuple[list[tuple[int, ...]], list[int]]], rounds: int = 6, rate: float = 0.3, shrink: float = 1e-4) -> Field:
    """Maximum likelihood by stochastic gradients with a step size per weight."""
    field = Field(np.zeros((FEATURES, 2)), np.zeros((2, 2)), np.zeros(2))
    seen = [np.full(x.shape, 1e-3) for x in (field.weights, field.steps, field.first)]
    order = np.random.default_rng(9)
    for _ in range(rounds):
        for p in order.permutation(len(pages)):
            features, labels = pages[p]
            if not features:
                continue
            s = field.scores(features)
            n = len(s)
            ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
            ahead[0] = field.first + s[0]
            for t in range(1, n):
                ahead[t] = _log_sum(ahead[t - 1][:, None] + field.steps, 0) + s[t]
            for t in range(n - 2, -1, -1):
                behind[t] = _log_sum(field.steps + s[t + 1] + behind[t + 1], 1)
            total = _log_sum(ahead[-1], 0)
            chance = np.exp(ahead + behind - total)
            wrong = chance.copy()
            wrong[np.arange(n), labels] -= 1  # expected minus observed
            steps = np.zeros((2, 2))
            for t in range(1, n):
                steps += np.exp(ahead[t - 1][:, None] + field.steps + s[t] + behind[t] - total)
                steps[labels[t - 1], labels[t]] -= 1
            rows = np.concatenate([np.array(f) for f in features])
            grads = np.repeat(wrong, [len(f) for f in features], axis=0)
            full = np.zeros((FEATURES, 2))
            np.add.at(full, rows, grads)
            touched = np.unique(rows)
            g = full[touched] + shrink * field.weights[touched]
            seen[0][touched] += g**2
            field.weights[touched] -= rate * g / np.sqrt(seen[0][touched])
            for value, gradient, total_ in ((field.steps, steps, seen[1]), (field.first, wrong[0], seen[2])):
                total_ += gradient**2
                value -= rate * gradient / np.sqrt(total_)
    return field


#: Layouts of labelled pages: how the main text, and all else, may be wrapped.
MAIN = [
    "<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", '<div class="content">{}</div>', '<div id="content">{}</div>',
    '<div class="post-body">{}</div>', '<div class="article-body entry">{}</div>', '<section class="story">{}</section>', '<div id="main">{}</div>',
    "<div><article>{}</article></div>", '<article class="post">{}</article>', "<div>{}</div>",
]
BEFORE = [
    "<nav><ul>{links}</ul></nav>", "<header><h1>{short}</h1><p>{short}</p></header>", '<div class="menu"><ul>{links}</ul></div>', '<ul id="nav">{links}</ul>',
    '<div class="cookie-notice"><p>{long}</p></div>', '<div id="cookie-banner">{long}</div>', '<div class="breadcrumbs">{links}</div>', '<div class="notice">{long}</div>',
    '<header class="site-header"><div class="logo">{short}</div><nav>{links}</nav></header>', '<div class="ad">{long}</div>', '<div class="banner">{short}</div>',
    '<div role="navigation">{links}</div>', '<form class="search"><label>{short}</label><input name="q"></form>', '<div class="alert">{long}</div>',
]
AFTER = [
    "<footer><p>{long}</p></footer>", "<footer>&copy; {long}</footer>", '<div class="footer">&copy; {short}</div>', "<aside><h3>{short}</h3><p>{long}</p></aside>",
    '<div class="sidebar"><h2>{short}</h2><p>{long}</p><ul>{links}</ul></div>', '<section class="comments"><h2>{short}</h2><div class="comment"><p>{long}</p></div><div class="comment"><p>{long}</p></div></section>',
    '<div id="comments"><p>{long}</p><p>{long}</p></div>', '<ul class="comment-list"><li><p>{long}</p></li></ul>', "<form><p>{long}</p><label>{short}</label></form>",
    '<div class="related"><h3>{short}</h3><ul>{links}</ul></div>', '<div class="share">{links}</div>', '<div class="newsletter"><p>{long}</p><form><label>{short}</label></form></div>',
    '<div class="advert"><p>{long}</p></div>', '<div class="sponsored">{long}</div>', '<div class="promo"><p>{long}</p></div>', '<aside class="widget"><p>{long}</p></aside>',
]
WITHIN = ['<div class="ad">{long}</div>', '<aside><p>{long}</p></aside>', '<div class="share">{links}</div>', '<div class="advertisement"><p>{long}</p></div>', "<form><label>{short}</label></form>", '<div class="promo">{short}</div>']
MARK = "⁠"


def labelled_pages(n: int, seed: int = 9) -> list[tuple[list[tuple[int, ...]], list[int]]]:
    """Features and labels of ``n`` pages drawn from the layouts; main text carries an invisible mark."""
    rng = np.random.default_rng(seed)

    def words(low: int, high: int) -> str:
        return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(1, 9))) for _ in range(rng.integers(low, high)))

    def fill(layout: str) -> str:
        links = "".join(f'<li><a href="/x">{words(1, 3)}</a></li>' for _ in range(rng.integers(2, 8)))
        while "{" in layout:
            layout = layout.replace("{links}", links, 1).replace("{short}", words(1, 5), 1).replace("{long}", words(4, 45) + rng.choice(["", "."]), 1)
        return layout

    def some(layouts: list[str], most: int) -> str:
        return "".join(fill(layouts[k]) for k in rng.choice(len(layouts), rng.integers(0, most + 1), replace=False))

    pages = []
    for _ in range(n):
        body = [f"<h{rng.integers(1, 3)}>{MARK}{words(2, 10)}</h1>"] if rng.random() < 0.8 else []
        for _ in range(rng.integers(1, 10)):
            kind = rng.choice(["p", "p", "p", "p", "b", "li", "h2", "quote", "pre", "td", "bare"])
            text = MARK + words(1, 8) if kind in ("h2", "li", "td") else MARK + words(1, 120) + rng.choice([".", "", "!", "?"])
            if rng.random() < 0.2:
                text += f' <a href="/y">{words(1, 4)}</a> {words(1, 6)}.'
            body.append({
                "p": f"<p>{text}</p>", "b": f"<p><b>{text}<br>", "li": f"<ul><li>{text}</li><li>{MARK}{words(1, 20)}</li></ul>", "h2": f"<h2>{text}</h2>",
                "quote": f"<blockquote><p>{text}</p></blockquote>", "pre": f"<pre>{text}</pre>", "td": f"<table><tr><td>{text}</td><td>{MARK}{words(1, 9)}</td></tr></table>", "bare": f"<div>{text}</div>",
            }[kind])
            if rng.random() < 0.1:
                body.append(fill(WITHIN[rng.integers(len(WITHIN))]))
        main = MAIN[rng.integers(len(MAIN)) if rng.random() < 0.7 else 0].format("".join(body))
        page = f"<html><head><title>{words(2, 6)}</title></head><body>{some(BEFORE, 4)}{main}{some(AFTER, 4)}</body></html>"
        blocks = leaf_blocks(page)
        labels = [int(MARK in b.text) for b in blocks]
        for b in blocks:
            b.text = b.text.replace(MARK, "") or "x"
        pages.append(([block_features(b) for b in blocks], labels))
    return pages


TRAINING_PAGES = 900


def main_text(page: str, field: Field) -> str:
    blocks = leaf_blocks(page)
    labels = field.decode([block_features(b) for b in blocks])
    return "\n".join(b.text for b, y in zip(blocks, labels) if y)


def _extract(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py() or "", field) for p in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return run


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row of ``pages``.

    Blocks of the main text in page order, joined by line ends; empty if there are none, or for null
    html. Ids and urls may be null, repeated rows are each returned, further columns are ignored; an
    empty table gives an empty result.
    """
    field = field or train(labelled_pages(TRAINING_PAGES))
    return pages.select("page_id", "url", "html").mapInArrow(_extract(field), "page_id long, url string, text string, n_chars long")
