"""Main text of web pages: a recurrent labeller reads a page's blocks in order and marks those of the article.

A page is cut into leaf blocks, each with the open elements above it. A block's vector holds hashed elements of its tag
path, hashed words and a few figures; a bidirectional LSTM over all blocks of the page labels every block with the whole
page as context. It is trained on a bounded sample of pages whose own landmarks (article, main, nav, footer, ...) label
their blocks; in half of the training pages the landmarks are hidden, so that words, figures and neighbours count too.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import hashed_sample, text_slices
from starloom.llm.lstm import Adam, both_ways, both_ways_gradients, first_weights

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[^<]+|<", re.S)
#: Elements of HTML by their role: fixed values.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split())
UNREAD = frozenset("head iframe noembed noframes noscript object script style svg template textarea title canvas audio video button select".split())
#: What an unclosed one of these takes is the rest of the page; other unread elements are ordinary open ones if unclosed.
RAW = frozenset("script style textarea title".split())
#: Elements that don't hold one of their own kind.
SINGLE = frozenset("audio button canvas noscript select video".split())
#: Elements that can stand in a head; the first other tag or text ends an unclosed one.
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "legend", "summary"}
#: Landmarks that label training pages, and class or id words that do: fixed values.
INSIDE = frozenset("article main".split())
OUTSIDE = frozenset("nav header footer aside form menu dialog".split())
OUTSIDE_WORDS = frozenset("ad ads advert banner comment comments cookie footer header menu nav newsletter notice promo related share sidebar social sponsored".split())
WORD_SLOTS, PATH_SLOTS, FIGURES = 48, 64, 6
INPUTS = WORD_SLOTS + PATH_SLOTS + FIGURES


@dataclass
class Block:
    path: tuple[tuple[str, ...], ...]  # of each open element: its name, then its class and id words
    text: str
    linked: int  # characters inside links


def _head_end(html: str, at: int) -> int:
    """Where a head without a closing tag ends: at the first tag or text that cannot stand in it."""
    while at < len(html):
        m = TOKEN.match(html, at)
        name = (m[2] or m[5] or "").lower()
        if name and name not in HEAD or not name and (m[0][0] != "<" or m[0] == "<") and m[0].strip():
            return at
        at = m.end()
        if name in HEAD - VOID and not (m[1] or m[4]):
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html) if name in RAW else at
    return at


def blocks_of(html: str) -> list[Block]:
    """The leaf blocks that hold text, in page order. Unclosed and stray tags are read as browsers do, in outline."""
    out: list[Block] = []
    stack: list[tuple[str, ...]] = []
    parts: list[str] = []
    ends: dict[str, tuple[int, int]] = {}  # the next closing tag of each unread element
    linked, at = 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        if text:
            out.append(Block(tuple(s for s in stack if s[0] in BLOCKS or len(s) > 1), text, linked))
        parts.clear()
        linked = 0

    def close(name: str) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name:
                del stack[k:]
                return

    while at < len(html):
        m = TOKEN.match(html, at)
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            if m[0][0] != "<" or m[0] == "<":
                parts.append(m[0])
                if any(s[0] == "a" for s in stack[-3:]):
                    linked += len(m[0])
            continue
        if m[1] or m[4]:
            if name in BLOCKS:
                flush()
            close(name)
            continue
        if name in UNREAD:
            if m[0].endswith("/>"):
                continue
            if name not in ends or -1 < ends[name][0] < at:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
                ends[name] = end.span() if end else (-1, -1)
            # A second opening tag before the closing one means that the first is unclosed.
            again = name in SINGLE and ends[name][0] >= 0 and re.compile(rf"<{name}[\s/>]", re.I).search(html, at, ends[name][0])
            if (ends[name][0] >= 0 and not again) or name in RAW:
                at = ends[name][1] if ends[name][0] >= 0 else len(html)
                continue
            if name == "head":
                at = _head_end(html, at)
                continue
        if name in BLOCKS:
            flush()
            if name in CLOSES_P and any(s[0] == "p" for s in stack):
                close("p")
            if name == "li" and stack and stack[-1][0] == "li":
                stack.pop()
        elif name == "br":
            parts.append(" ")
        if name not in VOID and not m[0].endswith("/>"):
            words = re.findall(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", m[3] or m[6] or "", re.I)
            stack.append((name, *(w for x in words for w in re.split(r"[^a-z0-9]+", "".join(x).lower()) if w)))
    flush()
    return out


def landmark(block: Block) -> bool | None:
    """Whether the landmarks of a page place a block in its article; None where they don't tell."""
    inside = None
    for name, *words in block.path:
        if name in OUTSIDE or OUTSIDE_WORDS.intersection(words):
            return False
        if name in INSIDE:
            inside = True
    return inside


def _slot(word: str, slots: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return h % slots, 1.0 if h & 0x10000 else -1.0


def vectors(blocks: list[Block], hidden: bool = False, memo: dict | None = None) -> np.ndarray:
    """One row of INPUTS figures for each block; `hidden` leaves landmarks and class words out of the path."""
    out = np.zeros((len(blocks), INPUTS), np.float32)
    memo = {} if memo is None else memo
    for k, b in enumerate(blocks):
        row, words = out[k], b.text.split(" ")
        for w in words:
            slot, sign = memo.get(w) or memo.setdefault(w, _slot(w, WORD_SLOTS))
            row[slot] += sign
        np.clip(row[:WORD_SLOTS] / len(words) ** 0.5, -2, 2, out=row[:WORD_SLOTS])
        for element in b.path:
            names = element if not hidden else element[:1] if element[0] not in INSIDE | OUTSIDE else ("div",)
            for n, name in enumerate(names):
                slot, sign = _slot(("." if n else "") + name, PATH_SLOTS)
                row[WORD_SLOTS + slot] += sign
        letters = len(b.text)
        row[WORD_SLOTS + PATH_SLOTS :] = (
            np.log1p(letters) / 4, np.log1p(len(words)) / 3, min(1.0, b.linked / letters), sum(map(b.text.count, ".,;:!?")) / len(words), (k + 1) / (len(blocks) + 1), float(b.path[-1][0] in ("p", "h1", "h2", "h3", "blockquote", "pre")) if b.path else 0.0,
        )
        if len(memo) > 300_000:
            memo.clear()
    return out


def _chances(x: np.ndarray, mask: np.ndarray, weights: dict) -> tuple[np.ndarray, np.ndarray, tuple]:
    hidden, kept = both_ways(x @ weights["input_f"] + weights["bias_f"], x @ weights["input_b"] + weights["bias_b"], weights, mask)
    z = hidden @ weights["out"] + weights["out_bias"]
    return 1 / (1 + np.exp(-np.clip(z[:, :, 0], -30, 30))), hidden, kept


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), INPUTS), np.float32), np.zeros((steps, len(pages)), np.float32)
    for j, p in enumerate(pages):
        x[: len(p), j], mask[: len(p), j] = p, 1
    return x, mask


def train(htmls: list[str], size: int = 16, rounds: int = 150, batch: int = 24, longest: int = 200, seed: int = 11) -> dict[str, np.ndarray]:
    """Weights fitted to pages that have landmarks; of longer pages the first `longest` blocks. Blocks that no landmark
    places are outside where the page has an article, else unused."""
    draw, pages = np.random.default_rng(seed), []
    for html in htmls:
        blocks = blocks_of(html)[:longest]
        marks = [landmark(b) for b in blocks]
        if any(marks):
            y = np.array([float(bool(m)) for m in marks], np.float32)
            pages += [(vectors(blocks), y), (vectors(blocks, hidden=True), y)]
    weights = first_weights(INPUTS, size, 1, seed)
    adam = Adam(weights, 0.01)
    for step in range(rounds if pages else 0):
        adam.rate = 0.01 * (1 - step / rounds) + 0.001
        chosen = [pages[k] for k in draw.integers(0, len(pages), batch)]
        x, mask = _padded([p for p, _ in chosen])
        y = np.zeros(mask.shape, np.float32)
        for j, (_, labels) in enumerate(chosen):
            y[: len(labels), j] = labels
        chance, hidden, kept = _chances(x, mask, weights)
        up = ((chance - y) * mask / mask.sum())[:, :, None]
        gradients = {"out": np.einsum("tbh,tbk->hk", hidden, up), "out_bias": up.sum((0, 1))}
        a, b, recurrent = both_ways_gradients(up @ weights["out"].T, kept, weights, mask)
        for way, g in (("f", a), ("b", b)):
            gradients |= {f"input_{way}": np.einsum("tbi,tbg->ig", x, g), f"bias_{way}": g.sum((0, 1))}
        adam.step(gradients | recurrent)
    return weights


def label_pages(pages: list[list[Block]], weights: dict, cells: int = 1 << 14) -> list[np.ndarray]:
    """For each page, which blocks are of its article. Pages of like length are read together, with bounded memory."""
    memo: dict = {}
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):
        group = [order[at]]
        while at + len(group) < len(order) and (len(group) + 1) * len(pages[order[at + len(group)]]) <= cells:
            group.append(order[at + len(group)])
        x, mask = _padded([vectors(pages[k], memo=memo) for k in group])
        chance = _chances(x, mask, weights)[0]
        for j, k in enumerate(group):
            out[k] = chance[: len(pages[k]), j] >= 0.5
        at += len(group)
    return out


def fitted(pages: DataFrame, most: int = 256, longest: int = 200_000) -> dict[str, np.ndarray]:
    """The labeller trained on at most `most` pages of at most `longest` characters: those with the least hash."""
    usable = pages.where((F.length("html") <= longest) & F.col("html").isNotNull()).select("html")
    return train([r["html"] for r in hashed_sample(usable, most, "html").collect()])


def main_text(pages: DataFrame, weights: dict) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages (page_id, url, html): the blocks of the article, one a line.

    Null and empty pages, and pages without such a block, have an empty text. Repeated rows stay; other columns are
    left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "html"):
            cut = [blocks_of(h or "") for h in batch.column("html").to_pylist()]
            texts = ["\n".join(b.text for b, own in zip(page, kept, strict=True) if own) for page, kept in zip(cut, label_pages(cut, weights), strict=True)]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
