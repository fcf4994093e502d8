"""Main text of web pages: a recurrent labeller over a page's blocks.

A page is read as the sequence of its leaf blocks.  Each block is a vector of its hashed tag path
(names of the tags above it and words of their class, id and role), its hashed words, and a few
measures.  A bidirectional LSTM in numpy reads the sequence in both directions, so each block is
classed with the whole page as context; the blocks it calls main text make the result.

No page comes with labels, so the model is trained on layouts that this module makes, with known
main blocks: page frames, menus, notices, adverts, forms, sidebars and comments in many spellings,
filled with made-up words, so that what it learns is structure.  Training is seeded and bounded
(``PAGES`` layouts) and happens once per session.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import by_row
from starmill.llm.pageblocks import Block, read

PATH_BITS = 9
WORD_BITS = 8
HIDDEN = 16
PAGES = 400
ROUNDS = 8
WIDTH = (1 << PATH_BITS) + (1 << WORD_BITS) + 4
_MAIN = "\ue000"  # marks the main blocks of made-up pages; features do not see it
_AT_ONCE = 64
_LONG = 512
_STRETCH = 4096


# --- features ----------------------------------------------------------------------------


class _Places(dict):
    """Hashed places of names; names seen before are looked up.  Emptied when full."""

    def __init__(self, bits: int, first: int = 0):
        super().__init__()
        self.bits, self.first = bits, first

    def __missing__(self, name: str) -> int:
        if len(self) >= 300_000:
            self.clear()
        self[name] = place = self.first + (zlib.crc32(name.encode("utf-8", "replace")) & ((1 << self.bits) - 1))
        return place


_OF_NAME, _OF_WORD = _Places(PATH_BITS), _Places(WORD_BITS, 1 << PATH_BITS)


@lru_cache(maxsize=10_000)
def _of_path(path: tuple[str, ...]) -> np.ndarray:
    # The innermost tags count once more under a name of their own.
    return np.array(sorted({_OF_NAME[name] for name in (*path, *(f"/{name}" for name in path[-2:]))}), dtype=np.int64)


def _features(blocks: list[Block], where: np.ndarray) -> np.ndarray:
    """A row of ``WIDTH`` numbers per block; ``where``: its relative place in its page."""
    split = [block.text.lower().split() for block in blocks]
    counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    places = np.fromiter(map(_OF_WORD.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(counts.sum()))
    row = np.arange(len(blocks)) * WIDTH
    flat = np.bincount(np.repeat(row, counts) + places, np.repeat(2.0 / np.maximum(counts, 1), counts), minlength=len(blocks) * WIDTH)
    out = flat.astype(np.float32).reshape(len(blocks), WIDTH)
    for i, block in enumerate(blocks):
        out[i, _of_path(block.path)] = 1.0
    sizes = np.array([(len(block.text), block.linked) for block in blocks], dtype=np.float32).reshape(-1, 2)
    out[:, -4] = np.minimum(sizes[:, 0], 1000) / 200
    out[:, -3] = sizes[:, 1] / np.maximum(sizes[:, 0], 1)
    out[:, -2] = where
    out[:, -1] = counts < 4
    return out


# --- network -----------------------------------------------------------------------------


@dataclass
class Net:
    """Weights by direction: input, state and bias of the four gates; then the classifier."""

    inputs: list[np.ndarray]
    states: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def all(self) -> list[np.ndarray]:
        return [*self.inputs, *self.states, *self.biases, self.out, self.bias]


def _new_net(rng: np.random.Generator) -> Net:
    def made(*shape):
        return (rng.standard_normal(shape) * 0.1).astype(np.float32)

    biases = [np.zeros(4 * HIDDEN, dtype=np.float32) for _ in range(2)]
    for b in biases:
        b[HIDDEN : 2 * HIDDEN] = 1.0  # gates that forget start open
    return Net([made(WIDTH, 4 * HIDDEN) for _ in range(2)], [made(HIDDEN, 4 * HIDDEN) for _ in range(2)], biases, made(2 * HIDDEN), np.zeros(1, np.float32))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(gates: np.ndarray, state: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list]:
    """One direction over padded pages (page, block, gate); masked blocks keep the state."""
    n, steps, _ = gates.shape
    h = c = np.zeros((n, HIDDEN), dtype=np.float32)
    hs, kept = np.zeros((n, steps, HIDDEN), dtype=np.float32), []
    for t in range(steps):
        z = gates[:, t] + h @ state
        act = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o, g = act[:, :HIDDEN], act[:, HIDDEN : 2 * HIDDEN], act[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
        m = mask[:, t : t + 1]
        new_c = f * c + i * g
        tc = np.tanh(new_c)
        kept.append((i, f, o, g, c, h, tc, m))
        c = m * new_c + (1 - m) * c
        h = m * (o * tc) + (1 - m) * h
        hs[:, t] = h
    return hs, kept


def _back(dhs: np.ndarray, kept: list, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the gates' inputs and of ``state``."""
    n, steps, _ = dhs.shape
    dz_all = np.zeros((n, steps, 4 * HIDDEN), dtype=np.float32)
    dstate = np.zeros_like(state)
    dh = dc = np.zeros((n, HIDDEN), dtype=np.float32)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, c, h, tc, m = kept[t]
        dh = dh + dhs[:, t]
        dnew_h, dnew_c = m * dh, m * dc + m * dh * o * (1 - tc**2)
        dz = np.concatenate([dnew_c * g * i * (1 - i), dnew_c * c * f * (1 - f), dnew_h * tc * o * (1 - o), dnew_c * i * (1 - g**2)], axis=1)
        dz_all[:, t] = dz
        dstate += h.T @ dz
        dh = dz @ state.T + (1 - m) * dh
        dc = dnew_c * f + (1 - m) * dc
    return dz_all, dstate


def _flat(pages: list[list[Block]]) -> tuple[list[Block], np.ndarray]:
    """The blocks of all pages and their relative places."""
    where = [np.arange(len(page)) / max(1, len(page)) for page in pages]
    return [block for page in pages for block in page], np.concatenate(where)


def _padded(pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray]:
    features = _features(*_flat(pages))
    steps = max(map(len, pages))
    x = np.zeros((len(pages), steps, WIDTH), dtype=np.float32)
    mask = np.zeros((len(pages), steps), dtype=np.float32)
    at = 0
    for row, blocks in enumerate(pages):
        x[row, : len(blocks)] = features[at : at + len(blocks)]
        mask[row, : len(blocks)] = 1
        at += len(blocks)
    return x, mask


def _forward(net: Net, x: np.ndarray, mask: np.ndarray):
    # The second direction reads the sequence from its end.
    sides = [(x, mask), (x[:, ::-1], mask[:, ::-1])]
    runs = [_run(side @ w + b, s, m) for (side, m), w, s, b in zip(sides, net.inputs, net.states, net.biases, strict=True)]
    hidden = np.concatenate([runs[0][0], runs[1][0][:, ::-1]], axis=2)
    return hidden @ net.out + net.bias, hidden, sides, runs


def train(pages: int = PAGES, rounds: int = ROUNDS, seed: int = 11) -> Net:
    rng, rand = np.random.default_rng(seed), random.Random(seed)
    made = [b for b in (read(_layout(rand)) for _ in range(pages)) if b]
    labels = [np.array([_MAIN in block.text for block in blocks], dtype=np.float32) for blocks in made]
    for blocks in made:
        for block in blocks:
            block.text = block.text.replace(_MAIN, "") or "x"
    net = _new_net(rng)
    first, second = ([np.zeros_like(w) for w in net.all()] for _ in range(2))
    step = 0
    for _ in range(rounds):
        order = rng.permutation(len(made))
        for at in range(0, len(made), 20):
            chosen = order[at : at + 20]
            x, mask = _padded([made[i] for i in chosen])
            x[:, :, : 1 << PATH_BITS] *= rng.random(x[:, :, : 1 << PATH_BITS].shape, dtype=np.float32) > 0.1
            y = np.zeros(mask.shape, dtype=np.float32)
            for row, i in enumerate(chosen):
                y[row, : len(labels[i])] = labels[i]
            margin, hidden, sides, runs = _forward(net, x, mask)
            slope = (_sigmoid(margin) - y) * mask / mask.sum()
            dhidden = slope[:, :, None] * net.out
            parts = [dhidden[:, :, :HIDDEN], dhidden[:, ::-1, HIDDEN:]]
            dz, dstates = zip(*(_back(d, kept, s) for d, (_, kept), s in zip(parts, runs, net.states, strict=True)), strict=True)
            dinputs = [np.tensordot(side, d, axes=([0, 1], [0, 1])) for (side, _), d in zip(sides, dz, strict=True)]
            slopes = [*dinputs, *dstates, *(d.sum(axis=(0, 1)) for d in dz), np.tensordot(hidden, slope, axes=([0, 1], [0, 1])), slope.sum(keepdims=True).reshape(1)]
            step += 1
            for w, d, a, b in zip(net.all(), slopes, first, second, strict=True):
                d = np.clip(d, -1, 1) + 1e-5 * w
                a += 0.1 * (d - a)
                b += 0.001 * (d * d - b)
                w -= 0.01 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return net


@lru_cache(maxsize=1)
def trained() -> Net:
    return train()


def label(net: Net, pages: list[list[Block]]) -> list[np.ndarray]:
    """For each page whether each block is main text.  Pages are read whole, whatever their length."""
    out: list[np.ndarray] = [np.zeros(0, dtype=bool)] * len(pages)
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    while order:
        size = max(1, min(_AT_ONCE, _AT_ONCE * _LONG // len(pages[order[min(_AT_ONCE, len(order)) - 1]])))
        part, order = order[:size], order[size:]
        margin = _margins(net, [pages[i] for i in part])
        for row, i in zip(margin, part, strict=True):
            out[i] = row[: len(pages[i])] > 0
    return out


def _margins(net: Net, pages: list[list[Block]]) -> np.ndarray:
    """Margins of all blocks; features are made a stretch at a time, so a long page stays small."""
    steps = max(map(len, pages))
    gates = [np.zeros((len(pages), steps, 4 * HIDDEN), dtype=np.float32) for _ in range(2)]
    mask = np.zeros((len(pages), steps), dtype=np.float32)
    for row, blocks in enumerate(pages):
        mask[row, : len(blocks)] = 1
    rows, places = np.nonzero(mask)
    whole, where = _flat(pages)
    for at in range(0, len(whole), _STRETCH):
        here = slice(at, at + _STRETCH)
        features = _features(whole[here], where[here])
        for side in range(2):
            gates[side][rows[here], places[here]] = features @ net.inputs[side] + net.biases[side]
    forward, _ = _run(gates[0], net.states[0], mask)
    backward, _ = _run(gates[1][:, ::-1], net.states[1], mask[:, ::-1])
    return np.concatenate([forward, backward[:, ::-1]], axis=2) @ net.out + net.bias


# --- made-up pages -----------------------------------------------------------------------

_SYLLABLES = "an be co de el fi ga ho in ja ke lo ma ne or pa qui ra se ti un ver wo xa yo zu ción eau öl ß th ing".split()
_JUNK = {
    "menu": ("nav", "menu", "navbar", "navigation", "topnav", "breadcrumb", "breadcrumbs", "toolbar", "skip"),
    "head": ("header", "masthead", "banner", "topbar", "logo", "site-header", "branding"),
    "foot": ("footer", "copyright", "bottom", "site-footer", "legal", "colophon", "credits"),
    "side": ("sidebar", "aside", "widget", "related", "recommended", "trending", "popular", "more-stories", "tags"),
    "note": ("notice", "cookie", "cookies", "consent", "gdpr", "alert", "popup", "modal", "newsletter", "subscribe", "paywall", "promo", "message"),
    "ad": ("ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "banner-ad", "adbox"),
    "talk": ("comments", "comment", "comment-list", "responses", "discussion", "replies", "disqus", "reviews"),
    "share": ("share", "social", "sharing", "buttons", "follow", "author-box", "byline", "meta"),
}
_GOOD = ("article", "content", "post", "entry", "story", "article-body", "post-content", "entry-content", "main", "main-content", "text", "body-text")
_HINTS = {
    "note": "cookies accept privacy sign up newsletter subscribe", "talk": "reply said comment says report", "ad": "advertisement sponsored buy now offer",
    "foot": "copyright all rights reserved terms privacy contact ©", "side": "related more read also popular", "share": "share tweet follow print",
    "menu": "home about contact login search", "head": "logo menu search",
}


def _words(rand: random.Random, low: int, high: int) -> str:
    made = ("".join(rand.choices(_SYLLABLES, k=rand.randint(1, 4))) for _ in range(rand.randint(low, high)))
    return " ".join(w.capitalize() + "." if rand.random() < 0.1 else w for w in made)


def _junk(rand: random.Random, kind: str) -> str:
    names = _JUNK[kind]
    tag = {"menu": "nav", "head": "header", "foot": "footer", "side": "aside"}.get(kind, "div")
    name = rand.choice(names)
    plain = tag != "div" and rand.random() < 0.5
    tag = tag if plain or rand.random() < 0.4 else rand.choice(("div", "section", "div"))
    shown = "" if plain else f' {rand.choice(("class", "id", "class"))}="{name}"'
    hint = lambda: rand.choice(_HINTS[kind].split()) + " " if rand.random() < 0.3 else ""
    if kind in ("menu", "side", "share") and rand.random() < 0.8:
        inner = "".join(f'<li><a href="/{i}">{hint()}{_words(rand, 1, 4)}</a></li>' for i in range(rand.randint(2, 9)))
        inner = f"<ul>{inner}</ul>"
    elif kind == "talk":
        inner = "".join(f'<div class="{rand.choice(("comment", "reply", "c"))}"><p>{hint()}{_words(rand, 3, 40)}</p></div>' for _ in range(rand.randint(1, 6)))
        inner = f"<h3>{_words(rand, 1, 3)}</h3>{inner}"
    elif kind == "note" and rand.random() < 0.4:
        inner = f"<form><label>{_words(rand, 1, 5)}</label><input type=text><button>{_words(rand, 1, 2)}</button></form>"
    else:
        wrap = rand.choice(("{}", "<p>{}</p>", "<span>{}</span>", "<p>{}</p><p>{}</p>"))
        inner = wrap.replace("{}", f"{hint()}{_words(rand, 2, 40)}")
    if kind == "foot":
        inner = rand.choice(("&copy; ", "")) + inner
    return f"<{tag}{shown}>{inner}</{tag}>"


def _form(rand: random.Random) -> str:
    return f'<form action="/{rand.randint(0, 9)}"><p>{_words(rand, 1, 8)}</p><select><option>{_words(rand, 1, 2)}<option>{_words(rand, 1, 2)}</select><textarea>{_words(rand, 0, 5)}</textarea><button>{_words(rand, 1, 2)}</button></form>'


def _good(rand: random.Random, low: int = 1, high: int = 70) -> str:
    return _MAIN + _words(rand, low, high)


def _article(rand: random.Random) -> str:
    parts = [f"<h1>{_good(rand, 2, 12)}</h1>"] if rand.random() < 0.85 else []
    for _ in range(rand.randint(1, 12)):
        kind = rand.random()
        if kind < 0.66:
            text = _good(rand, 1, 80) if rand.random() < 0.8 else _good(rand, 1, 3)
            text = rand.choice(("{}", "{}", "<b>{}<br>", "<em>{}</em>", '{} <a href="/x">link</a>', "<span>{}</span>")).replace("{}", text)
            parts.append(f"<p>{text}" + ("</p>" if rand.random() < 0.85 else ""))
        elif kind < 0.72:
            parts.append(f"<h{rand.randint(2, 4)}>{_good(rand, 1, 8)}</h{rand.randint(2, 4)}>")
        elif kind < 0.78:
            parts.append("<ul>" + "".join(f"<li>{_good(rand, 1, 15)}</li>" for _ in range(rand.randint(1, 5))) + "</ul>")
        elif kind < 0.82:
            parts.append(f"<blockquote><p>{_good(rand)}</p></blockquote>")
        elif kind < 0.85:
            parts.append("<table>" + "".join(f"<tr><td>{_good(rand, 1, 4)}</td><td>{_good(rand, 1, 4)}</td></tr>" for _ in range(2)) + "</table>")
        elif kind < 0.87:
            parts.append(f"<pre>{_good(rand, 3, 20)}</pre>")
        elif kind < 0.89:
            parts.append(f"<div>{_good(rand, 3, 40)}</div>")
        elif kind < 0.97:
            parts.append(_junk(rand, rand.choice(("ad", "share", "side", "note", "ad"))))
        else:
            parts.append(_form(rand))
    if rand.random() < 0.15:
        parts.append(_junk(rand, "talk"))
    inner = "".join(parts)
    style = rand.random()
    if style < 0.45:
        inner = f"<article>{inner}</article>"
    elif style < 0.6:
        inner = f"<main>{inner}</main>"
    else:
        tag = rand.choice(("div", "section", "article"))
        inner = f'<{tag} {rand.choice(("class", "id"))}="{rand.choice(_GOOD)}">{inner}</{tag}>'
    return f"<main>{inner}</main>" if rand.random() < 0.15 else inner


def _layout(rand: random.Random) -> str:
    around = lambda kinds, most: "".join(
        _junk(rand, rand.choice(kinds)) for _ in range(rand.randint(0, most))
    )
    before = around(("menu", "head", "menu", "note", "ad"), 4) + (_form(rand) if rand.random() < 0.1 else "")
    after = around(("side", "talk", "ad", "note", "foot", "share"), 4) + (_junk(rand, "foot") if rand.random() < 0.7 else "")
    middle = _article(rand) if rand.random() < 0.97 else ""
    if rand.random() < 0.3:
        middle = f'<div class="{rand.choice(("wrapper", "container", "page", "row", "layout", "site"))}">{around(("side",), 1)}{middle}{around(("side",), 1)}</div>'
    head = f"<head><title>{_words(rand, 2, 9)}</title><style>p{{}}</style></head>" if rand.random() < 0.9 else ""
    page = f"<!DOCTYPE html><html>{head}<body>{before}{middle}{after}"
    return page + "</body></html>" if rand.random() < 0.8 else page


# --- over all pages ----------------------------------------------------------------------


def extract(pages: DataFrame, net: Net | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` for every row of ``pages``.

    ``text``: the main blocks in page order, one line each, empty where there is none; a null html
    is empty.  References are decoded and white space inside a block is one space.  Null ids and
    urls stay null, repeated rows are extracted each, an empty table gives no rows.
    """
    net = net or trained()

    def main_text(batch: pd.DataFrame) -> Iterator[tuple]:
        for at in range(0, len(batch), 256):
            part = batch.iloc[at : at + 256]
            blocks = [read(page) for page in part["html"]]
            for page_id, url, found, main in zip(part["page_id"], part["url"], blocks, label(net, blocks), strict=True):
                yield page_id, url, "\n".join(b.text for b, keep in zip(found, main, strict=True) if keep)

    rows = pages.select(F.col("page_id").cast("string"), "url", F.coalesce(F.col("html"), F.lit("")).alias("html"))
    found = rows.mapInPandas(by_row(main_text, ["page_id", "url", "text"]), "page_id string, url string, text string")
    return found.select(F.col("page_id").cast(pages.schema["page_id"].dataType), "url", "text", F.length("text").cast("long").alias("n_chars"))
